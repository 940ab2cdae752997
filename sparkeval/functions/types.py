"""Struct types for functions declared before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"double": T.DoubleType, "long": T.LongType, "string": T.StringType}


def struct_of(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[t]()) for n, t in fields.items()])
