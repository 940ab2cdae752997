"""Registry of queries and of the SQL each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkeval.plans.views_sql import VIEW_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _views(text: str) -> list[str]:
    """Views named in ``text``, with the views they need first."""
    found: list[str] = []
    for name in VIEW_SQL:
        if re.search(rf"\b{name}\b", text):
            for need in [*_views(VIEW_SQL[name]), name]:
                if need not in found:
                    found.append(need)
    return found


def with_views(sql: str, ctes: str = "", recursive: bool = False) -> str:
    """Full statement: the views the text names, then its own CTEs, then the select."""
    parts = [f"{name} AS MATERIALIZED ({VIEW_SQL[name]})" for name in _views(ctes + " " + sql)]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + sql.strip()


def query(name: str, sql: str | None = None, ctes: str = "", recursive: bool = False):
    """Register a query; ``sql`` is the check on the same tables, if SQL can say it."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, ctes, recursive)
        return fn

    return add
