"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from sparkeval.session import materialize, new_path, write_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The documented bound of everything that is sent to all tasks: vocabularies, models, item indexes.
BROADCAST_BYTES = 64 << 20


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that checks it if SQL can say it."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file (a vocabulary) through Spark's readers if the path names a store, else from this machine."""
    if "://" in path:
        data = spark.read.format("binaryFile").load(path).select("content").first()[0]
    else:
        with open(path, "rb") as f:
            data = f.read()
    if len(data) > BROADCAST_BYTES:
        raise ValueError(f"{path} has {len(data)} bytes, more than the {BROADCAST_BYTES} that may go to every task")
    return bytes(data)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, or with underscores before it until no column clashes."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


class Scratch:
    """Written tables of one call below the shared folder; ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        write_table(df, path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in tables:
            path = self.tables.pop(id(df), (None, ""))[1]
            if path:
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


__all__ = ["BROADCAST_BYTES", "ORACLES", "QUERIES", "Scratch", "file_bytes", "fresh", "materialize", "new_path", "query", "read"]
