"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_CHECKPOINT = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local[*] session (tests) may fall back to a temporary folder; on a
    cluster an unset folder is an error, never a machine-local path.
    """
    named = spark.conf.get(_CHECKPOINT, None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {_CHECKPOINT} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="sparkeval-")
    return _LOCAL[app]


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark)}/sparkeval/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, **options: int) -> None:
    """Write a table that replaces the shuffle files that made it: these are deleted at once."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = new_path(spark, name)
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)


_TABLES: dict[tuple[str, str], DataFrame] = {}
_SHARED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One input table; its schema is read once per application."""
    key = (spark.sparkContext.applicationId, f"{folder}/{name}.parquet")
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(key[1])
    return _TABLES[key]


def shared(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written once per application to the shared folder and read by every later use."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _SHARED:
        _SHARED[key] = materialize(build(), re.sub(r"[^A-Za-z0-9_.]+", "_", name).strip("_"))
    return _SHARED[key]
