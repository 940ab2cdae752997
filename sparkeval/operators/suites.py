"""Test cases, suites and standards as tables of edits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def after_edits(edits: DataFrame, keys: Sequence[str], order: str, action: str = "action", removed: str = "remove") -> DataFrame:
    """Entries left after an edit log: the last edit of a key decides, one combining maximum per key."""
    rest = [c for c in edits.columns if c not in keys]
    last = edits.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_e")).select(*keys, "_e.*")
    return last.where(F.col(action) != removed).drop(action, order)


def replayed(edits: DataFrame, suite: str, case: str, sample: str, order: str, action: str = "action") -> DataFrame:
    """(suite, case, sample and the other columns) that an edit log leaves in test suites.

    ``reset`` empties a suite (its case is null), ``replace`` puts a case of the same name in the old one's place and ``drop``
    takes it out (their sample is null), ``add`` and ``remove`` are edits of one sample. Only edits after a case's last barrier
    count, the later of its suite's last reset and its own last replacement; of those the last edit of a sample decides. So
    no log is replayed in order: barriers are maxima, one per suite and one per case.
    """
    at = F.col(order)
    resets = edits.where(F.col(action) == "reset").groupBy(suite).agg(F.max(at).alias("_reset"))
    cases = edits.where(f"`{case}` IS NOT NULL").groupBy(suite, case).agg(F.max(F.when(F.col(action).isin("replace", "drop"), at)).alias("_own"))
    barriers = cases.join(resets, suite, "left").select(suite, case, F.greatest("_own", "_reset").alias("_barrier"))  # a row per case
    counted = edits.where(F.col(action).isin("add", "remove")).join(barriers, [suite, case]).where(F.col("_barrier").isNull() | (at > F.col("_barrier"))).drop("_barrier")
    return after_edits(counted, [suite, case, sample], order, action)


def reset_suite(current: DataFrame, suite: str) -> DataFrame:
    return current.where(F.col("suite") != suite)


def bulk_cases(current: DataFrame, new: DataFrame, name: str = "test_case") -> DataFrame:
    """Create or replace many test cases in one step; a name given twice for one sample is an error."""
    twice = new.groupBy(name, "sample").agg(F.count("*").alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError("test case repeats a sample")
    return current.join(new.select(name).distinct(), name, "left_anti").unionByName(new)


def copy_standard(standards: DataFrame, source: str, target: str, parts: Sequence[str]) -> DataFrame:
    """Standards table after copying parts of one dataset's standard over another's."""
    if source == target:
        raise ValueError("source and target are the same dataset")
    if not parts:
        raise ValueError("name at least one part to copy")
    picked = F.col("part").isin(list(parts))
    copied = standards.where((F.col("dataset") == source) & picked).withColumn("dataset", F.lit(target))
    return standards.where(~((F.col("dataset") == target) & picked)).unionByName(copied)
