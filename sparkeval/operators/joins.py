"""Joins between datapoints, results, samples and test cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_results(points: DataFrame, results: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Every datapoint with its result, null where untested."""
    return points.join(results, list(ids), "left")


def one_to_one(a: DataFrame, b: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Left join that fails if a key repeats on either side."""
    for side in (a, b):
        if not side.groupBy(*ids).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            raise ValueError("keys repeat")
    return a.join(b, list(ids), "left")


def suffixed(a: DataFrame, b: DataFrame, ids: Sequence[str], left: str = "_inf", right: str = "_gt") -> DataFrame:
    """Inner join whose same-named fields get a suffix per side."""
    both = (set(a.columns) & set(b.columns)) - set(ids)
    a = a.select(*[F.col(c).alias(c + left) if c in both else F.col(c) for c in a.columns])
    b = b.select(*[F.col(c).alias(c + right) if c in both else F.col(c) for c in b.columns])
    return a.join(b, list(ids))


def without_inference(samples: DataFrame, inferences: DataFrame, ids: Sequence[str], reset: bool = False) -> DataFrame:
    """Samples still to infer, or all of them on reset."""
    return samples if reset else samples.join(inferences.select(*ids), list(ids), "left_anti")


def per_case(metrics: DataFrame, membership: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Sample metrics repeated for every test case the sample belongs to."""
    return metrics.join(membership, list(ids))


def by_model(results: DataFrame, ids: Sequence[str], value: str, a: str, b: str) -> DataFrame:
    """(ids, a, b): one value of two models side by side, from one aggregate."""
    pick = lambda m: F.max(F.when(F.col("model") == m, F.col(value)))
    wide = results.where(F.col("model").isin(a, b)).groupBy(*ids).agg(pick(a).alias("a"), pick(b).alias("b"))
    return wide.where("a IS NOT NULL AND b IS NOT NULL")


def unordered(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs with the smaller end first, each once."""
    return df.withColumn("_a", F.least(a, b)).withColumn("_b", F.greatest(a, b)).drop(a, b).withColumnsRenamed({"_a": a, "_b": b}).dropDuplicates([a, b])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in an explicit order, as a combining minimum rather than a sort per key."""
    rest = [c for c in df.columns if c not in keys]
    by = [F.col(c).alias(f"o{i}") if isinstance(c, str) else c.alias(f"o{i}") for i, c in enumerate(order)]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*by)).alias("_r")).select(*keys, "_r.*")
