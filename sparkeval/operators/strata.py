"""Bins, histograms, curves over bins, and stratification into test cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkeval.functions.search import cuts_below
from sparkeval.operators.running import exact_quantiles

MAX_BUCKETS = 100
MAX_BINS = 200
QUANTILE_NAMES = {  # fixed names
    1: "all", 2: "half", 3: "tertile", 4: "quartile", 5: "quintile", 6: "sextile", 7: "septile", 8: "octile", 10: "decile", 100: "percentile",
}


def ordinal(n: Column) -> Column:
    """``1st``, ``2nd``, ``3rd``, ``4th``, ``11th``."""
    teen = (n % 100).between(11, 13)
    suffix = F.when(teen, "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def bucket_name(index: Column, buckets: int) -> Column:
    return F.concat(ordinal(index + 1), F.lit(" " + QUANTILE_NAMES.get(buckets, "quantile")))


def check_edges(edges: Sequence[float]) -> list[float]:
    """Edges must increase strictly; two equal edges make one single-value bucket."""
    edges = [float(e) for e in edges]
    if any(e != e for e in edges):
        raise ValueError("nan is not a bucket edge")
    if not 1 <= len(edges) <= MAX_BUCKETS + 1:
        raise ValueError(f"between 1 and {MAX_BUCKETS + 1} edges")
    if len(edges) == 2 and edges[0] == edges[1]:
        return edges
    if sorted(set(edges)) != edges:
        raise ValueError("bucket edges must be strictly increasing")
    return edges


def bin_by_edges(value: str, edges: Sequence[float]) -> Column:
    """0-based bin of right-open bins with a closed last one; null outside. ``value`` is a column name."""
    edges = check_edges(edges)
    v, n = F.col(value).cast("double"), len(edges) - 1
    if n == 1 and edges[0] == edges[1]:
        return F.when(v == edges[0], 0)
    k = F.when(v == edges[-1], n - 1).otherwise(cuts_below(f"double(`{value}`)", edges) - 1)
    return F.when((v >= edges[0]) & (v <= edges[-1]), k)


def bin_even(value: Column, lo: Column, hi: Column, bins: Column | int) -> Column:
    """0-based equal-width bin, exact at the edges; the last bin is closed; null outside."""
    v, bins = value.cast("double"), bins if isinstance(bins, Column) else F.lit(bins)
    step = (hi - lo) / bins
    k = F.floor((v - lo) / F.when(step > 0, step).otherwise(1.0))
    k = F.when(v < lo + k * step, k - 1).when((v >= lo + (k + 1) * step) & (k < bins - 1), k + 1).otherwise(k)
    return F.when((v >= lo) & (v <= hi), F.least(k, (bins - 1).cast("long")))


def even_histogram(df: DataFrame, value: str, lo: float | Column, hi: float | Column, bins: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin, lo, hi, n) with empty bins kept."""
    lo, hi, bins = (c if isinstance(c, Column) else F.lit(c) for c in (lo, hi, bins))
    tagged = df.select(*by, F.col(value).alias("_v"), lo.cast("double").alias("_lo"), hi.cast("double").alias("_hi"), bins.cast("int").alias("_bins"))
    counts = tagged.groupBy(*by, bin_even(F.col("_v"), F.col("_lo"), F.col("_hi"), F.col("_bins")).alias("bin"), "_lo", "_hi", "_bins").agg(F.count("*").alias("n"))
    grid = counts.groupBy(*by).agg(*[F.max(c).alias(c) for c in ("_lo", "_hi", "_bins")])
    grid = grid.select(*by, "_lo", "_hi", "_bins", F.explode(F.sequence(F.lit(0), F.col("_bins") - 1)).alias("_k")).withColumn("bin", F.col("_k").cast("long"))
    full = grid.join(counts.select(*by, "bin", "n"), [*by, "bin"], "left")
    edge = lambda k: F.col("_lo") + k * (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    return full.select(*by, "bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def score_range(df: DataFrame, value: str, step: float = 0.02) -> DataFrame:
    """One row (lo, hi, bins) on a 0.02 grid; no row if empty or outside [0, 1]."""
    span = df.agg(F.min(value).alias("a"), F.max(value).alias("b")).where("a >= 0 AND b <= 1")
    lo = F.floor((F.col("a") + 1e-9) / step) * step
    hi = F.floor((F.col("b") - 1e-9) / step) * step + step
    span = span.select(lo.alias("lo"), hi.alias("hi"))
    flat = F.abs(F.col("hi") - F.col("lo")) < 1e-9
    span = span.select(
        F.when(flat & (F.col("hi") >= 0.5), F.col("hi") - step).otherwise(F.col("lo")).alias("lo"),
        F.when(flat & (F.col("hi") < 0.5), F.col("lo") + step).otherwise(F.col("hi")).alias("hi"),
    )
    return span.withColumn("bins", (F.floor((F.col("hi") - F.col("lo") - 1e-9) / step) + 1).cast("int"))


def edge_histogram(df: DataFrame, value: str, edges: Sequence[float], by: Sequence[str] = (), density: bool = False) -> DataFrame:
    """(by, bin, n[, density]) over explicit edges; density is count / (total * width)."""
    edges = check_edges(edges)
    binned = df.select(*by, bin_by_edges(value, edges).alias("bin")).where("bin IS NOT NULL")
    counts = binned.groupBy(*by, "bin").agg(F.count("*").alias("n"))
    if not density:
        return counts
    total = counts.groupBy(*by).agg(F.sum("n").alias("_t"))
    joined = counts.join(total, list(by)) if by else counts.withColumn("_t", total.scalar())
    cuts = F.array(*[F.lit(e) for e in edges])
    width = F.element_at(cuts, F.col("bin") + 2) - F.element_at(cuts, F.col("bin") + 1)
    return joined.withColumn("density", F.col("n") / (F.col("_t") * width)).drop("_t")


def binned_mean(df: DataFrame, x: str, y: str, edges: Sequence[float]) -> DataFrame:
    """(x, y): mean y per half-open x bin at the bin centre; empty bins are dropped."""
    edges = check_edges(edges)
    cuts = F.array(*[F.lit(e) for e in edges])
    k = cuts_below(f"double(`{x}`)", edges)
    centre = (F.element_at(cuts, F.col("k")) + F.element_at(cuts, F.col("k") + 1)) / 2
    rows = df.select(k.alias("k"), F.col(y).alias("_y")).where(F.col("k").between(1, len(edges) - 1))
    return rows.groupBy("k").agg(F.avg("_y").alias("y")).select(centre.alias("x"), "y")


def failure_rate_curve(df: DataFrame, value: str, thresholds: Sequence[float]) -> DataFrame:
    """(threshold, rate): share of rows above each threshold; a null never fails but counts."""
    ts = sorted(thresholds)
    cuts = F.array(*[F.lit(float(t)) for t in ts])
    # At most one row per threshold is left to pack.
    levels = df.groupBy(cuts_below(f"`{value}`", ts, inclusive=False).alias("level")).agg(F.count("*").alias("n"))
    packed = levels.agg(F.collect_list(F.struct("level", "n")).alias("ls"), F.sum("n").alias("all"))
    at = packed.select("ls", "all", F.posexplode(cuts).alias("pos", "threshold"))
    above = F.aggregate("ls", F.lit(0).cast("long"), lambda acc, r: acc + F.when(r["level"] > F.col("pos"), r["n"]).otherwise(0))
    return at.select("threshold", (above / F.col("all")).alias("rate"))


def quantile_edges(df: DataFrame, value: str, buckets: int) -> list[float]:
    """Exact equal-height edges: at most 101 numbers."""
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"between 1 and {MAX_BUCKETS} buckets")
    rows = exact_quantiles(df, [], value, [i / buckets for i in range(buckets + 1)]).collect()
    return sorted({float(r["quantile"]) for r in rows})


def equal_height(df: DataFrame, value: str, buckets: int = 4) -> Column:
    """Bucket column from exact quantile edges."""
    edges = quantile_edges(df, value, buckets)
    return bin_by_edges(value, edges if len(edges) > 1 else edges * 2)


def equal_width(df: DataFrame, value: str, buckets: int = 4) -> Column:
    """Bucket column over the value range cut into equal widths."""
    span = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    return bin_even(F.col(value), span.select("lo").scalar(), span.select("hi").scalar(), buckets)


def numeric_stats(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, median, min, max, stddev (sample), sum of a numeric field."""
    by = list(by)
    stats = df.groupBy(*by).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.stddev(value).alias("stddev"), F.sum(value).alias("sum"),
    )
    median = exact_quantiles(df, by, value, [0.5]).select(*by, F.col("quantile").alias("median"))
    return stats.join(median, by, "left") if by else stats.withColumn("median", median.scalar())


def weighted_mean(metric: str, weight: str) -> Column:
    both = F.col(metric).isNotNull() & F.col(weight).isNotNull()
    return F.try_divide(F.sum(F.when(both, F.col(metric) * F.col(weight))), F.sum(F.when(both, F.col(weight))))
