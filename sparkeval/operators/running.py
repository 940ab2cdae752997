"""Running totals, ranks and exact quantiles that no single task has to hold.

A plain window over one big group sorts that group in one task. Here the group is
cut into value ranges (edges from an approximate-percentile sketch of fixed size),
each range is scanned on its own, and the totals of the ranges before it are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions.search import cuts_below
from sparkeval.session import materialize

LEAST_RANGES = 64


def _ranged(df: DataFrame, order: str) -> DataFrame:
    """Add ``_range``, the number of sketch edges below the value: as many ranges as the session has shuffle partitions, 64 at least."""
    ranges = max(LEAST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    edges = df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 30 * ranges)).scalar()
    df = df.withColumn("_edges", edges)
    below = cuts_below(f"`{order}`", [f"_edges[{i}]" for i in range(ranges - 1)], inclusive=False)
    return df.withColumn("_range", below).drop("_edges")


def running(
    df: DataFrame, by: Sequence[str], order: str, what: dict[str, Column], descending: bool = True, how: str = "sum", ahead: Sequence[str] = ()
) -> DataFrame:
    """Add the running sum (or max) of each expression along ``order`` within ``by``.

    ``df`` holds one row per (by, order) value: aggregate it first. With ``ahead``, struct ``next`` holds
    those columns of the following row, null on the last.
    """
    by = list(by)
    df = _ranged(df, order)
    fold = F.sum if how == "sum" else F.max
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    ranges = W.partitionBy(*by).orderBy(way("_range"))
    before = ranges.rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*by, "_range").orderBy(way(order))
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    parts, offsets = [fold(e).alias(f"_t_{n}") for n, e in what.items()], [fold(f"_t_{n}").over(before).alias(f"_b_{n}") for n in what]
    row = F.struct(*ahead) if ahead else None
    if ahead:
        parts.append((F.max if descending else F.min)(F.struct(order, row.alias("row"))).alias("_head"))
        offsets.append(F.lead("_head.row").over(ranges).alias("_head"))
    totals = df.groupBy(*by, "_range").agg(*parts).select(*by, "_range", *offsets)
    joined = df.join(totals, [*by, "_range"])
    added = {}
    for n, e in what.items():
        local, base = fold(e).over(upto), F.col(f"_b_{n}")
        added[n] = local + F.coalesce(base, F.lit(0)) if how == "sum" else F.greatest(local, base)
    if ahead:
        added["next"] = F.coalesce(F.lead(row).over(inside), F.col("_head"))
    return joined.withColumns(added).drop("_range", "_head", *[f"_b_{n}" for n in what])


def following(df: DataFrame, by: Sequence[str], order: str, cols: Sequence[str], descending: bool = True) -> DataFrame:
    """Add struct ``next``: ``cols`` of the next row along ``order`` within ``by``, null on the last."""
    return running(df, by, order, {}, descending, ahead=cols)


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per distinct value: (by, value, n)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    return materialize(counts, "value-counts")  # read several times: edges, totals, rows


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group: (by, fraction, quantile)."""
    by = list(by)
    counts = value_counts(df, by, value)
    sizes = counts.groupBy(*by).agg(F.sum("n").alias("size"))
    cum = running(counts, by, value, {"upto": F.col("n")}, descending=False)
    cum = cum.join(sizes, by) if by else cum.withColumn("size", sizes.select("size").scalar())
    wanted = F.array(*[
        F.struct(F.lit(float(q)).alias("fraction"), (F.lit(float(q)) * (F.col("size") - 1)).alias("pos")) for q in fractions
    ])
    lo, hi = F.col("upto") - F.col("n"), F.col("upto")
    # A value serves the targets whose lower or upper neighbour falls on one of its rows.
    hit = F.filter(wanted, lambda t: (F.ceil(t["pos"]) >= lo) & (F.floor(t["pos"]) < hi))
    rows = cum.select(*by, value, lo.alias("lo"), hi.alias("hi"), F.explode(hit).alias("t"))
    pos = F.col("t.pos")
    low = F.when((F.floor(pos) >= F.col("lo")) & (F.floor(pos) < F.col("hi")), F.col(value))
    high = F.when((F.ceil(pos) >= F.col("lo")) & (F.ceil(pos) < F.col("hi")), F.col(value))
    return (
        rows.groupBy(*by, F.col("t.fraction").alias("fraction"))
        .agg(F.max(low).alias("_l"), F.max(high).alias("_h"), F.max(pos - F.floor(pos)).alias("_w"))
        .withColumn("quantile", F.col("_l") + (F.col("_h") - F.col("_l")) * F.col("_w"))
        .drop("_l", "_h", "_w")
    )


def average_ranks(df: DataFrame, by: Sequence[str], value: str, rank: str) -> DataFrame:
    """Average rank (ties share their mean rank) per distinct value: (by, value, rank)."""
    cum = running(value_counts(df, by, value), by, value, {"upto": F.col("n")}, descending=False)
    return cum.select(*by, value, (F.col("upto") - (F.col("n") - 1) / 2).alias(rank))
