"""Precision/recall, F1 and ROC curves, optimal thresholds and average precision.

Everything starts from counts per distinct score, so ties collapse and hot labels shrink before
any ordering happens; running totals then come from ``running`` without a one-task sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions.ratios import ratio
from sparkeval.operators.running import running
from sparkeval.session import materialize

CURVE_POINTS = 501  # most points of a reported curve


def score_counts(df: DataFrame, by: Sequence[str], positive: Column, score: Column) -> DataFrame:
    """(by, score, pos, neg): positives and negatives per distinct score."""
    df = df.select(*by, positive.cast("long").alias("_p"), score.cast("double").alias("score"))
    counts = df.groupBy(*by, "score").agg(F.sum("_p").alias("pos"), F.sum(1 - F.col("_p")).alias("neg"))
    return materialize(counts, "score-counts")  # curves read it several times


def detection_counts(matches: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    """Score counts of detection matches; a ground truth without inference scores -1."""
    found = matches.where("kind IN ('matched', 'unmatched_gt', 'confused', 'unmatched_inf')")
    found = found.withColumn("label", F.when(F.col("kind") == "unmatched_inf", F.col("inf.label")).otherwise(F.col("gt.label")))
    score = F.when(F.col("kind").isin("unmatched_gt", "confused"), -1.0).otherwise(F.col("inf.score"))
    return score_counts(found, by, F.col("kind") != "unmatched_inf", score)


def _with_total(df: DataFrame, counts: DataFrame, by: Sequence[str], **sums: str) -> DataFrame:
    total = counts.groupBy(*by).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    if by:
        return df.join(total, list(by))
    for n in sums:
        df = df.withColumn(n, total.select(n).scalar())
    return df


def _rates(df: DataFrame) -> DataFrame:
    df = df.withColumn("precision", ratio("tp", F.col("tp") + F.col("fp"))).withColumn("recall", ratio("tp", "n_pos"))
    p, r = F.col("precision"), F.col("recall")
    return df.withColumn("fn", F.col("n_pos") - F.col("tp")).withColumn("f1", ratio(2 * p * r, p + r))


def threshold_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates at every distinct score >= 0: (by, threshold, tp, fp, fn, precision, recall, f1, pos)."""
    at = running(counts, by, "score", {"tp": F.col("pos"), "fp": F.col("neg")})
    at = _with_total(at.where("score >= 0").withColumnRenamed("score", "threshold"), counts, by, n_pos="pos")
    return _rates(at).drop("neg")


def optimal_f1(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lowest score of highest F1 per group; 0 where there is no positive or no F1 above 0."""
    points = threshold_points(counts, by)
    best = points.groupBy(*by).agg(F.max(F.struct("f1", (-F.col("threshold")).alias("neg"))).alias("b"))
    best = best.select(*by, F.when(F.col("b.f1") > 0, -F.col("b.neg")).otherwise(0.0).alias("threshold"))
    if not by:
        return best.select(F.coalesce("threshold", F.lit(0.0)).alias("threshold"))
    groups = counts.select(*by).distinct()
    return groups.join(best, list(by), "left").withColumn("threshold", F.coalesce("threshold", F.lit(0.0)))


def curve_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Points of the reported curve: at most 501 thresholds, one point per recall.

    With 501 or more distinct scores the thresholds are evenly spaced between the lowest and the
    highest; scores are counted into that grid, so the running totals see at most 501 rows a group.
    """
    by = list(by)
    positive = counts.where("score >= 0")
    span = positive.groupBy(*by).agg(F.count("*").alias("_n"), F.min("score").alias("_lo"), F.max("score").alias("_hi"))
    if by:
        binned = positive.join(span, by)
    else:
        binned = positive
        for c in ("_n", "_lo", "_hi"):
            binned = binned.withColumn(c, span.select(c).scalar())
    step = (F.col("_hi") - F.col("_lo")) / (CURVE_POINTS - 1)
    s, lo = F.col("score"), F.col("_lo")
    k = F.floor((s - lo) / step)
    k = F.when(s >= lo + (k + 1) * step, k + 1).when(s < lo + k * step, k - 1).otherwise(k)
    k = F.when(s == F.col("_hi"), CURVE_POINTS - 1).otherwise(F.least(k, F.lit(CURVE_POINTS - 2)))
    grid = F.when(k == CURVE_POINTS - 1, F.col("_hi")).otherwise(lo + k * step)
    binned = binned.withColumn("threshold", F.when(F.col("_n") >= CURVE_POINTS, grid).otherwise(s))
    binned = binned.groupBy(*by, "threshold").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    down = W.partitionBy(*by).orderBy(F.col("threshold").desc()).rowsBetween(W.unboundedPreceding, 0)
    at = binned.select(*by, "threshold", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"))
    at = _rates(_with_total(at, counts, by, n_pos="pos"))
    # One point per recall: highest precision, then highest threshold.
    kept = at.groupBy(*by, "tp").agg(F.max(F.struct("precision", "threshold", "recall", "f1")).alias("p"))
    return kept.select(*by, "p.threshold", "p.precision", "p.recall", "p.f1")


def pr_curve(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, precision, recall, f1) with a point at recall 0; no curve below two points."""
    by = list(by)
    points = curve_points(counts, by)
    first = points.groupBy(*by).agg(
        F.min_by(F.struct("threshold", "precision", F.lit(0.0).alias("recall"), "f1"), "recall").alias("p"),
        F.min("recall").alias("least"),
    ).where("least > 0").select(*by, "p.*")
    return _at_least_two(points.unionByName(first), by)


def f1_curve(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, precision, recall, f1) of the F1-versus-threshold curve."""
    return _at_least_two(curve_points(counts, by), list(by))


def _at_least_two(points: DataFrame, by: list[str]) -> DataFrame:
    n = F.count("*").over(W.partitionBy(*by))
    return points.withColumn("_n", n).where("_n >= 2").drop("_n")


def average_precision(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All-point average precision: each score's gain in recall times the best precision at that recall or beyond."""
    points = threshold_points(counts, by)
    env = running(points, by, "threshold", {"envelope": F.col("precision")}, descending=False, how="max")
    gain = ratio("pos", "n_pos")
    ap = env.groupBy(*by).agg(F.sum(gain * F.col("envelope")).alias("ap"))
    if not by:
        return ap.select(F.coalesce("ap", F.lit(0.0)).alias("ap"))
    groups = counts.select(*by).distinct()
    return groups.join(ap, list(by), "left").withColumn("ap", F.coalesce("ap", F.lit(0.0)))


def average_precision_of(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """All-point AP of given (precision, recall) points per group."""
    best = points.groupBy(*by, "recall").agg(F.max("precision").alias("precision"))
    env = running(best, by, "recall", {"envelope": F.col("precision")}, descending=True, how="max", ahead=["recall"])
    gain = F.col("recall") - F.coalesce("next.recall", F.lit(0.0))
    return env.groupBy(*by).agg(F.sum(gain * F.col("envelope")).alias("ap"))


def interpolated_ap(counts: DataFrame, by: Sequence[str], points: int) -> DataFrame:
    """Mean over evenly spaced recalls of the best precision at that recall or beyond (11- or 101-point AP)."""
    at = threshold_points(counts, by)
    step = points - 1
    # Best precision per recall cell, then the suffix maximum over at most ``points`` cells.
    cell = F.floor(F.col("recall") * step + 1e-9)
    cells = at.groupBy(*by, cell.alias("cell")).agg(F.max("precision").alias("best"))
    grid = counts.select(*by).distinct().withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(step))))
    up = W.partitionBy(*by).orderBy(F.col("cell").desc()).rowsBetween(W.unboundedPreceding, 0)
    full = grid.withColumn("cell", F.col("cell").cast("long")).join(cells, [*by, "cell"], "left")
    full = full.withColumn("p", F.coalesce(F.max("best").over(up), F.lit(0.0)))
    return full.groupBy(*by).agg(F.avg("p").alias("ap"))


def roc_points(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, fpr, tpr, ...) at every distinct score plus the origin, without collinear inner points.

    Groups with one class only, or at most two samples, give no curve.
    """
    by = list(by)
    at = running(counts, by, "score", {"tp": F.col("pos"), "fp": F.col("neg")}, ahead=["pos", "neg"])
    at = _with_total(at, counts, by, n_pos="pos", n_neg="neg").where("n_pos > 0 AND n_neg > 0 AND n_pos + n_neg > 2")
    return at.withColumn("tpr", ratio("tp", "n_pos")).withColumn("fpr", ratio("fp", "n_neg"))


def roc_curve(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Corner points of the ROC curve: a point stays where the direction to its neighbours changes.

    Neighbours differ by the rows of one score, so the direction into a point is its own (neg, pos)
    and the direction out is that of the next lower score.
    """
    by = list(by)
    at = roc_points(counts, by)
    turn = F.col("next").isNull() | (F.col("pos") * F.col("next.neg") != F.col("neg") * F.col("next.pos"))
    corners = at.withColumn("_keep", turn).where("_keep").select(*by, "fpr", "tpr")
    origin = at.select(*by).distinct().select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return corners.unionByName(origin)


def auc_roc(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under ROC: each negative counts the positives above it and half of those at its score."""
    at = roc_points(counts, by)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2)) / (F.max("n_pos") * F.max("n_neg"))
    return at.groupBy(*by).agg(area.alias("auc"))


def auc_pr(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area under precision over recall, starting at precision 1."""
    at = threshold_points(counts, by)
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg_here")
    at = at.join(counts.select(*by, F.col("score").alias("threshold"), F.col("neg").alias("neg_here")), [*by, "threshold"])
    p_before = F.when(before_tp + before_fp > 0, ratio(before_tp, before_tp + before_fp)).otherwise(1.0)
    area = F.sum(ratio("pos", "n_pos") * (F.col("precision") + p_before) / 2)
    return at.groupBy(*by).agg(area.alias("auc"))
