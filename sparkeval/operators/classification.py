"""Classification metrics: averages over classes, confusion matrices, threshold curves, kappa."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions.ratios import accuracy, f1_score, precision, ratio, recall
from sparkeval.functions.search import cuts_below
from sparkeval.operators import curves
from sparkeval.operators.detection import dense_matrix
from sparkeval.operators.running import following, running
from sparkeval.session import materialize


def confusion_counts(df: DataFrame, by: Sequence[str] = (), gt: str = "gt", pred: str = "pred") -> DataFrame:
    """(by, actual, predicted, n): one shuffle of pre-aggregated counts feeds every class metric."""
    return df.groupBy(*by, F.col(gt).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))


def class_counts(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, label, tp, fp, fn, tn) one-vs-rest from confusion counts."""
    by = list(by)
    sides = cells.select(
        *by, "n", F.explode(F.array(
            F.struct(F.col("actual").alias("label"), F.lit(True).alias("is_gt"), F.col("actual").eqNullSafe(F.col("predicted")).alias("hit")),
            F.struct(F.col("predicted").alias("label"), F.lit(False).alias("is_gt"), F.col("actual").eqNullSafe(F.col("predicted")).alias("hit")),
        )).alias("s"),
    ).select(*by, "n", "s.*").where("label IS NOT NULL")
    n = F.col("n")
    out = sides.groupBy(*by, "label").agg(
        F.sum(F.when(F.col("is_gt") & F.col("hit"), n).otherwise(0)).alias("tp"),
        F.sum(F.when(~F.col("is_gt") & ~F.col("hit"), n).otherwise(0)).alias("fp"),
        F.sum(F.when(F.col("is_gt") & ~F.col("hit"), n).otherwise(0)).alias("fn"),
    )
    total = cells.groupBy(*by).agg(F.sum("n").alias("_all"))
    out = out.join(total, by) if by else out.withColumn("_all", total.scalar())
    return out.withColumn("tn", F.col("_all") - F.col("tp") - F.col("fp") - F.col("fn")).drop("_all")


def class_rates(counts: DataFrame) -> DataFrame:
    return counts.select(
        "*", accuracy("tp", "fp", "fn", "tn").alias("accuracy"), precision("tp", "fp").alias("precision"),
        recall("tp", "fn").alias("recall"), f1_score("tp", "fp", "fn").alias("f1"),
    )


def averaged(counts: DataFrame, by: Sequence[str] = (), average: str = "macro") -> DataFrame:
    """Precision, recall and F1 as macro, micro or support-weighted average over classes."""
    if average == "micro":
        sums = counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
        return sums.select(*by, precision("tp", "fp").alias("precision"), recall("tp", "fn").alias("recall"),
                           f1_score("tp", "fp", "fn").alias("f1"))
    weight = F.col("tp") + F.col("fn") if average == "weighted" else F.lit(1)
    rates = class_rates(counts).withColumn("_w", weight)
    return rates.groupBy(*by).agg(*[(F.sum(F.col(c) * F.col("_w")) / F.sum("_w")).alias(c) for c in ("precision", "recall", "f1")])


def binary_counts(df: DataFrame, by: Sequence[str], threshold: float, gt: str = "gt", score: str = "score") -> DataFrame:
    g, p = F.col(gt), F.col(score) >= threshold
    return df.groupBy(*by).agg(
        F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"), F.count_if(~g & ~p).alias("tn")
    )


def binary_metrics(df: DataFrame, by: Sequence[str], threshold: float, gt: str = "gt", score: str = "score") -> DataFrame:
    """Rates at the threshold plus AUC per group."""
    rates = class_rates(binary_counts(df, by, threshold, gt, score))
    auc = curves.auc_roc(curves.score_counts(df, by, F.col(gt), F.col(score)), by)
    return rates.join(auc, list(by), "left")


def confusion_matrix(df: DataFrame, labels: Sequence[str] | None = None, gt: str = "gt", pred: str = "pred") -> DataFrame:
    """Dense matrix over the labels present, or over a given list; no rows below two labels."""
    cells = confusion_counts(df, (), gt, pred)
    if labels is not None:
        names = df.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    else:
        names = cells.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct()
    return dense_matrix(cells, names)


def normalized(matrix: DataFrame, how: str) -> DataFrame:
    """Confusion matrix as shares of its row, its column or everything."""
    part = {"row": ["actual"], "column": ["predicted"], "all": []}[how]
    return matrix.withColumn("share", ratio("n", F.sum("n").over(W.partitionBy(*part))))


def cohens_kappa(cells: DataFrame) -> DataFrame:
    """Agreement beyond chance from confusion counts."""
    label = F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("a"), F.col("n").alias("p")),
    )).alias("s")
    margins = cells.select(label).select("s.*").groupBy("label").agg(F.sum("a").alias("a"), F.sum("p").alias("p"))
    chance = margins.agg(F.sum(F.col("a").cast("double") * F.col("p"))).scalar()
    seen = cells.agg(F.sum("n").cast("double").alias("n"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("ok"))
    seen = seen.withColumn("po", F.col("ok") / F.col("n")).withColumn("pe", chance / (F.col("n") * F.col("n")))
    return seen.select("po", "pe", F.try_divide(F.col("po") - F.col("pe"), 1 - F.col("pe")).alias("kappa"))


def kappa_2x2(counts: DataFrame) -> DataFrame:
    """Two-class kappa from TP, FP, FN, TN."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumn("kappa", F.try_divide(2 * (tp * tn - fn * fp), (tp + fp) * (fp + tn) + (tp + fn) * (fn + tn)))


def thin_thresholds(df: DataFrame, score: str = "score", gap: float = 0.01) -> list[float]:
    """0, then multiples of 0.1 and distinct scores in order, each at least ``gap`` above the one taken before.

    The first one taken is the smallest that is ``gap`` away from 0, so scores below 0 count; null and NaN scores do not.
    Every value points to the first value ``gap`` above it; the pointers are followed from the first in steps that double, so
    the number of jobs grows with the logarithm of the list, and only the list reaches the driver.
    """
    own = df.select(F.col(score).cast("double").alias("s")).where("s IS NOT NULL AND NOT isnan(s)")
    values = own.unionAll(df.sparkSession.range(11).selectExpr("id / 10D AS s")).distinct()
    # The sum s + gap may be rounded up past the value that is exactly gap above: look from a little below, and one further.
    probes = values.selectExpr("s + CAST({0} AS DOUBLE) - 1e-12 * greatest(1, abs(s)) AS at".format(gap), "CAST(NULL AS DOUBLE) AS s")
    points = values.selectExpr("s AS at", "s").unionAll(probes).groupBy("at").agg(F.max("s").alias("s"))
    ahead = running(points, [], "at", {"up": -F.col("s")}, how="max").select("at", (-F.col("up")).alias("up"))
    after = following(values, [], "s", ["s"], descending=False).select(F.col("s").alias("up"), F.col("next.s").alias("then"))
    at = values.withColumn("at", F.expr("s + CAST({0} AS DOUBLE) - 1e-12 * greatest(1, abs(s))".format(gap)))
    far = at.join(ahead, "at").join(after, "up", "left")
    step = materialize(far.select("s", F.when(F.col("up") - F.col("s") >= gap, F.col("up")).otherwise(F.col("then")).alias("up")), "thresholds")
    first = values.where(F.abs("s") >= gap).agg(F.min("s")).first()[0]
    kept, size = {first}, 0
    while len(kept) > size:
        size = len(kept)
        reached = df.sparkSession.createDataFrame([(x,) for x in sorted(kept)], "s double")
        kept |= {r.up for r in step.join(reached, "s").where("up IS NOT NULL").select("up").collect()}
        far = step.alias("x").join(step.alias("y"), F.col("x.up") == F.col("y.s")).select("x.s", "y.up")
        step = materialize(far, "thresholds")
    return [0.0, *sorted(kept)]


def threshold_curves(df: DataFrame, thresholds: Sequence[float], gt: str = "gt", score: str = "score") -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1) at given thresholds.

    Rows are counted by the last threshold they reach; running sums over that short list give each point.
    """
    ts = sorted(set(thresholds))
    level = cuts_below(f"`{score}`", ts)
    hist = df.groupBy(level.alias("level")).agg(F.count_if(F.col(gt)).alias("pos"), F.count_if(~F.col(gt)).alias("neg"))
    grid = df.sparkSession.createDataFrame([(i + 1, float(t)) for i, t in enumerate(ts)], "level int, threshold double")
    down = W.orderBy(F.col("level").desc()).rowsBetween(W.unboundedPreceding, 0)
    full = grid.join(hist, "level", "left").fillna(0, ["pos", "neg"])
    total = hist.agg(F.sum("pos")).scalar()
    at = full.select("threshold", F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"))
    at = at.withColumn("fn", total - F.col("tp"))
    return at.select("*", precision("tp", "fp").alias("precision"), recall("tp", "fn").alias("recall"), f1_score("tp", "fp", "fn").alias("f1"))
