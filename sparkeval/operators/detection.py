"""Object-detection results from matches: counts, per-image metrics, thresholds, per-class tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkeval.functions import boxes
from sparkeval.functions.ratios import f1_score, precision, recall
from sparkeval.functions.search import cuts_below
from sparkeval.operators import curves
from sparkeval.operators.matching import match, match_multiclass
from sparkeval.session import materialize

F1_OPTIMAL = "F1-Optimal"


def filter_inferences(infs: DataFrame, confidence_score: float | None = None, labels: Sequence[str] | None = None) -> DataFrame:
    """Inferences at or above a confidence (0 and None keep all) and, if given, of the labels."""
    if confidence_score:
        infs = infs.where(F.col("score") >= confidence_score)
    return infs.where(F.col("label").isin(list(labels))) if labels is not None else infs


def with_boxes(df: DataFrame) -> DataFrame:
    """Replace corner columns by a ``geom`` struct."""
    return df.withColumn("geom", boxes.box()).drop("x1", "y1", "x2", "y2")


def explode_objects(df: DataFrame, column: str, index: str, image: str = "image_id") -> DataFrame:
    """One row per object of an array column, with its position."""
    return df.select(F.col(image).alias("image_id"), F.posexplode(column).alias(index, "_o")).select("image_id", index, "_o.*")


def flag_ignored(gts: DataFrame, prop: str | None) -> DataFrame:
    """``is_ignored`` where a boolean property of the ground truth is true."""
    usable = prop is not None and prop in gts.columns and dict(gts.dtypes)[prop] == "boolean"
    return gts.withColumn("is_ignored", F.coalesce(F.col(prop), F.lit(False)) if usable else F.lit(False))


def label_of() -> Column:
    """Label a match counts under: the inference's, or the ground truth's if there is none."""
    return F.when(F.col("kind").isin("unmatched_gt", "confused"), F.col("gt.label")).otherwise(F.col("inf.label"))


def _outcomes(threshold: Column) -> list[Column]:
    """TP/FP/FN/confused count aggregates at a confidence threshold."""
    kind, above = F.col("kind"), F.col("inf.score") >= threshold
    return [
        F.count_if((kind == "matched") & above).alias("tp"),
        F.count_if((kind == "unmatched_inf") & above).alias("fp"),
        F.count_if(kind.isin("unmatched_gt", "confused") | ((kind == "matched") & ~above)).alias("fn"),
        F.count_if((kind == "confused") & above).alias("confused"),
    ]


def outcome_counts(matches: DataFrame, by: Sequence[str], threshold: float) -> DataFrame:
    """TP/FP/FN/confused counts at a confidence threshold, one pass over the matches."""
    return matches.groupBy(*by).agg(*_outcomes(F.lit(threshold)))


def with_rates(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("precision", precision("tp", "fp"))
        .withColumn("recall", recall("tp", "fn"))
        .withColumn("f1", f1_score("tp", "fp", "fn"))
    )


def image_metrics(matches: DataFrame, thresholds: DataFrame | float, fallback: float = 0.0) -> DataFrame:
    """Per-image TP/FP/FN/confused counts, flags and the confidence range of kept inferences.

    ``thresholds`` is one number or a table (label, threshold); labels not in it use ``fallback``.
    """
    found = matches.where("kind <> 'ignored'").withColumn("label", F.coalesce("inf.label", "gt.label"))
    if isinstance(thresholds, DataFrame):
        found = found.join(thresholds.select("label", F.col("threshold").alias("_t")), "label", "left")
        t = F.coalesce("_t", F.lit(fallback))
    else:
        t = F.lit(float(thresholds))
    kept = F.col("kind").isin("matched", "unmatched_inf") & (F.col("inf.score") >= t)
    score = F.when(kept, F.col("inf.score"))
    out = found.groupBy("image_id").agg(*_outcomes(t), F.max(score).alias("max_confidence"), F.min(score).alias("min_confidence"))
    for n in ("tp", "fp", "fn", "confused"):
        out = out.withColumn(f"has_{n}", F.col(n) > 0)
    return out


def threshold_grid(infs: DataFrame, points: int = curves.CURVE_POINTS, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold): the raw scores with their repeats, or evenly spaced ones where a group has at least ``points`` scores."""
    by = list(by)
    scores = infs.where("score IS NOT NULL")
    span = scores.groupBy(*by).agg(F.count("score").alias("_n"), F.min("score").alias("_lo"), F.max("score").alias("_hi"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("_k")
    step = F.col("_lo") + F.col("_k") * (F.col("_hi") - F.col("_lo")) / (points - 1)
    even = span.where(F.col("_n") >= points).select(*by, "_lo", "_hi", grid).select(*by, F.when(F.col("_k") == points - 1, F.col("_hi")).otherwise(step).alias("threshold"))
    small = span.where(F.col("_n") < points).select(*by, F.lit(1).alias("_few"))
    few = scores.join(small, by, "left_semi") if by else scores.where(span.select(F.col("_n") < points).scalar())
    return even.unionByName(few.select(*by, F.col("score").alias("threshold")))


def thresholded_counts(matches: DataFrame, grid: Sequence[float], by: Sequence[str] = ("image_id", "label")) -> DataFrame:
    """(by, threshold, tp, fp, fn) for every threshold of a bounded grid.

    Each match is expanded only over the grid positions at or below its own score; counts at the
    other positions follow from the group totals.
    """
    found = matches.where("kind <> 'ignored'").withColumn("label", label_of())
    grid = sorted(set(float(g) for g in grid))
    cuts = F.array(*[F.lit(g) for g in grid])
    kind = F.col("kind")
    level = F.when(kind.isin("matched", "unmatched_inf"), cuts_below("inf.score", grid)).otherwise(0)
    levels = found.groupBy(*by, level.alias("level")).agg(
        F.count_if(kind == "matched").alias("m"), F.count_if(kind == "unmatched_inf").alias("u"),
        F.count_if(kind.isin("unmatched_gt", "confused")).alias("g"),
    )
    # A group has at most one row per grid level, so its arrays are bounded by the grid.
    packed = levels.groupBy(*by).agg(F.collect_list(F.struct("level", "m", "u", "g")).alias("ls"))
    at = packed.select(*by, "ls", F.posexplode(cuts).alias("pos", "threshold"))

    def total(field: str, cond) -> Column:
        return F.aggregate("ls", F.lit(0).cast("long"), lambda acc, x: acc + F.when(cond(x), x[field]).otherwise(0))

    return at.select(
        *by, "threshold", total("m", lambda x: x["level"] > F.col("pos")).alias("tp"),
        total("u", lambda x: x["level"] > F.col("pos")).alias("fp"),
        (total("g", lambda x: F.lit(True)) + total("m", lambda x: x["level"] <= F.col("pos"))).alias("fn"),
    )


def confusion_matrix(matches: DataFrame) -> DataFrame:
    """(actual, predicted, n) over the dense grid of labels; empty below two labels."""
    cells = (
        matches.where("kind IN ('matched', 'confused')")
        .groupBy(F.col("gt.label").alias("actual"), F.col("inf.label").alias("predicted"))
        .agg(F.count("*").alias("n"))
    )
    cells = cells.withColumn("predicted", F.col("predicted"))
    seen = matches.where("kind IN ('matched', 'confused', 'unmatched_gt')").select(F.col("gt.label").alias("label")).distinct()
    labels = seen.unionByName(cells.select(F.col("predicted").alias("label"))).distinct()
    return dense_matrix(cells, labels)


def dense_matrix(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """Fill a label x label matrix with zeros; no rows below two labels."""
    names = labels.agg(F.array_sort(F.collect_set("label")).alias("names"))
    grid = names.where(F.size("names") >= 2)
    grid = grid.select(F.explode("names").alias("actual"), "names").select("actual", F.explode("names").alias("predicted"))
    return grid.join(cells, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def class_metrics(
    matches: DataFrame, thresholds: DataFrame, cases: Sequence[str] = ("test_case",), fallback: float = 0.0
) -> DataFrame:
    """Per (test case, label): images, objects, inferences, TP/FP/FN, rates and AP."""
    by = [*cases, "label"]
    found = matches.where("kind <> 'ignored'").withColumn("label", label_of())
    found = found.join(thresholds.select("label", "threshold"), "label", "left")
    found = found.withColumn("threshold", F.coalesce("threshold", F.lit(fallback)))
    kind, above = F.col("kind"), F.col("inf.score") >= F.col("threshold")
    # Images having the label: distinct first, so a hot label counts on many tasks.
    images = (
        found.where("kind <> 'unmatched_inf'").select(*by, "image_id").distinct().groupBy(*by).agg(F.count("*").alias("n_images"))
    )
    counts = found.groupBy(*by).agg(
        F.max("threshold").alias("threshold"),
        F.count_if(kind != "unmatched_inf").alias("objects"),
        F.count_if(kind.isin("matched", "unmatched_inf") & above).alias("inferences"),
        F.count_if((kind == "matched") & above).alias("tp"),
        F.count_if((kind == "unmatched_inf") & above).alias("fp"),
        F.count_if(kind.isin("unmatched_gt", "confused") | ((kind == "matched") & ~above)).alias("fn"),
    )
    ap = curves.average_precision(curves.detection_counts(matches, by), by)
    out = with_rates(counts.join(images, by, "left").join(ap, by, "left"))
    return out.withColumn("n_images", F.coalesce("n_images", F.lit(0).cast("long")))


def case_metrics(per_class: DataFrame, cases: Sequence[str] = ("test_case",)) -> DataFrame:
    """Macro and micro rates and mean AP per test case."""
    sums = per_class.groupBy(*cases).agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"), F.avg("ap").alias("mean_ap"),
    )
    return (
        sums.withColumn("micro_precision", precision("tp", "fp"))
        .withColumn("micro_recall", recall("tp", "fn"))
        .withColumn("micro_f1", f1_score("tp", "fp", "fn"))
    )


def group_of_match(gts: DataFrame, infs: DataFrame, iou_threshold: float = 0.5, within: Sequence[str] = ("label",)) -> DataFrame:
    """Matching with group-of ground truths and an image-level label filter.

    Inferences of labels the image was not annotated with are dropped; plain ground truths match first;
    of the leftovers that overlap a group-of box, the best counts as its match and the rest vanish.
    """
    known = gts.select("image_id", "label").distinct()
    infs = infs.join(known, ["image_id", "label"], "left_semi")
    plain = match(gts.where("NOT is_group").withColumn("is_ignored", F.lit(False)), infs, iou_threshold, within)
    plain = materialize(plain, "plain-matches")
    rest = plain.where("kind = 'unmatched_inf'").select("inf.*")
    groups = gts.where("is_group").withColumn("is_ignored", F.lit(False))
    second = match(groups, rest, iou_threshold, within)
    # Losers of a group-of box are neither right nor wrong: their overlap with a group is at or above the threshold.
    losers = second.where((F.col("kind") == "unmatched_inf") & (F.col("iou") >= iou_threshold))
    keep = second.where(~((F.col("kind") == "unmatched_inf") & (F.col("iou") >= iou_threshold)))
    return (
        plain.where("kind <> 'unmatched_inf'")
        .unionByName(keep)
        .unionByName(losers.withColumn("kind", F.lit("ignored")))
    )


def detection_results(
    gts: DataFrame,
    infs: DataFrame,
    iou_threshold: float = 0.5,
    threshold_strategy: str | float | dict[str, float] = 0.5,
    min_confidence_score: float = 0.5,
    multiclass: bool = True,
    required: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """Filter, match, choose thresholds and report per-image metrics."""
    infs = filter_inferences(infs, min_confidence_score)
    matches = (
        match_multiclass(gts, infs, iou_threshold, required, **kw) if multiclass else match(gts, infs, iou_threshold, required, **kw)
    )
    if isinstance(threshold_strategy, dict):
        rows = list(threshold_strategy.items())
        thresholds = gts.sparkSession.createDataFrame(rows, "label string, threshold double")
        if not multiclass:
            thresholds = float(rows[0][1])
    elif threshold_strategy == F1_OPTIMAL:
        if multiclass:
            thresholds = curves.optimal_f1(curves.detection_counts(matches), ["label"])
        else:
            best = curves.optimal_f1(curves.detection_counts(matches, []), [])
            labels = gts.select("label").unionAll(infs.select("label")).distinct()
            thresholds = labels.withColumn("threshold", best.scalar())
    else:
        thresholds = float(threshold_strategy)
    return image_metrics(matches, thresholds, fallback=min_confidence_score)
