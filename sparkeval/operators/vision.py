"""Masks, keypoints, tracks, faces, 3D difficulty, and image and box properties."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions import boxes
from sparkeval.functions.ratios import f1_score, precision, ratio, recall
from sparkeval.operators import curves
from sparkeval.operators.blocks import box_pair_sums
from sparkeval.operators.running import running
from sparkeval.operators.strata import bin_even


# -- masks ---------------------------------------------------------------------
def pixels(df: DataFrame, *arrays: str) -> DataFrame:
    """One row per pixel of aligned arrays; the rows of an image stay in its partition."""
    return df.select("image_id", F.posexplode(F.arrays_zip(*arrays)).alias("pos", "_p")).select("image_id", "pos", "_p.*")


def mask_counts(df: DataFrame, threshold: float = 0.5, gt: str = "gt", prob: str = "prob") -> DataFrame:
    """(image_id, tp, fp, fn, precision, recall, f1, iou) of thresholded masks."""
    g, p = F.col(gt), F.col(prob) >= threshold
    counts = pixels(df, gt, prob).groupBy("image_id").agg(F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"))
    return counts.select(
        "*", precision("tp", "fp").alias("precision"), recall("tp", "fn").alias("recall"), f1_score("tp", "fp", "fn").alias("f1"),
        ratio("tp", F.col("tp") + F.col("fp") + F.col("fn")).alias("iou"),
    )


def pixel_threshold_points(df: DataFrame, points: int = 100) -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1) at evenly spaced thresholds over all pixels."""
    p = pixels(df, "gt", "prob").where("prob IS NOT NULL")
    step = points - 1
    k = F.floor(F.col("prob") * step)
    k = F.when(F.col("prob") < k / step, k - 1).when(F.col("prob") >= (k + 1) / step, k + 1).otherwise(k)
    hist = p.groupBy(k.cast("int").alias("k")).agg(F.count_if("gt").alias("pos"), F.count_if(~F.col("gt")).alias("neg"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("k"))
    down = W.orderBy(F.col("k").desc()).rowsBetween(W.unboundedPreceding, 0)
    full = grid.join(hist, "k", "left").fillna(0, ["pos", "neg"])
    at = full.select((F.col("k") / step).alias("threshold"), F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"))
    at = at.withColumn("fn", hist.agg(F.sum("pos")).scalar() - F.col("tp"))
    return at.select("*", precision("tp", "fp").alias("precision"), recall("tp", "fn").alias("recall"), f1_score("tp", "fp", "fn").alias("f1"))


def pixel_average_precision(points: DataFrame) -> DataFrame:
    """AP of the curve without its first and last point."""
    inner = points.where((F.col("threshold") > 0) & (F.col("threshold") < 1)).withColumn("_g", F.lit(1))
    return curves.average_precision_of(inner, ["_g"]).select("ap")


def image_properties(df: DataFrame, width: int, intensity: str = "intensity") -> DataFrame:
    """Brightness, contrast, pixel entropy (bits) and left-right symmetry of decoded grey images."""
    p = pixels(df, intensity).withColumn("v", F.col(intensity)).withColumn("level", F.floor(F.col(intensity)))
    basic = p.groupBy("image_id").agg(F.avg("v").alias("brightness"), F.stddev_pop("v").alias("contrast"), F.count("*").alias("size"))
    counts = p.groupBy("image_id", "level").agg(F.count("*").alias("n"))
    total = counts.join(basic.select("image_id", "size"), "image_id")
    share = F.col("n") / F.col("size")
    entropy = total.groupBy("image_id").agg((-F.sum(share * F.log2(share))).alias("entropy"))
    # Mirror column of pixel (r, c) is (r, width - 1 - c): an equal-size lookup in the same array.
    mirror = F.transform(F.sequence(F.lit(0), F.size(intensity) - 1), lambda i: F.get(F.col(intensity), (F.floor(i / width) * width + width - 1 - i % width).cast("int")))
    sym = pixels(df.withColumn("_m", mirror), intensity, "_m").groupBy("image_id").agg((1 - F.avg(F.abs(F.col(intensity) - F.col("_m"))) / 255).alias("symmetry"))
    h = F.ceil(F.col("size") / width)
    out = basic.join(entropy, "image_id").join(sym, "image_id")
    return out.select("*", F.lit(width).cast("long").alias("width"), h.alias("height"), (F.lit(width) / h).alias("aspect_ratio"))


def label_set_iou(df: DataFrame, gt: str = "gt", inf: str = "inf") -> DataFrame:
    """(label, both, either, iou) over two label arrays per row; the mean over labels is the macro IoU."""
    sides = df.select("id", F.explode(F.array_union(gt, inf)).alias("label"), gt, inf)
    hit = F.array_contains(gt, F.col("label")) & F.array_contains(inf, F.col("label"))
    out = sides.groupBy("label").agg(F.count_if(hit).alias("both"), F.count("*").alias("either"))
    return out.withColumn("iou", ratio("both", "either"))


def set_iou(a: str, b: str) -> Column:
    return ratio(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


# -- keypoints -----------------------------------------------------------------
def keypoint_distances(gt: str, inf: str) -> Column:
    """Distance per keypoint of two aligned point arrays."""
    return F.zip_with(gt, inf, lambda p, q: F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"])))


def keypoint_results(faces: DataFrame, images: DataFrame, nmse_threshold: float = 0.05) -> DataFrame:
    """Best face per image by NMSE and its outcome; images without a face fail to detect.

    ``faces``: image_id, face_idx, gt, inf (point arrays), norm; ``images``: image_id.
    """
    d = faces.withColumn("dist", keypoint_distances("gt", "inf"))
    squares = F.aggregate("dist", F.lit(0.0), lambda acc, x: acc + x * x) / F.size("dist")
    d = d.withColumn("mse", squares).withColumn("nmse", F.sqrt(F.col("mse")) / F.col("norm"))
    best = d.groupBy("image_id").agg(F.min_by(F.struct("face_idx", "dist", "mse", "nmse", "norm"), F.struct("nmse", "face_idx")).alias("f"))
    out = images.join(best, "image_id", "left").select("image_id", "f.*")
    outcome = F.when(F.col("nmse").isNull(), "failure_to_detect").when(F.col("nmse") > nmse_threshold, "failure_to_align").otherwise("success")
    return out.withColumn("outcome", outcome)


def keypoint_case(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean distances (``avg_dist``, an entry for each keypoint), mean MSE and NMSE, failure counts and rates per test case."""
    align, detect = F.count_if(F.col("outcome") == "failure_to_align"), F.count_if(F.col("outcome") == "failure_to_detect")
    cases = results.groupBy(*by).agg(
        F.avg("mse").alias("avg_mse"), F.avg("nmse").alias("avg_nmse"), align.alias("n_fail_to_align"), detect.alias("n_fail_to_detect"),
        F.count("*").alias("n_samples"), ((align + detect) / F.count("*")).alias("failure_rate"),
    )
    each = results.select(*by, F.posexplode("dist").alias("_point", "_dist")).groupBy(*by, "_point").agg(F.avg("_dist").alias("_avg"))
    means = each.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("_point", "_avg"))), lambda x: x["_avg"]).alias("avg_dist"))
    means = means.withColumnsRenamed({c: f"_by_{i}" for i, c in enumerate(by)})
    same = [F.col(c).eqNullSafe(F.col(f"_by_{i}")) for i, c in enumerate(by)]
    return cases.join(means, same, "left").drop(*[f"_by_{i}" for i in range(len(by))])


def keypoint_suite(cases: DataFrame) -> DataFrame:
    """One row: population variances of the cases' mean errors and failure rates."""
    n = F.col("n_samples")
    rates = {"average_mse": F.col("avg_mse"), "average_nmse": F.col("avg_nmse"), "detection_failure_rate": F.col("n_fail_to_detect") / n, "alignment_failure_rate": F.col("n_fail_to_align") / n, "failure_rate": F.col("failure_rate")}
    return cases.agg(*[F.var_pop(c).alias(f"variance_{name}") for name, c in rates.items()])


# -- tracks --------------------------------------------------------------------
RISK_LOW_AREA, RISK_HIGH_AREA, HIGH_RISK = 1000.0, 45000.0, 0.9  # fixed values of the risk score
MIN_BOX_AREA = 100.0


def risk(df: DataFrame, track: Sequence[str]) -> DataFrame:
    """Drop tiny boxes; risk of a track from its largest box, clipped to [0, 1], and its level."""
    kept = df.withColumn("area", boxes.area(F.col("geom"))).where(F.col("area") > MIN_BOX_AREA)
    top = kept.groupBy(*track).agg(F.max("area").alias("_top"))
    score = F.least(F.greatest((F.col("_top") - RISK_LOW_AREA) / (RISK_HIGH_AREA - RISK_LOW_AREA), F.lit(0.0)), F.lit(1.0))
    return kept.join(top, list(track)).withColumn("risk_score", score).withColumn("risk", F.when(score > HIGH_RISK, "high").otherwise("low")).drop("_top")


def lookup_predictions(frames: DataFrame, predictions: DataFrame, on: Sequence[str]) -> DataFrame:
    """Score per (track, frame); frames without a prediction fail to infer and score 0."""
    j = frames.join(predictions.withColumn("_hit", F.lit(True)), list(on), "left")
    failed = F.col("_hit").isNull()
    return j.withColumn("failed_to_infer", failed).withColumn("score", F.when(failed, 0.0).otherwise(F.col("score"))).drop("_hit")


def carry_forward(df: DataFrame, track: Sequence[str], frame: str, observation_frames: int = 16) -> DataFrame:
    """Failed frames take the last valid confidence of their track.

    Frames are in observation until the first valid score or frame number 17; after it a frame stays
    failed only while no valid score was seen. Tracks are cut into frame ranges, so a long one is no hot spot.
    """
    order = f"_{frame}"
    valid = F.when(~F.col("failed_to_infer") & F.col("score").isNotNull(), F.struct(F.col(frame).cast("double").alias("at"), F.col("score").alias("s")))
    df = df.withColumn(order, F.col(frame).cast("double"))
    done = F.when(~F.col("failed_to_infer"), F.lit(1)).otherwise(0)
    run = running(df, track, order, {"_n": F.lit(1), "_done": done}, descending=False)
    run = running(run, track, order, {"_last": valid}, descending=False, how="max")
    observing = (F.col("_done") == 0) & (F.col("_n") <= observation_frames + 1)
    seen = F.col("_last").isNotNull()
    out = run.withColumn("confidence", F.when(~F.col("failed_to_infer"), F.col("score")).otherwise(F.coalesce(F.col("_last.s"), F.lit(0.0))))
    out = out.withColumn("observation", observing).withColumn("failed", F.col("failed_to_infer") & ~observing & ~seen)
    return out.drop(order, "_n", "_done", "_last")


# -- 3D difficulty -------------------------------------------------------------
# Least box height, most occlusion, most truncation per level; overlap per class.
DIFFICULTY = {"easy": (40.0, 0, 0.15), "moderate": (25.0, 1, 0.3), "hard": (25.0, 2, 0.5)}
CLASS_OVERLAP = {"Car": 0.7, "Pedestrian": 0.5, "Cyclist": 0.5}


def difficulty_level(height: Column, occlusion: Column, truncation: Column) -> Column:
    level = F.lit("ignored")
    for name in ("hard", "moderate", "easy"):
        h, o, t = DIFFICULTY[name]
        level = F.when((height >= h) & (occlusion <= o) & (truncation <= t), name).otherwise(level)
    return level


# -- box groups ----------------------------------------------------------------
def box_properties(df: DataFrame, width: float, height: float) -> DataFrame:
    """Aspect ratio, relative area and relative distance to the image centre per box."""
    b = F.col("geom")
    cx, cy = (b["x1"] + b["x2"]) / 2, (b["y1"] + b["y2"]) / 2
    off = F.sqrt(F.pow(cx - width / 2, F.lit(2)) + F.pow(cy - height / 2, F.lit(2))) / (math.hypot(width, height) / 2)
    return df.select("*", boxes.aspect_ratio(b).alias("aspect_ratio"), (boxes.area(b) / (width * height)).alias("relative_area"), off.alias("relative_distance"))


def box_group_properties(df: DataFrame, width: float, height: float, grid: int = 3) -> DataFrame:
    """Per image: counts, area and shape statistics, spread over a 3x3 grid, and pairwise sums."""
    p = box_properties(df, width, height)
    b = F.col("geom")
    stats = p.groupBy("image_id").agg(
        F.count("*").alias("objects"), F.count_distinct("label").alias("types"), F.sum("relative_area").alias("combined_area"),
        *[f(c).alias(f"{n}_{c}") for c in ("aspect_ratio", "relative_area", "relative_distance") for n, f in (("mean", F.avg), ("std", F.stddev_pop))],
    )
    cell = lambda lo, hi, size: bin_even((b[lo] + b[hi]) / 2, F.lit(0.0), F.lit(float(size)), grid)
    cells = df.groupBy("image_id", cell("x1", "x2", width).alias("cx"), cell("y1", "y2", height).alias("cy")).agg(F.count("*").alias("n"))
    sizes = cells.groupBy("image_id").agg(F.sum("n").alias("all"))
    share = F.col("n") / F.col("all")
    entropy = cells.join(sizes, "image_id").groupBy("image_id").agg((-F.sum(share * F.log2(share))).alias("entropy"))
    pairs = box_pair_sums(df)
    mean = F.try_divide(F.col("dist"), F.col("n"))
    var = F.when(F.col("n") > 0, F.greatest(F.try_divide(F.col("dist2"), F.col("n")) - mean * mean, F.lit(0.0)))
    pairs = pairs.select("image_id", F.col("iou").alias("pair_iou"), mean.alias("mean_distance"), F.sqrt(var).alias("std_distance"))
    return stats.join(entropy, "image_id").join(pairs, "image_id", "left")


# -- pair verification ---------------------------------------------------------
def pair_verdicts(df: DataFrame, threshold: Column | float, is_match: str = "is_match", similarity: str = "similarity") -> DataFrame:
    """Match verdicts and error rates per pair; a rate is null where it does not apply."""
    m, p = F.col(is_match), F.col(similarity) > threshold
    return df.select(
        "*", p.alias("is_predicted_match"), (m & p).alias("is_tm"), (~m & ~p).alias("is_tnm"), (~m & p).alias("is_fm"), (m & ~p).alias("is_fnm"),
        F.when(~m, p.cast("int")).alias("fmr"), F.when(m, (~p).cast("int")).alias("fnmr"),
    )


def pair_metrics(verdicts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Genuine and imposter counts with false match and non-match rates."""
    out = verdicts.groupBy(*by).agg(
        F.count_if("is_match").alias("genuine"), F.count_if(~F.col("is_match")).alias("imposter"), F.count_if("is_fm").alias("fm"), F.count_if("is_fnm").alias("fnm")
    )
    return out.withColumn("fmr", ratio("fm", "imposter")).withColumn("fnmr", ratio("fnm", "genuine"))


def face_case_metrics(pairs: DataFrame, samples: DataFrame, threshold: float, baseline_fnmr: float) -> DataFrame:
    """One row: pair counts, false matches and non-matches, pair failures and failures to enroll with their rates, and the change of FNMR.

    ``pairs`` (a, b, is_match, similarity) list each pair from one or both of its images; the listing of the image that comes
    last decides, and a pair without similarity is a pair failure. ``samples`` (image_id, failed) say which images failed to
    enroll by box or to align by keypoints; a pair listed by one of those, or itself without similarity, fails to enroll.
    """
    own = samples.select(F.col("image_id").alias("a"), "failed")
    listed = pairs.join(own, "a", "left").withColumn("failed", F.coalesce("failed", F.lit(False)) | F.col("similarity").isNull())
    last = F.max_by(F.struct("is_match", "similarity", "failed"), "a").alias("v")
    unique = listed.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(last).select("v.*")
    verdicts = pair_verdicts(unique, threshold)
    counts = verdicts.agg(
        F.count("*").alias("pairs"), F.count_if("is_match").alias("genuine"), F.count_if(~F.col("is_match")).alias("imposter"), F.count_if("is_fm").alias("fm"), F.count_if("is_fnm").alias("fnm"),
        F.count_if(F.col("similarity").isNull()).alias("pair_failures"), F.count_if("failed").alias("fte"),
    )
    out = counts.crossJoin(samples.agg(F.count("*").alias("_samples")))  # two single rows
    fnmr = ratio("fnm", "genuine")
    return out.select(
        "pairs", "genuine", "imposter", "fm", "fnm", ratio("fm", "imposter").alias("fmr"), fnmr.alias("fnmr"), (fnmr - baseline_fnmr).alias("delta_fnmr"),
        "pair_failures", ratio("pair_failures", "pairs").alias("pair_failure_rate"), "fte", ratio("fte", "_samples").alias("fter"),
    )


def thresholds_at_fmr(df: DataFrame, rates: Sequence[float], eps: float = 1e-9) -> DataFrame:
    """(fmr, threshold): score of the imposter at the rank the rate allows; every pair is listed twice, so ranks go in twos.

    Ranks come from running counts per distinct score, so imposters are never sorted in one task.
    """
    scores = df.where("NOT is_match").select(F.coalesce("similarity", F.lit(0.0)).alias("score"))
    counts = curves.score_counts(scores, [], F.lit(True), F.col("score"))
    cum = running(counts, [], "score", {"upto": F.col("pos")}).withColumn("total", counts.agg(F.sum("pos")).scalar())
    n = F.col("total")
    # Python rounds halves to even, as does bround; rank 0 falls back to the list's end, two before it.
    idx = lambda r: (F.bround(F.lit(float(r)) * n / 2) - 1) * 2
    ranks = F.array(*[F.struct(F.lit(float(r)).alias("fmr"), F.when(idx(r) < 0, n + idx(r)).otherwise(idx(r)).cast("long").alias("k")) for r in rates])
    hit = F.filter(ranks, lambda t: (t["k"] >= F.col("upto") - F.col("pos")) & (t["k"] < F.col("upto")))
    return cum.select("score", F.explode(hit).alias("t")).select("t.fmr", (F.col("score") - eps).alias("threshold"))
