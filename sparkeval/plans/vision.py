"""Queries on polygons, masks, keypoints, tracks, 3D boxes, faces, embeddings and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkeval.functions import boxes
from sparkeval.functions.ratios import r6, rounded
from sparkeval.functions.vectors import dot
from sparkeval.operators import blocks, detection, joins, levels, matching, polygons, similarity, vision
from sparkeval.plans import detection as det
from sparkeval.plans import views
from sparkeval.plans.detection import DET_RESULTS, IMAGE_MULTI, IOU, match_sql
from sparkeval.plans.registry import query
from sparkeval.session import shared, table


# -- polygons: diamonds inside the boxes, which are boxes again in (x + y, x - y) ----
def diamonds(df):
    g = F.col("geom")
    cx, cy = (g["x1"] + g["x2"]) / 2, (g["y1"] + g["y2"]) / 2
    points = [(cx, g["y1"]), (g["x2"], cy), (cx, g["y2"]), (g["x1"], cy)]
    return df.withColumn("geom", F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in points]))


def turned(view):
    return f"""SELECT * REPLACE ((x1 + x2) / 2 + y1 AS x1, (x1 + x2) / 2 + y2 AS x2, (x1 + x2) / 2 - y2 AS y1, (x1 + x2) / 2 - y1 AS y2) FROM {view}"""


DIAMONDS = f"p_gt AS ({turned('w_det_gt')}), p_inf AS ({turned('w_det_inf')})"


@query("d03_polygon_iou", f"SELECT g.image_id, g.gt_idx, i.inf_idx, round({IOU}, 6) AS iou FROM p_gt g JOIN p_inf i ON g.image_id = i.image_id WHERE {IOU} > 1e-9", ctes=DIAMONDS)
def d03(spark, sf):
    pairs = matching.overlapping(diamonds(det.gts(spark, sf)), diamonds(det.infs(spark, sf)), ["image_id"], polygon=True)
    pairs = pairs.withColumn("iou", polygons.polygon_iou(F.col("a.geom"), F.col("b.geom"))).where("iou > 1e-9")
    return pairs.select("image_id", "a.gt_idx", "b.inf_idx", r6("iou").alias("iou"))


@query("d16_instance_segmentation", IMAGE_MULTI, ctes=f"p_gt AS ({turned('w_det_gt')}), p_inf AS ({turned('w_det_inf WHERE score >= 0.2')}),\n" + DET_RESULTS.replace("f_inf", "p_inf").replace("w_det_gt", "p_gt"))
def d16(spark, sf):
    return detection.detection_results(
        diamonds(det.gts(spark, sf)), diamonds(det.infs(spark, sf)), threshold_strategy=detection.F1_OPTIMAL, min_confidence_score=0.2,
        overlaps=polygons.polygon_overlaps,
    )


# -- masks -------------------------------------------------------------------------
MASKS = """mk AS (SELECT image_id, count(*) FILTER (WHERE gt AND prob >= 0.5) AS tp, count(*) FILTER (WHERE NOT gt AND prob >= 0.5) AS fp, count(*) FILTER (WHERE gt AND prob < 0.5) AS fn FROM w_mask GROUP BY 1)"""


def masks(spark, sf):
    return views.mask(spark, sf).where("prob IS NOT NULL")


@query("d17_mask_metrics", """SELECT image_id, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
  FROM mk WHERE image_id + 1 IN (SELECT vec_id FROM embeddings)""", ctes=MASKS)  # fmt: skip
def d17(spark, sf):
    return vision.mask_counts(masks(spark, sf)).select("image_id", "tp", "fp", "fn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("d18_mask_iou", "SELECT image_id, round(tp / (tp + fn + fp), 6) AS iou FROM mk WHERE image_id + 1 IN (SELECT vec_id FROM embeddings)", ctes=MASKS)
def d18(spark, sf):
    return vision.mask_counts(masks(spark, sf)).select("image_id", r6("iou").alias("iou"))


SETS = """sets AS (SELECT order_id AS id, list(DISTINCT gt) AS g, list(DISTINCT pred) AS p FROM w_cls GROUP BY 1)"""


def label_sets(spark, sf):
    # Labels are a fixed few, so a set per order is small however many rows the order has.
    return views.cls(spark, sf).groupBy(F.col("order_id").alias("id")).agg(F.collect_set("gt").alias("gt"), F.collect_set("pred").alias("inf"))


@query("d19_label_set_iou", """SELECT label, count(*) FILTER (WHERE list_contains(g, label) AND list_contains(p, label)) AS both, count(*) FILTER (WHERE list_contains(g, label) OR list_contains(p, label)) AS either,
  round(count(*) FILTER (WHERE list_contains(g, label) AND list_contains(p, label)) / count(*) FILTER (WHERE list_contains(g, label) OR list_contains(p, label)), 6) AS iou FROM sets, (VALUES ('A'), ('N'), ('R')) l(label) GROUP BY 1""", ctes=SETS)  # fmt: skip
def d19(spark, sf):
    return vision.label_set_iou(label_sets(spark, sf)).withColumn("iou", r6("iou"))


@query("d20_set_iou", "SELECT id, round(len(list_intersect(g, p)) / len(list_distinct(list_concat(g, p))), 6) AS iou FROM sets", ctes=SETS)
def d20(spark, sf):
    return label_sets(spark, sf).select("id", r6(vision.set_iou("gt", "inf")).alias("iou"))


PXP = """px AS (SELECT t.k, count(*) FILTER (WHERE gt AND prob >= t.k / 99.0) AS tp, count(*) FILTER (WHERE NOT gt AND prob >= t.k / 99.0) AS fp, count(*) FILTER (WHERE gt AND prob < t.k / 99.0) AS fn
  FROM w_mask, range(100) t(k) WHERE prob IS NOT NULL AND image_id + 1 IN (SELECT vec_id FROM embeddings) GROUP BY 1),
pr AS (SELECT k, tp, fp, fn, coalesce(tp / nullif(tp + fp, 0), 0) AS p, tp / (tp + fn) AS r FROM px)"""


@query("e45_pixel_curve", "SELECT k AS step, tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall FROM pr", ctes=PXP)
def e45(spark, sf):
    at = vision.pixel_threshold_points(masks(spark, sf))
    return at.select(F.round(F.col("threshold") * 99).cast("long").alias("step"), "tp", "fp", "fn", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("e45_pixel_average_precision", """SELECT round(sum((r - pr0) * best), 6) AS ap FROM (SELECT r, coalesce(lag(r) OVER (ORDER BY r), 0) AS pr0, max(p) OVER (ORDER BY r DESC) AS best FROM (SELECT r, max(p) AS p FROM pr WHERE k BETWEEN 1 AND 98 GROUP BY 1))""", ctes=PXP)
def e45b(spark, sf):
    return vision.pixel_average_precision(vision.pixel_threshold_points(masks(spark, sf))).select(r6("ap").alias("ap"))


IMG = """b AS (SELECT image_id, avg(intensity) AS brightness, stddev_pop(intensity) AS contrast, count(*) AS size FROM w_mask GROUP BY 1),
lv AS (SELECT image_id, floor(intensity) AS l, count(*) AS n FROM w_mask GROUP BY 1, 2),
en AS (SELECT image_id, -sum(n / 64.0 * log2(n / 64.0)) AS entropy FROM lv GROUP BY 1),
sy AS (SELECT a.image_id, 1 - avg(abs(a.intensity - m.intensity)) / 255 AS symmetry FROM w_mask a JOIN w_mask m ON a.image_id = m.image_id AND m.pos = a.pos - a.pos % 8 + 7 - a.pos % 8 GROUP BY 1)"""


@query("d32_image_properties", """SELECT image_id, round(brightness, 5) AS brightness, round(contrast, 5) AS contrast, size, 8 AS width, 8 AS height, 1.0::DOUBLE AS aspect_ratio, round(entropy, 5) AS entropy, round(symmetry, 5) AS symmetry
  FROM b JOIN en USING (image_id) JOIN sy USING (image_id)""", ctes=IMG)  # fmt: skip
def d32(spark, sf):
    p = vision.image_properties(views.mask(spark, sf).select("image_id", "intensity"), 8)
    return p.select("image_id", "size", "width", "height", "aspect_ratio", *[F.round(c, 5).alias(c) for c in ("brightness", "contrast", "entropy", "symmetry")])


# -- keypoints ---------------------------------------------------------------------
KP = """fc AS (SELECT l_orderkey AS image_id, l_linenumber AS face_idx, (l_partkey % 7 - 3) * 0.1 AS dx, (l_suppkey % 5 - 2) * 0.1 AS dy, 10.0 + l_orderkey % 5 AS norm FROM w_line),
kd AS (SELECT image_id, face_idx, norm, avg(dx * dx * i * i + dy * dy) AS mse, sqrt(avg(dx * dx * i * i + dy * dy)) / norm AS nmse, max(dx) AS dx, max(dy) AS dy FROM fc, range(1, 6) t(i) GROUP BY 1, 2, 3),
kb AS (SELECT * FROM kd QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY round(nmse, 12), face_idx) = 1),
kr AS (SELECT o_orderkey AS image_id, o_orderpriority AS priority, face_idx, mse, nmse, dx, dy, CASE WHEN nmse IS NULL THEN 'failure_to_detect' WHEN nmse > 0.05 THEN 'failure_to_align' ELSE 'success' END AS outcome FROM orders LEFT JOIN kb ON image_id = o_orderkey)"""


def keypoints(spark, sf):
    df = views.line(spark, sf).selectExpr(
        "l_orderkey AS image_id", "l_linenumber AS face_idx", "(l_partkey % 7 - 3) * 0.1D AS dx", "(l_suppkey % 5 - 2) * 0.1D AS dy", "10.0D + l_orderkey % 5 AS norm"
    )
    one = F.sequence(F.lit(1), F.lit(5))
    gx, gy = (F.col("image_id") % 50).cast("double"), (F.col("image_id") % 30).cast("double")
    gt = F.transform(one, lambda i: F.struct((gx * 0 + i * 3).cast("double").alias("x"), (gy * 0 + i * 2).cast("double").alias("y")))
    inf = F.transform(one, lambda i: F.struct((i * 3 + F.col("dx") * i).cast("double").alias("x"), (i * 2 + F.col("dy")).cast("double").alias("y")))
    faces = df.select("image_id", "face_idx", "norm", gt.alias("gt"), inf.alias("inf"))
    return vision.keypoint_results(faces, table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id")))


@query("d22_keypoint_results", "SELECT image_id, outcome, round(mse, 6) AS mse, round(nmse, 6) AS nmse FROM kr", ctes=KP)
def d22(spark, sf):
    return keypoints(spark, sf).select("image_id", "outcome", r6("mse").alias("mse"), r6("nmse").alias("nmse"))


@query("e42_keypoint_case", """SELECT priority, round(avg(sqrt(dx * dx + dy * dy)), 4) AS avg_dist_0, round(avg(mse), 6) AS avg_mse, round(avg(nmse), 6) AS avg_nmse, count(*) FILTER (WHERE outcome = 'failure_to_align') AS n_fail_to_align,
  count(*) FILTER (WHERE outcome = 'failure_to_detect') AS n_fail_to_detect, round(count(*) FILTER (WHERE outcome <> 'success') / count(*), 6) AS failure_rate FROM kr GROUP BY 1""", ctes=KP)  # fmt: skip
def e42(spark, sf):
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("priority"))
    t = vision.keypoint_case(keypoints(spark, sf).join(cases, "image_id"), ["priority"])
    return t.select("priority", F.round(F.get("avg_dist", F.lit(0)), 4).alias("avg_dist_0"), r6("avg_mse").alias("avg_mse"), r6("avg_nmse").alias("avg_nmse"), "n_fail_to_align", "n_fail_to_detect", r6("failure_rate").alias("failure_rate"))


@query("e39_keypoint_suite", """SELECT round(var_pop(m), 9) AS variance_average_mse, round(var_pop(e), 9) AS variance_average_nmse, round(var_pop(d / n), 9) AS variance_detection_failure_rate, round(var_pop(a / n), 9) AS variance_alignment_failure_rate, round(var_pop((a + d) / n), 9) AS variance_failure_rate
  FROM (SELECT avg(mse) AS m, avg(nmse) AS e, count(*) AS n, count(*) FILTER (WHERE outcome = 'failure_to_align') AS a, count(*) FILTER (WHERE outcome = 'failure_to_detect') AS d FROM kr GROUP BY priority)""", ctes=KP)  # fmt: skip
def e39_keypoints(spark, sf):
    """How much the test cases of a keypoint suite differ."""
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("priority"))
    t = vision.keypoint_suite(vision.keypoint_case(keypoints(spark, sf).join(cases, "image_id"), ["priority"]))
    return t.select(*[F.round(c, 9).alias(c) for c in t.columns])


@query("e42_keypoint_distances", """SELECT priority, i - 1 AS keypoint, round(avg(sqrt(dx * dx * i * i + dy * dy)), 4) AS avg_dist FROM kr, range(1, 6) t(i) WHERE mse IS NOT NULL GROUP BY 1, 2""", ctes=KP)
def e42_distances(spark, sf):
    """The mean distance of every keypoint per test case."""
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("priority"))
    t = vision.keypoint_case(keypoints(spark, sf).join(cases, "image_id"), ["priority"])
    return t.select("priority", F.posexplode("avg_dist").alias("keypoint", "d")).select("priority", F.col("keypoint").cast("long").alias("keypoint"), F.round("d", 4).alias("avg_dist"))


# -- tracks ------------------------------------------------------------------------
@query("d29_track_risk", """SELECT user_id, event_id, round(least(greatest((mx - 1000) / 44000, 0), 1), 6) AS risk_score, CASE WHEN least(greatest((mx - 1000) / 44000, 0), 1) > 0.9 THEN 'high' ELSE 'low' END AS risk
  FROM (SELECT user_id, event_id, max(value * value) OVER (PARTITION BY user_id) AS mx FROM events WHERE value * value > 100)""")  # fmt: skip
def d29(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.struct(F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.col("value").alias("x2"), F.col("value").alias("y2")).alias("geom"))
    return vision.risk(e, ["user_id"]).select("user_id", "event_id", r6("risk_score").alias("risk_score"), "risk")


FR = """fr AS (SELECT user_id, event_id, event_id % 3 = 0 OR event_id % 151 < 75 AS failed_to_infer, CASE WHEN event_id % 3 = 0 OR event_id % 151 < 75 THEN 0 ELSE value / 500 END AS score FROM events)"""


def frames(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "value")
    predictions = e.where("NOT (event_id % 3 = 0 OR event_id % 151 < 75)").select("user_id", "event_id", (F.col("value") / 500).alias("score"))
    return vision.lookup_predictions(e.select("user_id", "event_id"), predictions, ["user_id", "event_id"])


@query("c15_frame_lookup", "SELECT user_id, event_id, failed_to_infer, round(score, 6) AS score FROM fr", ctes=FR)
def c15(spark, sf):
    return frames(spark, sf).select("user_id", "event_id", "failed_to_infer", r6("score").alias("score"))


@query("f06_carry_forward", """SELECT user_id, event_id, round(CASE WHEN failed_to_infer THEN coalesce(last_value(CASE WHEN NOT failed_to_infer THEN score END IGNORE NULLS) OVER w, 0) ELSE score END, 6) AS confidence,
  count(*) FILTER (WHERE NOT failed_to_infer) OVER w = 0 AND count(*) OVER w <= 17 AS observation,
  failed_to_infer AND NOT (count(*) FILTER (WHERE NOT failed_to_infer) OVER w = 0 AND count(*) OVER w <= 17) AND count(*) FILTER (WHERE NOT failed_to_infer) OVER w = 0 AS failed
  FROM fr WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""", ctes=FR)  # fmt: skip
def f06(spark, sf):
    return vision.carry_forward(frames(spark, sf), ["user_id"], "event_id").select("user_id", "event_id", r6("confidence").alias("confidence"), "observation", "failed")


# -- 3D ----------------------------------------------------------------------------
LEVEL = """CASE WHEN l_quantity + 15 >= 40 AND l_linenumber % 3 <= 0 AND l_discount * 5 <= 0.15 THEN 'easy' WHEN l_quantity + 15 >= 25 AND l_linenumber % 3 <= 1 AND l_discount * 5 <= 0.3 THEN 'moderate'
  WHEN l_quantity + 15 >= 25 AND l_linenumber % 3 <= 2 AND l_discount * 5 <= 0.5 THEN 'hard' ELSE 'ignored' END"""


@query("d28_difficulty_level", f"SELECT l_returnflag AS class, {LEVEL} AS level, count(*) AS n FROM lineitem GROUP BY 1, 2")
def d28(spark, sf):
    df = table(spark, sf, "lineitem")
    level = vision.difficulty_level(F.col("l_quantity") + 15, F.col("l_linenumber") % 3, F.col("l_discount") * 5)
    return df.groupBy(F.col("l_returnflag").alias("class"), level.alias("level")).agg(F.count("*").alias("n"))


INTER3 = "(least(g.x2,i.x2)-greatest(g.x1,i.x1))*(least(g.y2,i.y2)-greatest(g.y1,i.y1))*least(2 + g.gt_idx % 2, 2 + i.inf_idx % 2)"
IOU3 = f"""CASE WHEN least(g.x2,i.x2) > greatest(g.x1,i.x1) AND least(g.y2,i.y2) > greatest(g.y1,i.y1) THEN {INTER3} /
  ((g.x2-g.x1)*(g.y2-g.y1)*(2 + g.gt_idx % 2)+(i.x2-i.x1)*(i.y2-i.y1)*(2 + i.inf_idx % 2)-{INTER3}) ELSE 0.0 END"""
MATCH3 = match_sql("m", "w_det_gt", "w_det_inf", "i.label = g.label", op=">= CASE gt_label WHEN 'A' THEN 0.7 ELSE 0.5 END", iou=IOU3)
CLASSES = {"A": "Car", "N": "Pedestrian", "R": "Cyclist"}


def solid(df, idx):
    return df.withColumn("geom", F.struct("geom.*", F.lit(0.0).alias("z1"), (2 + F.col(idx) % 2).cast("double").alias("z2")))


@query("d28_match_3d_by_class", "SELECT label, kind, count(*) AS n FROM (SELECT label, kind FROM m_all UNION ALL SELECT label, 'unmatched_gt' FROM m_fn) GROUP BY 1, 2", ctes=MATCH3)
def d28b(spark, sf):
    """Each class has its own overlap threshold: car 0.7, pedestrian and cyclist 0.5. One match for all classes: overlaps below their class's threshold count as none."""

    def overlaps(a, b):
        pairs = matching.overlapping(a, b, ["image_id", "grp"])
        pairs = pairs.withColumn("iou", boxes.box3d_iou(F.col("a.geom"), F.col("b.geom")))
        least = F.when(F.col("grp.label") == "A", vision.CLASS_OVERLAP["Car"]).otherwise(vision.CLASS_OVERLAP["Pedestrian"])
        return pairs.where(F.col("iou") >= least)

    m = matching.match(solid(det.gts(spark, sf), "gt_idx"), solid(det.infs(spark, sf), "inf_idx"), min(vision.CLASS_OVERLAP.values()), ["label"], overlaps=overlaps)
    return m.groupBy(F.coalesce("inf.label", "gt.label").alias("label"), "kind").agg(F.count("*").alias("n"))


STATE3 = "CASE WHEN y2 - y1 >= h AND gt_idx % 3 <= o AND (gt_idx % 5) * 0.15 <= t AND NOT is_ignored THEN 0 ELSE 1 END"
LEVELS3 = f"""lv(level, h, o, t) AS (VALUES ('easy', 40, 0, 0.15), ('moderate', 25, 1, 0.3), ('hard', 25, 2, 0.5)),
gl AS (SELECT g.*, level, {STATE3} AS state FROM w_det_gt g, lv),
il AS (SELECT i.*, level, CASE WHEN score < 0.2 THEN NULL WHEN y2 - y1 < h THEN 1 ELSE 0 END AS state FROM w_det_inf i, lv),
pr AS (SELECT g.image_id, g.label, g.level, g.gt_idx, i.inf_idx, g.state AS gs, i.state AS st, {IOU3} AS iou FROM gl g JOIN il i ON g.image_id = i.image_id AND g.label = i.label AND g.level = i.level WHERE i.state IS NOT NULL),
of_ AS (SELECT image_id, label, level, gt_idx, gs, list({{'st': st, 'i': inf_idx}} ORDER BY st, CASE WHEN st = 0 THEN -iou ELSE 0 END, inf_idx) AS c, row_number() OVER (PARTITION BY image_id, label, level ORDER BY gt_idx) AS k
  FROM pr WHERE iou > CASE label WHEN 'A' THEN 0.7 ELSE 0.5 END GROUP BY 1, 2, 3, 4, 5),
st_(image_id, label, level, k, gt_idx, gs, pick, used) AS (
  SELECT image_id, label, level, k, gt_idx, gs, c[1], [c[1].i] FROM of_ WHERE k = 1 UNION ALL
  SELECT o.image_id, o.label, o.level, o.k, o.gt_idx, o.gs, p.pick, CASE WHEN p.pick IS NULL THEN p.used ELSE list_append(p.used, p.pick.i) END
  FROM of_ o JOIN (SELECT s.*, list_filter(n.c, lambda x: NOT list_contains(s.used, x.i))[1] AS nxt FROM st_ s JOIN of_ n ON n.image_id = s.image_id AND n.label = s.label AND n.level = s.level AND n.k = s.k + 1) q ON o.image_id = q.image_id AND o.label = q.label AND o.level = q.level AND o.k = q.k + 1,
  LATERAL (SELECT q.nxt AS pick, q.used AS used) p),
tk AS (SELECT * FROM st_ WHERE pick IS NOT NULL)"""


@query("d28_match_levels", """SELECT label AS cls, level, count(*) FILTER (WHERE state = 0) AS valid, count(*) FILTER (WHERE state = 1) AS ignored, any_value(m) AS matched, any_value(ab) AS absorbed,
  count(*) FILTER (WHERE state = 0 AND (image_id, label, level, gt_idx) NOT IN (SELECT (image_id, label, level, gt_idx) FROM tk)) AS missed, any_value(f) AS false FROM gl
  JOIN (SELECT label, level, count(*) FILTER (WHERE gs = 0 AND pick.st = 0) AS m, count(*) FILTER (WHERE NOT (gs = 0 AND pick.st = 0)) AS ab FROM tk GROUP BY 1, 2) USING (label, level)
  JOIN (SELECT label, level, count(*) FILTER (WHERE state = 0 AND (image_id, label, level, inf_idx) NOT IN (SELECT (image_id, label, level, pick.i) FROM tk)) AS f FROM il GROUP BY 1, 2) USING (label, level) GROUP BY 1, 2""", ctes=LEVELS3, recursive=True)  # fmt: skip
def d28c(spark, sf):
    """All three levels in one pass: harder and never-counting objects absorb inferences, small inferences are ignored, faint ones out of play."""
    height = F.col("geom.y2") - F.col("geom.y1")
    g, i = solid(det.gts(spark, sf), "gt_idx"), solid(det.infs(spark, sf), "inf_idx")
    g = g.withColumn("states", levels.difficulty_states(height, F.col("gt_idx") % 3, (F.col("gt_idx") % 5) * 0.15, F.col("is_ignored"))).withColumnRenamed("label", "cls")
    i = i.withColumn("states", levels.inference_states(height, counted=F.col("score") >= 0.2)).withColumnRenamed("label", "cls")
    found = levels.match_levels(g, i, {k: vision.CLASS_OVERLAP[name] for k, name in CLASSES.items()})
    return levels.level_counts(found, g)


# -- box properties ----------------------------------------------------------------
@query("d30_box_properties", """SELECT image_id, gt_idx, round((x2 - x1) / (y2 - y1), 6) AS aspect_ratio, round((x2 - x1) * (y2 - y1) / 10000, 6) AS relative_area,
  round(sqrt(((x1 + x2) / 2 - 50) ** 2 + ((y1 + y2) / 2 - 50) ** 2) / (sqrt(20000) / 2), 6) AS relative_distance FROM w_det_gt""")  # fmt: skip
def d30(spark, sf):
    p = vision.box_properties(det.gts(spark, sf), 100, 100)
    return p.select("image_id", "gt_idx", *[r6(c).alias(c) for c in ("aspect_ratio", "relative_area", "relative_distance")])


BG = f"""gp AS (SELECT *, (x2 - x1) / (y2 - y1) AS a, (x2 - x1) * (y2 - y1) / 10000 AS ra, sqrt(((x1 + x2) / 2 - 50) ** 2 + ((y1 + y2) / 2 - 50) ** 2) / (sqrt(20000) / 2) AS rd FROM w_det_gt),
gs AS (SELECT image_id, count(*) AS objects, count(DISTINCT label) AS types, sum(ra) AS combined_area, avg(ra) AS mean_relative_area, stddev_pop(ra) AS std_relative_area, avg(rd) AS mean_relative_distance,
  stddev_pop(rd) AS std_relative_distance FROM gp GROUP BY 1),
gc AS (SELECT image_id, least(floor((x1 + x2) / 2 / (100 / 3.0)), 2) AS cx, least(floor((y1 + y2) / 2 / (100 / 3.0)), 2) AS cy, count(*) AS n FROM w_det_gt GROUP BY 1, 2, 3),
ge AS (SELECT image_id, -sum(n / t * log2(n / t)) AS entropy FROM (SELECT *, sum(n) OVER (PARTITION BY image_id) AS t FROM gc) GROUP BY 1),
pp AS (SELECT g.image_id, sum({IOU}) AS pair_iou, avg(sqrt(((g.x1 + g.x2 - i.x1 - i.x2) / 2) ** 2 + ((g.y1 + g.y2 - i.y1 - i.y2) / 2) ** 2)) AS mean_distance,
  stddev_pop(sqrt(((g.x1 + g.x2 - i.x1 - i.x2) / 2) ** 2 + ((g.y1 + g.y2 - i.y1 - i.y2) / 2) ** 2)) AS std_distance FROM w_det_gt g JOIN w_det_gt i ON g.image_id = i.image_id AND g.gt_idx < i.gt_idx GROUP BY 1)"""


@query("d31_box_group_properties", """SELECT image_id, objects, types, round(combined_area, 9) AS combined_area, round(mean_relative_area, 9) AS mean_relative_area, round(std_relative_area, 5) AS std_relative_area,
  round(mean_relative_distance, 5) AS mean_relative_distance, round(std_relative_distance, 5) AS std_relative_distance, round(abs(entropy), 5) AS entropy, round(coalesce(pair_iou, 0), 5) AS pair_iou, round(mean_distance, 4) AS mean_distance,
  round(std_distance, 3) AS std_distance FROM gs JOIN ge USING (image_id) LEFT JOIN pp USING (image_id)""", ctes=BG)  # fmt: skip
def d31(spark, sf):
    p = vision.box_group_properties(det.gts(spark, sf).withColumnRenamed("gt_idx", "idx"), 100, 100)
    five = [rounded(c, 5).alias(c) for c in ("std_relative_area", "mean_relative_distance", "std_relative_distance")]
    five += [rounded(c, 9).alias(c) for c in ("combined_area", "mean_relative_area")]
    return p.select("image_id", "objects", "types", *five, rounded(F.abs("entropy"), 5).alias("entropy"), rounded("pair_iou", 5).alias("pair_iou"), rounded("mean_distance", 4).alias("mean_distance"), rounded("std_distance", 3).alias("std_distance"))


# -- face pairs --------------------------------------------------------------------
def swapped(p):
    """Every pair listed from both ends."""
    return p.unionByName(p.select(F.col("b").alias("a"), F.col("a").alias("b"), "is_match", "similarity"))


@query("c12_unordered_pairs", "SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT a, b FROM w_pair UNION ALL SELECT b, a FROM w_pair)")
def c12(spark, sf):
    p = views.pair(spark, sf).select("a", "b")
    return joins.unordered(p.unionAll(p.select("b", "a")), "a", "b").select("a", "b")


@query("d27_pair_verdicts", """SELECT a, b, similarity > 0.1 AS is_predicted_match, is_match AND similarity > 0.1 AS is_tm, NOT is_match AND similarity <= 0.1 AS is_tnm, NOT is_match AND similarity > 0.1 AS is_fm, is_match AND similarity <= 0.1 AS is_fnm,
  CASE WHEN NOT is_match THEN CAST(similarity > 0.1 AS INT) END AS fmr, CASE WHEN is_match THEN CAST(similarity <= 0.1 AS INT) END AS fnmr FROM w_pair""")  # fmt: skip
def d27(spark, sf):
    return vision.pair_verdicts(views.pair(spark, sf), 0.1).drop("is_match", "similarity")


FACES = """fb AS (SELECT vec_id AS i, 4 * abs(embedding[1]::DOUBLE) AS d FROM embeddings),
fv AS (SELECT i, greatest(1 - d, 0) / (1 + d) AS iou FROM fb),
fp AS (SELECT p.a, p.is_match, CASE WHEN x.iou < 0.5 OR y.iou < 0.5 THEN NULL ELSE p.similarity END AS similarity FROM w_pair p JOIN fv x ON x.i = p.a JOIN fv y ON y.i = p.b)"""


def face_boxes(spark, sf):
    """(image_id, bbox_iou): a unit ground-truth box and the detected one, moved by four times the first component."""
    move = 4 * F.abs(F.col("embedding")[0])
    box = lambda x: F.struct(x.alias("x1"), F.lit(0.0).alias("y1"), (x + 1).alias("x2"), F.lit(1.0).alias("y2"))
    v = views.vectors(spark, sf).select(F.col("vec_id").alias("image_id"), box(F.lit(0.0)).alias("gt"), box(move).alias("inf"))
    return v.select("image_id", boxes.box_iou(F.col("gt"), F.col("inf")).alias("bbox_iou"))


@query("d26_face_sample_metrics", """SELECT a AS image_id, count(*) AS pairs, round(any_value(iou), 6) AS bbox_iou, any_value(iou) < 0.5 AS bbox_fte, count(*) FILTER (WHERE similarity IS NULL) AS pair_failures, count(*) FILTER (WHERE similarity > 0.1 AND is_match) AS tm,
  count(*) FILTER (WHERE similarity > 0.1 AND NOT is_match) AS fm, count(*) FILTER (WHERE similarity <= 0.1 AND is_match) AS fnm, count(*) FILTER (WHERE similarity <= 0.1 AND NOT is_match) AS tnm FROM fp JOIN fv ON fv.i = a GROUP BY 1""", ctes=FACES)  # fmt: skip
def d26(spark, sf):
    """A face whose box misses the ground truth fails to enroll; its pairs have no similarity and count as pair failures."""
    found = face_boxes(spark, sf)
    p = views.pair(spark, sf).join(found.withColumnsRenamed({"image_id": "a", "bbox_iou": "iou"}), "a").join(found.withColumnsRenamed({"image_id": "b", "bbox_iou": "other"}), "b")
    p = p.withColumn("similarity", F.when((F.col("iou") >= 0.5) & (F.col("other") >= 0.5), F.col("similarity")))
    v = vision.pair_verdicts(p, 0.1)
    flags = [F.count_if(f"is_{n}").alias(n) for n in ("tm", "fm", "fnm", "tnm")]
    out = v.groupBy(F.col("a").alias("image_id")).agg(F.count("*").alias("pairs"), F.count_if(F.col("similarity").isNull()).alias("pair_failures"), *flags, F.max("iou").alias("iou"))
    return out.withColumns({"bbox_iou": r6("iou"), "bbox_fte": F.col("iou") < 0.5}).drop("iou")


@query("e40_pair_metrics", """SELECT count(*) FILTER (WHERE is_match) AS genuine, count(*) FILTER (WHERE NOT is_match) AS imposter, count(*) FILTER (WHERE NOT is_match AND similarity > 0.1) AS fm, count(*) FILTER (WHERE is_match AND similarity <= 0.1) AS fnm,
  round(count(*) FILTER (WHERE NOT is_match AND similarity > 0.1) / count(*) FILTER (WHERE NOT is_match), 6) AS fmr, round(count(*) FILTER (WHERE is_match AND similarity <= 0.1) / count(*) FILTER (WHERE is_match), 6) AS fnmr FROM w_pair""")  # fmt: skip
def e40(spark, sf):
    p = views.pair(spark, sf)
    both = joins.unordered(swapped(p), "a", "b")
    m = vision.pair_metrics(vision.pair_verdicts(both, 0.1))
    return m.withColumn("fmr", r6("fmr")).withColumn("fnmr", r6("fnmr"))


ALIGN = FACES + """,
sm AS (SELECT vec_id AS i, iou < 0.5 OR 3 * abs(embedding[2]::DOUBLE) > 0.5 AS failed FROM embeddings JOIN fv ON fv.i = vec_id),
up AS (SELECT greatest(p.a, p.b) AS last, p.is_match, CASE WHEN x.iou < 0.5 OR y.iou < 0.5 THEN NULL ELSE p.similarity END AS similarity FROM w_pair p JOIN fv x ON x.i = p.a JOIN fv y ON y.i = p.b),
uf AS (SELECT up.*, sm.failed OR similarity IS NULL AS failed FROM up JOIN sm ON sm.i = last)"""


def face_failures(spark, sf):
    """Images whose box misses the ground truth, or whose keypoints lie too far off it."""
    off = views.vectors(spark, sf).select(F.col("vec_id").alias("image_id"), (3 * F.abs(F.col("embedding")[1])).alias("nmse"))
    return face_boxes(spark, sf).join(off, "image_id").select("image_id", "bbox_iou", ((F.col("bbox_iou") < 0.5) | (F.col("nmse") > 0.5)).alias("failed"))


@query("e40_face_case_metrics", """SELECT count(*) AS pairs, count(*) FILTER (WHERE is_match) AS genuine, count(*) FILTER (WHERE NOT is_match) AS imposter, count(*) FILTER (WHERE NOT is_match AND similarity > 0.1) AS fm, count(*) FILTER (WHERE is_match AND similarity <= 0.1) AS fnm,
  round(fm / imposter, 6) AS fmr, round(fnm / genuine, 6) AS fnmr, round(fnm / genuine - 0.1, 6) AS delta_fnmr, count(*) FILTER (WHERE similarity IS NULL) AS pair_failures, round(pair_failures / pairs, 6) AS pair_failure_rate, count(*) FILTER (WHERE failed) AS fte,
  round(fte / (SELECT count(*) FROM sm), 6) AS fter FROM uf""", ctes=ALIGN)  # fmt: skip
def e40_case(spark, sf):
    """Every pair listed from both ends; failures to enroll come from boxes, keypoints and missing similarities."""
    found = face_failures(spark, sf)
    p = swapped(views.pair(spark, sf))
    missing = found.where("bbox_iou < 0.5").select(F.col("image_id"), F.lit(True).alias("out"))
    p = p.join(missing.withColumnsRenamed({"image_id": "a", "out": "oa"}), "a", "left").join(missing.withColumnsRenamed({"image_id": "b", "out": "ob"}), "b", "left")
    p = p.select("a", "b", "is_match", F.when(F.col("oa").isNull() & F.col("ob").isNull(), F.col("similarity")).alias("similarity"))
    m = vision.face_case_metrics(p, found, 0.1, 0.1)
    return m.select(*[r6(c).alias(c) if c in ("fmr", "fnmr", "delta_fnmr", "pair_failure_rate", "fter") else c for c in m.columns])


@query("e41_threshold_at_fmr", """SELECT r.fmr, round(s.similarity - 1e-9, 6) AS threshold FROM (SELECT CAST(f AS DOUBLE) AS fmr, (round_even(CAST(f AS DOUBLE) * (SELECT 2 * count(*) FROM w_pair WHERE NOT is_match) / 2, 0) - 1) * 2 AS k FROM (VALUES (0.01), (0.05), (0.1), (0.25)) t(f)) r
  JOIN (SELECT similarity, row_number() OVER (ORDER BY similarity DESC) - 1 AS i FROM (SELECT similarity FROM w_pair WHERE NOT is_match UNION ALL SELECT similarity FROM w_pair WHERE NOT is_match)) s ON s.i = r.k""")  # fmt: skip
def e41(spark, sf):
    p = shared(spark, f"{sf}/pairs", lambda: views.pair(spark, sf))
    listed = swapped(p)
    return vision.thresholds_at_fmr(listed, [0.01, 0.05, 0.1, 0.25]).select("fmr", r6("threshold").alias("threshold"))


# -- retrieval ---------------------------------------------------------------------
def sides(spark, sf):
    v = views.vectors(spark, sf)
    return v.select(F.col("vec_id").alias("query_id"), "embedding"), v.select(F.col("vec_id").alias("item_id"), "embedding")


TOP = "tp AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, item_id) AS rank FROM w_sim)"


@query("c13_top10_similar", "SELECT query_id, item_id, round(sim, 6) AS sim, rank FROM tp WHERE rank <= 10", ctes=TOP)
def c13(spark, sf):
    top = similarity.similarity_top_k(*sides(spark, sf), 10)
    return top.select("query_id", "item_id", r6("sim").alias("sim"), F.col("rank").cast("long").alias("rank"))


@query("g03_top_k_per_query", "SELECT query_id, item_id, rank FROM tp WHERE rank <= 3", ctes=TOP)
def g03(spark, sf):
    return similarity.similarity_top_k(*sides(spark, sf), 3).select("query_id", "item_id", F.col("rank").cast("long").alias("rank"))


@query("f01_true_item_rank", """SELECT query_id, round(sim, 6) AS similarity, rank, round(1.0 / rank, 6) AS reciprocal_rank, rank <= 1 AS is_top_01, rank <= 5 AS is_top_05, rank <= 10 AS is_top_10, rank <= 25 AS is_top_25, rank <= 50 AS is_top_50, rank > 50 AS total_miss
  FROM tp WHERE relevant QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY item_id) = 1""", ctes=TOP)  # fmt: skip
def f01(spark, sf):
    v = views.vectors(spark, sf)
    # The true item is the smallest other id of the same label: the two smallest ids per label suffice.
    least = v.groupBy("label").agg(F.min("vec_id").alias("m1"))
    second = v.join(least, "label").where("vec_id <> m1").groupBy("label").agg(F.min("vec_id").alias("m2"))
    least = least.join(second, "label", "left")
    q = v.join(least, "label").select(F.col("vec_id").alias("query_id"), "embedding", F.when(F.col("vec_id") == F.col("m1"), F.col("m2")).otherwise(F.col("m1")).alias("true_id"))
    true = v.select(F.col("vec_id").alias("true_id"), F.col("embedding").alias("other"))
    q = q.join(true, "true_id").withColumn("similarity", dot("embedding", "other")).select("query_id", "embedding", "true_id", "similarity")
    ranks = similarity.true_item_rank(q, sides(spark, sf)[1])
    return ranks.select(
        "query_id", r6("similarity").alias("similarity"), "rank", r6(1 / F.col("rank")).alias("reciprocal_rank"),
        *[(F.col("rank") <= k).alias(f"is_top_{k:02d}") for k in (1, 5, 10, 25, 50)], (F.col("rank") > 50).alias("total_miss"),
    )


@query("g04_nearest_neighbours", """SELECT query_id, item_id, round(sim, 6) AS sim, rank FROM (SELECT q.vec_id AS query_id, c.vec_id AS item_id, list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS sim,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) DESC, c.vec_id) AS rank FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id) WHERE rank <= 5""")  # fmt: skip
def g04(spark, sf):
    top = similarity.similarity_top_k(*sides(spark, sf), 5, cosine=True)
    return top.select("query_id", "item_id", r6("sim").alias("sim"), F.col("rank").cast("long").alias("rank"))


@query("f10_positional_rank", "SELECT query_id, rank, item_id FROM tp WHERE rank <= 10", ctes=TOP)
def f10(spark, sf):
    """A ranked list of ten items, as C13 gives it, becomes one row per item with its rank."""
    top = similarity.similarity_top_k(*sides(spark, sf), 10)
    lists = top.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "item_id"))).alias("ranked"))  # ten items
    return lists.select("query_id", F.posexplode("ranked").alias("p", "item")).select("query_id", (F.col("p") + 1).cast("long").alias("rank"), "item.item_id")


AP = """SELECT query_id, round(sum(CASE WHEN relevant THEN hits / rank ELSE 0 END) / any_value(gtp), 6) AS ap FROM (SELECT query_id, rank, relevant, CAST(sum(relevant::INT) OVER (PARTITION BY query_id ORDER BY rank) AS DOUBLE) AS hits,
  CAST(count(*) FILTER (WHERE relevant) OVER (PARTITION BY query_id) AS DOUBLE) AS gtp FROM tp) {0} GROUP BY 1"""


@query("e20_retrieval_ap", AP.format(""), ctes=TOP)
def e20_full(spark, sf):
    """Average precision over the whole ranking, from the ranks of the relevant items alone."""
    v = views.vectors(spark, sf).select("vec_id", "embedding", "label")
    ap = similarity.retrieval_average_precision(v.withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "item_id"))
    return ap.select("query_id", r6("ap").alias("ap"))


@query("e20_retrieval_ap_at_50", AP.format("WHERE rank <= 50"), ctes=TOP)
def e20_at_50(spark, sf):
    """AP(50): what lies below rank 50 counts as not found."""
    from pyspark.sql import Window as W

    top = similarity.similarity_top_k(*sides(spark, sf), 50)
    labels = views.vectors(spark, sf).select("vec_id", "label")
    sizes = labels.groupBy("label").agg((F.count("*") - 1).alias("gtp"))
    q = labels.join(sizes, "label").select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql"), "gtp")
    rows = top.join(q, "query_id").join(labels.select(F.col("vec_id").alias("item_id"), F.col("label").alias("il")), "item_id")
    rel = (F.col("ql") == F.col("il")).cast("int")
    hits = F.sum(rel).over(W.partitionBy("query_id").orderBy("rank"))  # 50 rows a query
    return rows.withColumn("p", rel * hits / F.col("rank")).groupBy("query_id").agg(r6(F.sum("p") / F.max("gtp")).alias("ap"))


# -- token tables ------------------------------------------------------------------
@query("e47_perplexity", "SELECT vec_id // 8 AS sentence, round(exp(-avg(-abs(embedding[1]::DOUBLE) - 0.01)), 6) AS perplexity FROM embeddings GROUP BY 1")
def e47(spark, sf):
    t = views.vectors(spark, sf).select(F.floor(F.col("vec_id") / 8).alias("sentence"), (-F.abs(F.col("embedding")[0]) - 0.01).alias("logp"))
    return t.groupBy("sentence").agg(r6(F.exp(-F.avg("logp"))).alias("perplexity"))


BERT = """ts AS (SELECT vec_id // 8 AS s, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
tp2 AS (SELECT a.s, a.vec_id AS r, b.vec_id AS c, list_cosine_similarity(a.e, b.e) AS sim FROM ts a JOIN ts b ON b.s = a.s + 1),
pq AS (SELECT p.s, p.p, r.r FROM (SELECT s, avg(m) AS p FROM (SELECT s, c, max(sim) AS m FROM tp2 GROUP BY 1, 2) GROUP BY 1) p JOIN (SELECT s, avg(m) AS r FROM (SELECT s, r, max(sim) AS m FROM tp2 GROUP BY 1, 2) GROUP BY 1) r USING (s))"""


@query("e48_bertscore", "SELECT s AS sentence, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1 FROM pq", ctes=BERT)
def e48(spark, sf):
    t = views.vectors(spark, sf).select(F.floor(F.col("vec_id") / 8).alias("sentence"), "vec_id", "embedding")
    # A sentence is one text: its tokens make one row.
    s = t.groupBy("sentence").agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("tokens"))
    pairs = s.join(s.select((F.col("sentence") - 1).alias("sentence"), F.col("tokens").alias("cand")), "sentence")
    out = pairs.select("sentence", blocks.greedy_cosine("tokens", "cand").alias("m")).select("sentence", "m.*")
    return out.select("sentence", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])
