"""Queries on boxes: geometry, matching, detection metrics and curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkeval.functions import boxes
from sparkeval.functions.ratios import r6
from sparkeval.operators import curves, detection, matching
from sparkeval.plans import views
from sparkeval.plans.registry import query
from sparkeval.session import shared

# SQL form of matching, with a plain window over all pairs of an image, for the checks.
IOU = """CASE WHEN least(g.x2,i.x2) > greatest(g.x1,i.x1) AND least(g.y2,i.y2) > greatest(g.y1,i.y1) THEN
  (least(g.x2,i.x2)-greatest(g.x1,i.x1))*(least(g.y2,i.y2)-greatest(g.y1,i.y1)) /
  ((g.x2-g.x1)*(g.y2-g.y1)+(i.x2-i.x1)*(i.y2-i.y1)-(least(g.x2,i.x2)-greatest(g.x1,i.x1))*(least(g.y2,i.y2)-greatest(g.y1,i.y1)))
  ELSE 0.0 END"""


def match_sql(name: str, gts: str, infs: str, on: str, op: str = ">= 0.5", tie: str = "", iou: str = IOU) -> str:
    """CTEs ``<name>_all`` (one row per inference) and ``<name>_fn`` (unmatched ground truths)."""
    gt_tie, inf_tie = (f"g.{tie}," if tie else ""), (f"{tie}," if tie else "")
    gt_tie_out = f", g.{tie} AS g_{tie}" if tie else ""
    return f"""{name}_pairs AS MATERIALIZED (SELECT i.image_id, i.inf_idx, i.label, i.score, g.gt_idx, g.label AS gt_label, g.is_ignored, {iou} AS iou
  FROM {infs} i JOIN {gts} g ON i.image_id = g.image_id AND {on}),
{name}_best AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id, label, inf_idx ORDER BY iou DESC, is_ignored, {inf_tie.replace('label','gt_label')} gt_idx) AS rn
  FROM {name}_pairs WHERE iou {op}),
{name}_win AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id, gt_label, gt_idx ORDER BY score DESC, {inf_tie} inf_idx) AS wn
  FROM {name}_best WHERE rn = 1 AND NOT is_ignored),
{name}_near AS MATERIALIZED (SELECT image_id, label, inf_idx, max(iou) FILTER (WHERE NOT is_ignored) AS near FROM {name}_pairs GROUP BY 1, 2, 3),
{name}_all AS MATERIALIZED (SELECT i.image_id, i.inf_idx, i.label, i.score, i.stratum, b.gt_idx, b.gt_label,
    CASE WHEN b.is_ignored THEN 'ignored' WHEN w.wn = 1 THEN 'matched' ELSE 'unmatched_inf' END AS kind,
    CASE WHEN b.is_ignored OR w.wn = 1 THEN b.iou ELSE coalesce(n.near, 0) END AS iou
  FROM {infs} i LEFT JOIN {name}_best b ON b.rn = 1 AND i.image_id = b.image_id AND i.inf_idx = b.inf_idx AND i.label = b.label
  LEFT JOIN {name}_win w ON i.image_id = w.image_id AND i.inf_idx = w.inf_idx AND i.label = w.label
  LEFT JOIN {name}_near n ON i.image_id = n.image_id AND i.inf_idx = n.inf_idx AND i.label = n.label),
{name}_fn AS MATERIALIZED (SELECT g.* FROM {gts} g WHERE NOT g.is_ignored AND NOT EXISTS (SELECT 1 FROM {name}_all m
  WHERE m.kind = 'matched' AND m.image_id = g.image_id AND m.gt_idx = g.gt_idx AND m.gt_label = g.label))"""


PER_LABEL = match_sql("m", "w_det_gt", "w_det_inf", "i.label = g.label")
WHOLE = match_sql("m", "w_det_gt", "w_det_inf", "true")
MULTI = (
    PER_LABEL
    + """,
l_gt AS MATERIALIZED (SELECT * FROM m_fn UNION ALL SELECT * FROM w_det_gt WHERE is_ignored),
l_inf AS MATERIALIZED (SELECT i.* FROM w_det_inf i JOIN m_all m ON i.image_id = m.image_id AND i.inf_idx = m.inf_idx AND m.kind = 'unmatched_inf'),
"""
    + match_sql("c", "l_gt", "l_inf", "true", tie="label")
    + """,
confused AS MATERIALIZED (SELECT image_id, gt_idx, gt_label, inf_idx, label, score, iou, stratum FROM c_all WHERE kind = 'matched' AND gt_label <> label),
mm AS (SELECT image_id, stratum, kind, gt_idx, gt_label, inf_idx, label AS inf_label, score, iou FROM m_all
  UNION ALL SELECT image_id, stratum, 'confused', gt_idx, gt_label, inf_idx, label, score, iou FROM confused
  UNION ALL SELECT f.image_id, f.stratum, 'unmatched_gt', f.gt_idx, f.label, NULL, NULL, NULL, NULL FROM m_fn f
    WHERE NOT EXISTS (SELECT 1 FROM confused c WHERE c.image_id = f.image_id AND c.gt_idx = f.gt_idx))"""
)
# (label, y_true, y_score) rows as the curves see them.
SCORES = (
    MULTI
    + """,
ys AS (SELECT image_id, stratum, CASE WHEN kind = 'unmatched_inf' THEN inf_label ELSE gt_label END AS label,
   CASE WHEN kind = 'unmatched_inf' THEN 0 ELSE 1 END AS y, CASE WHEN kind IN ('unmatched_gt', 'confused') THEN -1 ELSE score END AS s
   FROM mm WHERE kind <> 'ignored'),
hist AS (SELECT label, s, sum(y) AS pos, sum(1 - y) AS neg FROM ys GROUP BY 1, 2),
cum AS (SELECT label, s, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY label) AS n_pos
   FROM hist WINDOW w AS (PARTITION BY label ORDER BY s DESC)),
pts AS (SELECT label, s AS threshold, pos, tp, fp, n_pos, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(n_pos, 0), 0) AS r
   FROM cum WHERE s >= 0),
fpts AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pts)"""
)


def gts(spark, sf):
    return shared(spark, f"{sf}/det_gt", lambda: detection.with_boxes(views.det_gt(spark, sf)))


def infs(spark, sf):
    return shared(spark, f"{sf}/det_inf", lambda: detection.with_boxes(views.det_inf(spark, sf, gts(spark, sf).select("*", "geom.*"))))


def per_label(spark, sf):
    return shared(spark, f"{sf}/label_matches", lambda: matching.match(gts(spark, sf), infs(spark, sf), 0.5, ["label"]))


def multi(spark, sf):
    """Matches of the whole table, computed once and read by every metric family."""
    return shared(spark, f"{sf}/matches", lambda: matching.match_multiclass(gts(spark, sf), infs(spark, sf), 0.5))


def flat(m):
    return m.select(
        "image_id", "kind", F.col("gt.gt_idx").alias("gt_idx"), F.col("gt.label").alias("gt_label"),
        F.col("inf.inf_idx").alias("inf_idx"), F.col("inf.label").alias("inf_label"), F.col("inf.score").alias("score"), r6("iou").alias("iou"),
    )


@query("d01_box_fields", """SELECT image_id, gt_idx, x2 - x1 AS width, y2 - y1 AS height, (x2 - x1) * (y2 - y1) AS area,
  round((x2 - x1) / (y2 - y1), 6) AS aspect_ratio, (x2 - x1) * (y2 - y1) * gt_idx AS volume FROM w_det_gt""")  # fmt: skip
def d01(spark, sf):
    b = F.col("geom")
    solid = F.struct("geom.*", F.lit(0.0).alias("z1"), F.col("gt_idx").cast("double").alias("z2"))
    return gts(spark, sf).select(
        "image_id", "gt_idx", boxes.width(b).alias("width"), boxes.height(b).alias("height"), boxes.area(b).alias("area"),
        r6(boxes.aspect_ratio(b)).alias("aspect_ratio"), boxes.volume3d(solid).alias("volume"),
    )


@query("d02_box_iou", f"""SELECT g.image_id, g.gt_idx, i.inf_idx, round({IOU}, 6) AS iou FROM w_det_gt g JOIN w_det_inf i
  ON g.image_id = i.image_id WHERE {IOU} > 0""")  # fmt: skip
def d02(spark, sf):
    pairs = matching.overlapping(gts(spark, sf), infs(spark, sf), ["image_id"])
    iou = boxes.box_iou(F.col("a.geom"), F.col("b.geom"))
    return pairs.select("image_id", "a.gt_idx", "b.inf_idx", r6(iou).alias("iou")).where("iou > 0")


@query("c09_box_pair_join", f"""SELECT g.image_id, g.label, count(*) AS pairs, round(sum({IOU}), 4) AS iou_sum FROM w_det_gt g JOIN w_det_inf i
  ON g.image_id = i.image_id AND g.label = i.label WHERE least(g.x2,i.x2) > greatest(g.x1,i.x1) AND least(g.y2,i.y2) > greatest(g.y1,i.y1)
  GROUP BY 1, 2""")  # fmt: skip
def c09(spark, sf):
    pairs = matching.overlapping(gts(spark, sf), infs(spark, sf), ["image_id", "label"])
    iou = boxes.box_iou(F.col("a.geom"), F.col("b.geom"))
    return pairs.groupBy("image_id", "label").agg(F.count("*").alias("pairs"), F.round(F.sum(iou), 4).alias("iou_sum"))


@query("d04_match_single", """SELECT image_id, kind, gt_idx, gt_label, inf_idx, label AS inf_label, score, round(iou, 6) AS iou
  FROM (SELECT image_id, kind, CASE WHEN kind = 'matched' THEN gt_idx END AS gt_idx, CASE WHEN kind = 'matched' THEN gt_label END AS gt_label,
    inf_idx, label, score, iou FROM m_all UNION ALL SELECT image_id, 'unmatched_gt', gt_idx, label, NULL, NULL, NULL, NULL FROM m_fn)""",
  ctes=WHOLE)
def d04(spark, sf):
    return flat(matching.match(gts(spark, sf), infs(spark, sf), 0.5))


@query("d05_match_ignored", """SELECT kind, count(*) AS n, round(sum(iou), 3) AS iou_sum FROM (SELECT kind, iou FROM m_all
  UNION ALL SELECT 'unmatched_gt', NULL FROM m_fn) GROUP BY 1""", ctes=PER_LABEL)  # fmt: skip
def d05(spark, sf):
    return per_label(spark, sf).groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum("iou"), 3).alias("iou_sum"))


@query("d06_ignore_flag", """SELECT label, CAST(sum(CASE WHEN is_ignored THEN 1 ELSE 0 END) AS BIGINT) AS ignored, count(*) AS objects
  FROM w_det_gt GROUP BY 1""")  # fmt: skip
def d06(spark, sf):
    per_image = views.det_gt(spark, sf).groupBy("image_id").agg(
        F.collect_list(F.struct("label", F.col("is_ignored").alias("difficult"), "x1", "y1", "x2", "y2")).alias("objects")
    )
    objects = detection.flag_ignored(detection.explode_objects(per_image, "objects", "gt_idx"), "difficult")
    return objects.groupBy("label").agg(F.count_if("is_ignored").alias("ignored"), F.count("*").alias("objects"))


REQUIRED = match_sql(
    "m", "(SELECT *, CASE WHEN gt_idx % 3 = 0 THEN NULL ELSE gt_idx % 3 END AS view FROM w_det_gt)",
    "(SELECT *, CASE WHEN inf_idx % 4 = 0 THEN NULL ELSE inf_idx % 4 END AS view FROM w_det_inf)",
    "i.label = g.label AND i.view IS NOT DISTINCT FROM g.view",
)


@query("d07_match_required_fields", """SELECT kind, count(*) AS n, round(sum(iou), 3) AS iou_sum FROM (SELECT kind, iou FROM m_all
  UNION ALL SELECT 'unmatched_gt', NULL FROM m_fn) GROUP BY 1""", ctes=REQUIRED)  # fmt: skip
def d07(spark, sf):
    g = gts(spark, sf).withColumn("view", F.expr("CASE WHEN gt_idx % 3 = 0 THEN NULL ELSE gt_idx % 3 END"))
    i = infs(spark, sf).withColumn("view", F.expr("CASE WHEN inf_idx % 4 = 0 THEN NULL ELSE inf_idx % 4 END"))
    m = matching.match(g, i, 0.5, ["label", "view"])
    return m.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum("iou"), 3).alias("iou_sum"))


@query("d08_match_multiclass", """SELECT image_id, kind, CASE WHEN kind IN ('matched','confused','unmatched_gt') THEN gt_idx END AS gt_idx,
  CASE WHEN kind IN ('matched','confused','unmatched_gt') THEN gt_label END AS gt_label, inf_idx, inf_label, score, round(iou, 6) AS iou FROM mm""",
  ctes=MULTI)
def d08(spark, sf):
    return flat(multi(spark, sf))


@query("d09_class_mode", """SELECT count(DISTINCT label) >= 2 AND bool_and(label IS NOT NULL) AS is_multiclass, count(DISTINCT label) AS n_labels
  FROM (SELECT label FROM w_det_gt UNION ALL SELECT label FROM w_det_inf)""")  # fmt: skip
def d09(spark, sf):
    return matching.is_multiclass(views.det_gt(spark, sf), views.det_inf(spark, sf))


STRICT = match_sql("m", "w_det_gt", "w_det_inf", "i.label = g.label", op="> 0.5")


@query("d10_match_strict", """SELECT kind, count(*) AS n FROM (SELECT kind FROM m_all UNION ALL SELECT 'unmatched_gt' FROM m_fn) GROUP BY 1""",
  ctes=STRICT)
def d10(spark, sf):
    m = matching.match(gts(spark, sf), infs(spark, sf), 0.5, ["label"], strict=True)
    return m.groupBy("kind").agg(F.count("*").alias("n"))


GROUP_OF = (
    """og AS (SELECT * EXCLUDE (is_ignored), is_ignored AS is_group FROM w_det_gt),
og_plain AS (SELECT *, false AS is_ignored FROM og WHERE NOT is_group),
og_group AS (SELECT *, false AS is_ignored FROM og WHERE is_group),
oi AS (SELECT i.* FROM w_det_inf i WHERE EXISTS (SELECT 1 FROM og g WHERE g.image_id = i.image_id AND g.label = i.label)),
"""
    + match_sql("p", "og_plain", "oi", "i.label = g.label")
    + """,
rest AS (SELECT i.* FROM oi i JOIN p_all p ON i.image_id = p.image_id AND i.inf_idx = p.inf_idx AND p.kind = 'unmatched_inf'),
"""
    + match_sql("q", "og_group", "rest", "i.label = g.label")
)


@query("d10_match_group_of", """SELECT kind, count(*) AS n FROM (SELECT kind FROM p_all WHERE kind <> 'unmatched_inf' UNION ALL SELECT 'unmatched_gt' FROM p_fn
  UNION ALL SELECT CASE WHEN kind = 'unmatched_inf' AND iou >= 0.5 THEN 'ignored' ELSE kind END FROM q_all UNION ALL SELECT 'unmatched_gt' FROM q_fn) GROUP BY 1""",
  ctes=GROUP_OF)
def d10b(spark, sf):
    g = gts(spark, sf).withColumnRenamed("is_ignored", "is_group")
    return detection.group_of_match(g, infs(spark, sf)).groupBy("kind").agg(F.count("*").alias("n"))


@query("d11_image_metrics_single", """SELECT image_id, tp, fp, fn, tp > 0 AS has_tp, fp > 0 AS has_fp, fn > 0 AS has_fn, hi AS max_confidence, lo AS min_confidence
  FROM (SELECT image_id, count(*) FILTER (WHERE kind = 'matched' AND score >= 0.4) AS tp, count(*) FILTER (WHERE kind = 'unmatched_inf' AND score >= 0.4) AS fp,
   count(*) FILTER (WHERE kind = 'unmatched_gt' OR kind = 'matched' AND score < 0.4) AS fn,
   max(score) FILTER (WHERE kind IN ('matched','unmatched_inf') AND score >= 0.4) AS hi, min(score) FILTER (WHERE kind IN ('matched','unmatched_inf') AND score >= 0.4) AS lo
   FROM (SELECT image_id, kind, score FROM m_all WHERE kind <> 'ignored' UNION ALL SELECT image_id, 'unmatched_gt', NULL FROM m_fn) GROUP BY 1)""",
  ctes=WHOLE)
def d11(spark, sf):
    m = matching.match(gts(spark, sf), infs(spark, sf), 0.5)
    return detection.image_metrics(m, 0.4).drop("confused", "has_confused")


THRESH = """, th AS (SELECT label, coalesce(-max(struct_pack(f := f1, t := -threshold)).t, 0) AS threshold,
   max(struct_pack(f := f1, t := -threshold)).f AS best FROM fpts GROUP BY 1)"""
IMAGE_MULTI = """SELECT image_id, tp, fp, fn, confused, tp > 0 AS has_tp, fp > 0 AS has_fp, fn > 0 AS has_fn, confused > 0 AS has_confused,
  hi AS max_confidence, lo AS min_confidence
  FROM (SELECT image_id, count(*) FILTER (WHERE kind = 'matched' AND score >= t) AS tp, count(*) FILTER (WHERE kind = 'unmatched_inf' AND score >= t) AS fp,
   count(*) FILTER (WHERE kind IN ('unmatched_gt','confused') OR kind = 'matched' AND score < t) AS fn, count(*) FILTER (WHERE kind = 'confused' AND score >= t) AS confused,
   max(score) FILTER (WHERE kind IN ('matched','unmatched_inf') AND score >= t) AS hi, min(score) FILTER (WHERE kind IN ('matched','unmatched_inf') AND score >= t) AS lo
   FROM (SELECT mm.*, th.threshold AS t FROM mm LEFT JOIN th ON th.label = coalesce(mm.inf_label, mm.gt_label) WHERE kind <> 'ignored') GROUP BY 1)"""


@query("d12_image_metrics_multiclass", IMAGE_MULTI, ctes=SCORES + THRESH)
def d12(spark, sf):
    m = multi(spark, sf)
    return detection.image_metrics(m, curves.optimal_f1(curves.detection_counts(m), ["label"]))


@query("d13_thresholded_counts", """SELECT image_id, label, g.threshold, count(*) FILTER (WHERE kind = 'matched' AND score >= g.threshold) AS tp,
  count(*) FILTER (WHERE kind = 'unmatched_inf' AND score >= g.threshold) AS fp,
  count(*) FILTER (WHERE kind IN ('unmatched_gt','confused') OR kind = 'matched' AND score < g.threshold) AS fn
  FROM (SELECT *, CASE WHEN kind IN ('unmatched_gt','confused') THEN gt_label ELSE inf_label END AS label FROM mm WHERE kind <> 'ignored'),
  (SELECT CAST(v AS DOUBLE) AS threshold FROM (VALUES (0.1), (0.25), (0.5), (0.75), (0.9)) t(v)) g GROUP BY ALL""", ctes=MULTI)  # fmt: skip
def d13(spark, sf):
    return detection.thresholded_counts(multi(spark, sf), [0.1, 0.25, 0.5, 0.75, 0.9])


@query("d14_threshold_grid", """SELECT round(min(score) + k * (max(score) - min(score)) / 500, 9) AS threshold FROM w_det_inf, range(501) t(k) GROUP BY k""")
def d14(spark, sf):
    return detection.threshold_grid(views.det_inf(spark, sf)).select(F.round("threshold", 9).alias("threshold"))


@query("d14_threshold_grid_by_group", """SELECT label, NULL AS image_id, round(min(score) + k * (max(score) - min(score)) / 500, 9) AS threshold FROM w_det_inf, range(501) t(k) GROUP BY label, k
  UNION ALL SELECT NULL, image_id, round(score, 9) FROM w_det_inf""")  # fmt: skip
def d14_groups(spark, sf):
    """Labels have more scores than points and get an even grid; images have fewer and keep them all, repeats too."""
    infs = views.det_inf(spark, sf)
    grids = detection.threshold_grid(infs, by=["label"]).unionByName(detection.threshold_grid(infs, by=["image_id"]), allowMissingColumns=True)
    return grids.select("label", "image_id", F.round("threshold", 9).alias("threshold"))


DET_RESULTS = SCORES.replace("w_det_inf", "f_inf") + THRESH


@query("d15_detection_results", IMAGE_MULTI, ctes="f_inf AS (SELECT * FROM w_det_inf WHERE score >= 0.2),\n" + DET_RESULTS)
def d15(spark, sf):
    return detection.detection_results(gts(spark, sf), infs(spark, sf), threshold_strategy=detection.F1_OPTIMAL, min_confidence_score=0.2)


@query("b17_filter_inferences", """SELECT label, count(*) AS n, round(min(score), 6) AS lo FROM w_det_inf WHERE score >= 0.3 AND label IN ('A','R') GROUP BY 1""")
def b17(spark, sf):
    kept = detection.filter_inferences(views.det_inf(spark, sf), 0.3, ["A", "R"])
    return kept.groupBy("label").agg(F.count("*").alias("n"), r6(F.min("score")).alias("lo"))


@query("e12_detection_confusion", """SELECT a.label AS actual, b.label AS predicted, count(mm.image_id) AS n FROM (SELECT DISTINCT gt_label AS label FROM mm WHERE gt_label IS NOT NULL) a
  CROSS JOIN (SELECT DISTINCT gt_label AS label FROM mm WHERE gt_label IS NOT NULL) b
  LEFT JOIN mm ON mm.kind IN ('matched','confused') AND mm.gt_label = a.label AND mm.inf_label = b.label GROUP BY 1, 2""", ctes=MULTI)  # fmt: skip
def e12(spark, sf):
    return detection.confusion_matrix(multi(spark, sf))


@query("e17_f1_optimal_by_label", "SELECT label, threshold FROM th", ctes=SCORES + THRESH)
def e17(spark, sf):
    return curves.optimal_f1(curves.detection_counts(multi(spark, sf)), ["label"])


ONE = SCORES.replace("SELECT label, s, sum(y) AS pos", "SELECT 'all' AS label, s, sum(y) AS pos")


@query("e17_f1_optimal_overall", "SELECT threshold FROM th", ctes=ONE + THRESH)
def e17b(spark, sf):
    return curves.optimal_f1(curves.detection_counts(multi(spark, sf), []), [])


CAPPED = """, sp AS (SELECT label, count(*) AS n, min(threshold) AS lo, max(threshold) AS hi FROM pts GROUP BY 1),
grid AS (SELECT label, CASE WHEN k = 500 THEN hi ELSE lo + k * ((hi - lo) / 500) END AS t FROM sp, range(501) r(k) WHERE n >= 501
  UNION ALL SELECT pts.label, threshold FROM pts JOIN sp USING (label) WHERE n < 501),
gc AS (SELECT g.label, t AS threshold, (SELECT n_pos FROM cum WHERE cum.label = g.label LIMIT 1) AS n_pos, sum(h.pos) AS tp, sum(h.neg) AS fp
  FROM grid g JOIN hist h ON h.label = g.label AND h.s >= g.t GROUP BY 1, 2),
gr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN n_pos > 0 THEN tp / n_pos ELSE 0 END AS r FROM gc),
dd AS (SELECT label, threshold, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM gr
  QUALIFY row_number() OVER (PARTITION BY label, tp ORDER BY p DESC, threshold DESC) = 1),
pr AS (SELECT * FROM dd UNION ALL SELECT label, arg_min(threshold, r), arg_min(p, r), 0, arg_min(f1, r) FROM dd GROUP BY 1 HAVING min(r) > 0)"""
CURVE = "SELECT label, round(threshold, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM"


def curve_out(df, *by):
    return df.select(*by, *[r6(c).alias(c) for c in ("threshold", "precision", "recall", "f1")])


@query("e18_pr_curve_by_label", CURVE + " pr QUALIFY count(*) OVER (PARTITION BY label) >= 2", ctes=SCORES + CAPPED)
def e18(spark, sf):
    return curve_out(curves.pr_curve(curves.detection_counts(multi(spark, sf)), ["label"]), "label")


@query("e18_f1_curve_overall", CURVE.replace("label, ", "", 1) + " dd", ctes=ONE + CAPPED)
def e18b(spark, sf):
    return curve_out(curves.f1_curve(curves.detection_counts(multi(spark, sf), [])))


AP = """, env AS (SELECT *, max(p) OVER (PARTITION BY label ORDER BY threshold) AS best FROM pts),
ap AS (SELECT label, sum(pos / n_pos * best) AS ap FROM env GROUP BY 1)"""


@query("e19_average_precision", "SELECT label, round(ap, 6) AS ap FROM ap", ctes=SCORES + AP)
def e19(spark, sf):
    return curves.average_precision(curves.detection_counts(multi(spark, sf)), ["label"]).select("label", r6("ap").alias("ap"))


@query("e20_ap_11_point", """SELECT label, round(avg(coalesce(best, 0)), 6) AS ap FROM (SELECT l.label, k, (SELECT max(p) FROM pts WHERE pts.label = l.label AND r + 1e-10 >= k / 10.0) AS best
  FROM (SELECT DISTINCT label FROM pts) l, range(11) g(k)) GROUP BY 1""", ctes=SCORES)  # fmt: skip
def e20(spark, sf):
    ap = curves.interpolated_ap(curves.detection_counts(multi(spark, sf)), ["label"], 11)
    return ap.select("label", r6("ap").alias("ap"))


@query("e20_map_101_point", """SELECT round(avg(ap), 6) AS mean_ap FROM (SELECT label, avg(coalesce(best, 0)) AS ap FROM
  (SELECT l.label, k, (SELECT max(p) FROM pts WHERE pts.label = l.label AND r + 1e-11 >= k / 100.0) AS best FROM (SELECT DISTINCT label FROM pts) l, range(101) g(k)) GROUP BY 1)""",
  ctes=SCORES)
def e20b(spark, sf):
    ap = curves.interpolated_ap(curves.detection_counts(multi(spark, sf)), ["label"], 101)
    return ap.agg(r6(F.avg("ap")).alias("mean_ap"))


CLASS = """, cm AS (SELECT mm.stratum AS test_case, coalesce(CASE WHEN kind IN ('unmatched_gt','confused') THEN gt_label END, inf_label) AS label, mm.*, th.threshold AS t
  FROM mm JOIN th ON th.label = coalesce(CASE WHEN kind IN ('unmatched_gt','confused') THEN gt_label END, inf_label) WHERE kind <> 'ignored'),
chist AS (SELECT stratum, label, s, sum(y) AS pos, sum(1 - y) AS neg FROM ys GROUP BY ALL),
ccum AS (SELECT stratum, label, s, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY stratum, label) AS n_pos FROM chist
  WINDOW w AS (PARTITION BY stratum, label ORDER BY s DESC)),
cenv AS (SELECT *, max(tp / (tp + fp)) OVER (PARTITION BY stratum, label ORDER BY s) AS best FROM ccum WHERE s >= 0),
cap AS (SELECT stratum, label, sum(pos / n_pos * best) AS ap FROM cenv GROUP BY 1, 2),
cc AS (SELECT test_case, label, max(t) AS threshold, count(DISTINCT image_id) FILTER (WHERE kind <> 'unmatched_inf') AS n_images,
  count(*) FILTER (WHERE kind <> 'unmatched_inf') AS objects, count(*) FILTER (WHERE kind IN ('matched','unmatched_inf') AND score >= t) AS inferences,
  count(*) FILTER (WHERE kind = 'matched' AND score >= t) AS tp, count(*) FILTER (WHERE kind = 'unmatched_inf' AND score >= t) AS fp,
  count(*) FILTER (WHERE kind IN ('unmatched_gt','confused') OR kind = 'matched' AND score < t) AS fn FROM cm GROUP BY 1, 2),
cr AS (SELECT cc.*, ap, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM cc JOIN cap ON cap.stratum = test_case AND cap.label = cc.label)"""


def case_matches(spark, sf):
    m = multi(spark, sf)
    return m.withColumn("test_case", F.coalesce("inf.stratum", "gt.stratum"))


def class_table(spark, sf):
    m = case_matches(spark, sf)
    return detection.class_metrics(m, curves.optimal_f1(curves.detection_counts(m), ["label"]))


@query("e37_class_metrics", """SELECT test_case, label, threshold, n_images, objects, inferences, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, round(ap, 6) AS ap FROM cr""", ctes=SCORES + THRESH + CLASS)  # fmt: skip
def e37(spark, sf):
    rates = [r6(c).alias(c) for c in ("precision", "recall", "f1", "ap")]
    return class_table(spark, sf).select("test_case", "label", "threshold", "n_images", "objects", "inferences", "tp", "fp", "fn", *rates)


CASE = """, ct AS (SELECT test_case, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
  avg(f1) AS macro_f1, avg(ap) AS mean_ap FROM cr GROUP BY 1)"""


@query("e38_case_metrics", """SELECT test_case, tp, fp, fn, round(macro_precision, 6) AS macro_precision, round(macro_recall, 6) AS macro_recall, round(macro_f1, 6) AS macro_f1,
  round(mean_ap, 6) AS mean_ap, round(tp / (tp + fp), 6) AS micro_precision, round(tp / (tp + fn), 6) AS micro_recall, round(2 * tp / (2 * tp + fp + fn), 6) AS micro_f1 FROM ct""",
  ctes=SCORES + THRESH + CLASS + CASE)
def e38(spark, sf):
    table = detection.case_metrics(class_table(spark, sf))
    return table.select("test_case", "tp", "fp", "fn", *[r6(c).alias(c) for c in table.columns if c.startswith(("macro", "micro", "mean"))])


@query("e39_suite_metrics", """SELECT round((SELECT avg(mean_ap) FROM ct), 6) AS mean_ap, round((SELECT var_pop(macro_f1) FROM ct), 9) AS f1_variance,
  (SELECT count(DISTINCT image_id) FROM w_det_gt) AS n_images""", ctes=SCORES + THRESH + CLASS + CASE)  # fmt: skip
def e39(spark, sf):
    images = views.det_gt(spark, sf).agg(F.countDistinct("image_id").alias("n"))
    cases = detection.case_metrics(class_table(spark, sf))
    return cases.agg(r6(F.avg("mean_ap")).alias("mean_ap"), F.round(F.var_pop("macro_f1"), 9).alias("f1_variance")).withColumn(
        "n_images", images.scalar()
    )


@query("e10_detection_metric_macro", """SELECT round(avg(tp / (tp + fp)), 6) AS precision, round(avg(tp / (tp + fn)), 6) AS recall, round(avg(2 * tp / (2 * tp + fp + fn)), 6) AS f1,
  round((SELECT avg(ap) FROM ap), 6) AS average_precision FROM (SELECT label, count(*) FILTER (WHERE y = 1 AND s >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND s >= 0.5) AS fp,
  count(*) FILTER (WHERE y = 1 AND s < 0.5) AS fn FROM ys GROUP BY 1)""", ctes=SCORES + AP)  # fmt: skip
def e10(spark, sf):
    m = multi(spark, sf).where("kind <> 'ignored'").withColumn("label", detection.label_of())
    ap = curves.average_precision(curves.detection_counts(m), ["label"])
    rates = detection.with_rates(detection.outcome_counts(m, ["label"], 0.5)).join(ap, "label")
    return rates.agg(
        r6(F.avg("precision")).alias("precision"), r6(F.avg("recall")).alias("recall"), r6(F.avg("f1")).alias("f1"),
        r6(F.avg("ap")).alias("average_precision"),
    )


@query("e01_flagship_label_rates", """SELECT label, tp, fp, fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1
  FROM (SELECT label, count(*) FILTER (WHERE kind = 'matched') AS tp, count(*) FILTER (WHERE kind = 'unmatched_inf') AS fp, count(*) FILTER (WHERE kind = 'unmatched_gt') AS fn
  FROM (SELECT label, kind FROM m_all UNION ALL SELECT label, 'unmatched_gt' FROM m_fn) GROUP BY 1)""", ctes=PER_LABEL)  # fmt: skip
def flagship(spark, sf):
    m = per_label(spark, sf).where("kind <> 'ignored'").withColumn("label", detection.label_of())
    rates = detection.with_rates(detection.outcome_counts(m, ["label"], 0.0))
    return rates.select("label", "tp", "fp", "fn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])
