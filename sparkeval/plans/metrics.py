"""Queries on metric aggregates, classification, regression, histograms and stratification."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkeval.functions.ratios import accuracy, f1_score, f_beta, false_positive_rate, precision, r6, recall, specificity
from sparkeval.operators import classification, curves, regression, strata
from sparkeval.operators.running import exact_quantiles
from sparkeval.plans import views
from sparkeval.plans.registry import query
from sparkeval.session import table

COUNTS = """c AS (SELECT stratum, count(*) FILTER (WHERE gt = 'A' AND pred = 'A') AS tp, count(*) FILTER (WHERE gt <> 'A' AND pred = 'A') AS fp,
  count(*) FILTER (WHERE gt = 'A' AND pred <> 'A') AS fn, count(*) FILTER (WHERE gt <> 'A' AND pred <> 'A') AS tn FROM w_cls GROUP BY 1)"""


def one_class(spark, sf):
    return views.cls(spark, sf).groupBy("stratum").agg(
        F.count_if(F.expr("gt = 'A' AND pred = 'A'")).alias("tp"),
        F.count_if(F.expr("gt <> 'A' AND pred = 'A'")).alias("fp"), F.count_if(F.expr("gt = 'A' AND pred <> 'A'")).alias("fn"),
        F.count_if(F.expr("gt <> 'A' AND pred <> 'A'")).alias("tn"),
    )


@query("e01_count_formulas", """SELECT stratum, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(fp / (fp + tn), 6) AS fpr, round(tn / (fp + tn), 6) AS specificity FROM c""", ctes=COUNTS)  # fmt: skip
def e01(spark, sf):
    return one_class(spark, sf).select(
        "stratum", r6(accuracy("tp", "fp", "fn", "tn")).alias("accuracy"), r6(precision("tp", "fp")).alias("precision"), r6(recall("tp", "fn")).alias("recall"),
        r6(f1_score("tp", "fp", "fn")).alias("f1"), r6(false_positive_rate("fp", "tn")).alias("fpr"), r6(specificity("fp", "tn")).alias("specificity"),
    )


@query("e02_f_beta", """SELECT stratum, round(5 * tp / (5 * tp + 4 * fn + fp), 6) AS f2, round(1.25 * tp / (1.25 * tp + 0.25 * fn + fp), 6) AS f_half FROM c""", ctes=COUNTS)
def e02(spark, sf):
    return one_class(spark, sf).select("stratum", r6(f_beta("tp", "fp", "fn", 2)).alias("f2"), r6(f_beta("tp", "fp", "fn", 0.5)).alias("f_half"))


@query("e03_simple_metrics", """SELECT model, count(score) AS count, round(min(score), 6) AS min, round(max(score), 6) AS max, round(avg(score), 6) AS mean, round(median(score), 6) AS median,
  round(stddev(score), 6) AS stddev, round(sum(score), 3) AS sum FROM w_res GROUP BY 1""")  # fmt: skip
def e03(spark, sf):
    s = strata.numeric_stats(views.res(spark, sf), "score", ["model"])
    return s.select("model", "count", *[r6(c).alias(c) for c in ("min", "max", "mean", "median", "stddev")], F.round("sum", 3).alias("sum"))


@query("e04_categorical_metric", """SELECT priority, count(*) FILTER (WHERE segment = 'BUILDING') AS n, round(avg(CASE WHEN segment = 'BUILDING' THEN 1.0 ELSE 0 END), 6) AS rate FROM w_dp GROUP BY 1""")
def e04(spark, sf):
    hit = F.col("segment") == "BUILDING"
    return views.dp(spark, sf).groupBy("priority").agg(F.count_if(hit).alias("n"), r6(F.avg(hit.cast("double"))).alias("rate"))


@query("e05_count_field_metrics", """SELECT model, round(sum(tp) / (sum(tp) + sum(fp)), 6) AS precision, round(sum(tp) / (sum(tp) + sum(fn)), 6) AS recall,
  round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS f1, round((sum(tp) + sum(tn)) / (sum(tp) + sum(fp) + sum(fn) + sum(tn)), 6) AS accuracy,
  round(sum(fp) / (sum(fp) + sum(tn)), 6) AS false_positive_rate, round(sum(tn) / (sum(fp) + sum(tn)), 6) AS true_negative_rate FROM (SELECT *, id % 4 AS tn FROM w_res) GROUP BY 1""")  # fmt: skip
def e05(spark, sf):
    sums = views.res(spark, sf).withColumn("tn", F.col("id") % 4).groupBy("model").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    return sums.select(
        "model", r6(precision("tp", "fp")).alias("precision"), r6(recall("tp", "fn")).alias("recall"), r6(f1_score("tp", "fp", "fn")).alias("f1"),
        r6(accuracy("tp", "fp", "fn", "tn")).alias("accuracy"), r6(false_positive_rate("fp", "tn")).alias("false_positive_rate"),
        r6(specificity("fp", "tn")).alias("true_negative_rate"),
    )


@query("e06_weighted_mean", """SELECT model, round(sum(score * price) / sum(price), 6) AS value FROM w_res JOIN w_dp USING (id) GROUP BY 1""")
def e06(spark, sf):
    joined = views.res(spark, sf).select("model", "id", "score").join(views.dp(spark, sf).select("id", "price"), "id")
    return joined.groupBy("model").agg(r6(strata.weighted_mean("score", "price")).alias("value"))


AUC = """ranks AS (SELECT stratum, gt, rank() OVER (PARTITION BY stratum ORDER BY score) + (count(*) OVER (PARTITION BY stratum, score) - 1) / 2.0 AS r FROM w_bin),
auc AS (SELECT stratum, (sum(r) FILTER (WHERE gt) - count(*) FILTER (WHERE gt) * (count(*) FILTER (WHERE gt) + 1) / 2.0) / (count(*) FILTER (WHERE gt) * count(*) FILTER (WHERE NOT gt)) AS auc FROM ranks GROUP BY 1)"""


@query("e07_binary_metrics", """SELECT stratum, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(auc, 6) AS auc FROM (
  SELECT stratum, count(*) FILTER (WHERE gt AND score >= 0.5) AS tp, count(*) FILTER (WHERE NOT gt AND score >= 0.5) AS fp, count(*) FILTER (WHERE gt AND score < 0.5) AS fn,
  count(*) FILTER (WHERE NOT gt AND score < 0.5) AS tn FROM w_bin GROUP BY 1) LEFT JOIN auc USING (stratum)""", ctes=AUC)  # fmt: skip
def e07(spark, sf):
    m = classification.binary_metrics(views.binary(spark, sf), ["stratum"], 0.5)
    return m.select("stratum", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "auc")])


PER_CLASS = """cls AS (SELECT stratum, label, count(*) FILTER (WHERE gt = label AND pred = label) AS tp, count(*) FILTER (WHERE gt <> label AND pred = label) AS fp,
  count(*) FILTER (WHERE gt = label AND pred <> label) AS fn, count(*) FILTER (WHERE gt <> label AND pred <> label) AS tn FROM w_cls, (SELECT DISTINCT gt AS label FROM w_cls) l GROUP BY 1, 2)"""


@query("e08_per_class", """SELECT stratum, label, tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
  round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM cls""", ctes=PER_CLASS)  # fmt: skip
def e08(spark, sf):
    cells = classification.confusion_counts(views.cls(spark, sf), ["stratum"])
    rates = classification.class_rates(classification.class_counts(cells, ["stratum"]))
    return rates.select("stratum", "label", "tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("e08_averages", """SELECT 'macro' AS average, stratum, round(avg(tp / (tp + fp)), 6) AS precision, round(avg(tp / (tp + fn)), 6) AS recall, round(avg(2 * tp / (2 * tp + fp + fn)), 6) AS f1 FROM cls GROUP BY 2
  UNION ALL SELECT 'micro', stratum, round(sum(tp) / (sum(tp) + sum(fp)), 6), round(sum(tp) / (sum(tp) + sum(fn)), 6), round(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) FROM cls GROUP BY 2
  UNION ALL SELECT 'weighted', stratum, round(sum(tp / (tp + fp) * (tp + fn)) / sum(tp + fn), 6), round(sum(tp / (tp + fn) * (tp + fn)) / sum(tp + fn), 6),
  round(sum(2 * tp / (2 * tp + fp + fn) * (tp + fn)) / sum(tp + fn), 6) FROM cls GROUP BY 2""", ctes=PER_CLASS)  # fmt: skip
def e08b(spark, sf):
    counts = classification.class_counts(classification.confusion_counts(views.cls(spark, sf), ["stratum"]), ["stratum"])
    parts = [classification.averaged(counts, ["stratum"], a).withColumn("average", F.lit(a)) for a in ("macro", "micro", "weighted")]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("average", "stratum", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


RANKS = """rk AS (SELECT stratum, rank() OVER (PARTITION BY stratum ORDER BY gt) + (count(*) OVER (PARTITION BY stratum, gt) - 1) / 2.0 AS rg,
  rank() OVER (PARTITION BY stratum ORDER BY pred) + (count(*) OVER (PARTITION BY stratum, pred) - 1) / 2.0 AS rp FROM w_reg)"""


@query("e09_regression", """SELECT stratum, round(avg(abs(pred - gt)), 4) AS mae, round(sqrt(avg((pred - gt) ** 2)), 4) AS rmse, round(avg((pred - gt) ** 2), 2) AS mse,
  round(1 - sum((pred - gt) ** 2) / (var_pop(gt) * count(*)), 6) AS r_squared, round(corr(pred, gt), 6) AS pearson, round((SELECT corr(rg, rp) FROM rk WHERE rk.stratum = w_reg.stratum), 6) AS spearman
  FROM w_reg GROUP BY stratum""", ctes=RANKS)  # fmt: skip
def e09(spark, sf):
    df = views.reg(spark, sf).select("stratum", "gt", "pred")
    out = regression.regression_metrics(df, ["stratum"]).join(regression.spearman(df, ["stratum"]), "stratum")
    return out.select("stratum", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("mse", 2).alias("mse"),
                      *[r6(c).alias(c) for c in ("r_squared", "pearson", "spearman")])


THRESHOLDED = """tt AS (SELECT stratum, t.v AS threshold, count(*) FILTER (WHERE gt AND score >= t.v) AS tp, count(*) FILTER (WHERE NOT gt AND score >= t.v) AS fp,
  count(*) FILTER (WHERE gt AND score < t.v) AS fn FROM w_bin, (SELECT CAST(x AS DOUBLE) / 10 AS v FROM range(1, 10) r(x)) t GROUP BY 1, 2)"""


@query("e11_thresholded_object_metric", """SELECT stratum AS label, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1
  FROM tt WHERE threshold = 0.5""", ctes=THRESHOLDED)  # fmt: skip
def e11(spark, sf):
    cuts = F.array(*[F.lit(x / 10) for x in range(1, 10)])
    one = lambda c: c.cast("long")
    objects = F.transform(cuts, lambda t: F.struct(
        t.alias("threshold"), one(F.col("gt") & (F.col("score") >= t)).alias("tp"), one(~F.col("gt") & (F.col("score") >= t)).alias("fp"),
        one(F.col("gt") & (F.col("score") < t)).alias("fn"),
    ))
    rows = views.binary(spark, sf).select(F.col("stratum").alias("label"), objects.alias("thresholded"))
    at = rows.select("label", F.explode(F.filter("thresholded", lambda o: o["threshold"] == 0.5)).alias("o")).select("label", "o.*")
    sums = at.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return sums.select("label", r6(precision("tp", "fp")).alias("precision"), r6(recall("tp", "fn")).alias("recall"), r6(f1_score("tp", "fp", "fn")).alias("f1"))


@query("e13_confusion_matrix", """SELECT a.l AS actual, b.l AS predicted, count(w.gt) AS n FROM (SELECT DISTINCT gt AS l FROM w_cls) a CROSS JOIN (SELECT DISTINCT gt AS l FROM w_cls) b
  LEFT JOIN w_cls w ON w.gt = a.l AND w.pred = b.l GROUP BY 1, 2""")  # fmt: skip
def e13(spark, sf):
    return classification.confusion_matrix(views.cls(spark, sf))


@query("e13_confusion_matrix_labels", """SELECT a.l AS actual, b.l AS predicted, count(w.gt) AS n FROM (VALUES ('R'), ('A')) a(l) CROSS JOIN (VALUES ('R'), ('A')) b(l)
  LEFT JOIN w_cls w ON w.gt = a.l AND w.pred = b.l GROUP BY 1, 2""")  # fmt: skip
def e13b(spark, sf):
    return classification.confusion_matrix(views.cls(spark, sf), ["R", "A"])


@query("e14_normalized_confusion", """SELECT gt AS actual, pred AS predicted, round(n / sum(n) OVER (PARTITION BY gt), 6) AS by_row, round(n / sum(n) OVER (PARTITION BY pred), 6) AS by_column,
  round(n / sum(n) OVER (), 6) AS by_all FROM (SELECT gt, pred, count(*) AS n FROM w_cls GROUP BY 1, 2)""")  # fmt: skip
def e14(spark, sf):
    m = classification.confusion_matrix(views.cls(spark, sf))
    for how in ("row", "column", "all"):
        m = classification.normalized(m, how).withColumn(f"by_{how}", r6("share")).drop("share")
    return m.drop("n")


ROC = """h AS (SELECT gt AS label0, score, gt FROM w_cls), lab AS (SELECT DISTINCT gt AS label FROM w_cls),
rh AS (SELECT label, score, count(*) FILTER (WHERE gt = label) AS pos, count(*) FILTER (WHERE gt <> label) AS neg FROM w_cls, lab GROUP BY 1, 2),
rc AS (SELECT label, score, pos, neg, sum(pos) OVER w / sum(pos) OVER (PARTITION BY label) AS tpr, sum(neg) OVER w / sum(neg) OVER (PARTITION BY label) AS fpr,
  lead(pos) OVER w AS np, lead(neg) OVER w AS nn FROM rh WINDOW w AS (PARTITION BY label ORDER BY score DESC))"""


def one_vs_rest(spark, sf):
    """Score counts per label, each label against the rest, from counts per (score, label)."""
    hist = views.cls(spark, sf).groupBy("score", "gt").agg(F.count("*").alias("n"))
    labels = hist.agg(F.collect_set("gt")).scalar()
    wide = hist.withColumn("label", F.explode(labels))
    hit = F.col("gt") == F.col("label")
    return wide.groupBy("label", "score").agg(F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(hit, 0).otherwise(F.col("n"))).alias("neg"))


@query("e15_roc_curve", """SELECT label, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM rc WHERE np IS NULL OR pos * nn <> neg * np UNION ALL SELECT label, 0.0, 0.0 FROM lab""", ctes=ROC)
def e15(spark, sf):
    return curves.roc_curve(one_vs_rest(spark, sf), ["label"]).select("label", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("e16_auc_roc", """SELECT stratum, round(auc, 6) AS auc FROM auc""", ctes=AUC)
def e16(spark, sf):
    counts = curves.score_counts(views.binary(spark, sf), ["stratum"], F.col("gt"), F.col("score"))
    return curves.auc_roc(counts, ["stratum"]).select("stratum", r6("auc").alias("auc"))


PRC = """bh AS (SELECT score, count(*) FILTER (WHERE gt) AS pos, count(*) FILTER (WHERE NOT gt) AS neg FROM w_bin GROUP BY 1),
bc AS (SELECT score, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS n_pos FROM bh WINDOW w AS (ORDER BY score DESC)),
bp AS (SELECT *, tp / (tp + fp) AS p, coalesce(lag(tp / (tp + fp)) OVER (ORDER BY score DESC), 1.0) AS pp FROM bc)"""


@query("e16_auc_pr", "SELECT round(sum(pos / n_pos * (p + pp) / 2), 6) AS auc FROM bp", ctes=PRC)
def e16b(spark, sf):
    return curves.auc_pr(curves.score_counts(views.binary(spark, sf), [], F.col("gt"), F.col("score"))).select(r6("auc").alias("auc"))


@query("e21_threshold_curves", """SELECT threshold, tp, fp, fn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM (
  SELECT t.v AS threshold, count(*) FILTER (WHERE gt AND score >= t.v) AS tp, count(*) FILTER (WHERE NOT gt AND score >= t.v) AS fp, count(*) FILTER (WHERE gt AND score < t.v) AS fn
  FROM w_bin, (SELECT CAST(x AS DOUBLE) / 20 AS v FROM range(0, 21) r(x)) t GROUP BY 1)""")  # fmt: skip
def e21(spark, sf):
    at = classification.threshold_curves(views.binary(spark, sf), [x / 20 for x in range(21)])
    return at.select("threshold", "tp", "fp", "fn", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("e21_threshold_curves_thinned", """SELECT threshold, tp, fp, fn FROM (SELECT t AS threshold, count(*) FILTER (WHERE gt AND score >= t) AS tp,
  count(*) FILTER (WHERE NOT gt AND score >= t) AS fp, count(*) FILTER (WHERE gt AND score < t) AS fn FROM w_bin, th GROUP BY 1)""",
  ctes="""cand AS (SELECT DISTINCT score AS s FROM w_bin UNION SELECT CAST(x AS DOUBLE) / 10 FROM range(0, 11) r(x)),
th(t) AS (SELECT CAST(0 AS DOUBLE) UNION ALL SELECT (SELECT min(s) FROM cand WHERE abs(s - t) >= 0.01 AND s > t) FROM th WHERE EXISTS (SELECT 1 FROM cand WHERE abs(s - t) >= 0.01 AND s > t))""",
  recursive=True)
def e21b(spark, sf):
    df = views.binary(spark, sf)
    return classification.threshold_curves(df, classification.thin_thresholds(df)).select("threshold", "tp", "fp", "fn")


@query("e22_score_histogram", """SELECT series, bin, count(*) AS n FROM (SELECT 'all' AS series, score FROM w_cls UNION ALL SELECT CASE WHEN gt = pred THEN 'correct' ELSE 'incorrect' END, score FROM w_cls),
  (SELECT floor((min(score) + 1e-9) / 0.02) * 0.02 AS lo, floor((max(score) - 1e-9) / 0.02) * 0.02 + 0.02 AS hi FROM w_cls) r,
  (SELECT k AS bin FROM range(0, 50) t(k)) b WHERE score >= lo + bin * ((hi - lo) / 50) AND (score < lo + (bin + 1) * ((hi - lo) / 50) OR bin = 49 AND score = hi) GROUP BY 1, 2""")  # fmt: skip
def e22(spark, sf):
    df = views.cls(spark, sf)
    span = strata.score_range(df, "score")
    correct = F.when(F.col("gt") == F.col("pred"), "correct").otherwise("incorrect")
    rows = df.select(F.explode(F.array(F.lit("all"), correct)).alias("series"), "score")
    h = strata.even_histogram(rows, "score", span.select("lo").scalar(), span.select("hi").scalar(), span.select("bins").scalar(), ["series"])
    return h.where("n > 0").select("series", "bin", "n")


LOG_EDGES = [2.0**k for k in range(10, 21)]


@query("e23_log_histogram_density", """SELECT stratum, CAST(floor(log2(gt)) - 10 AS INT) AS bin, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY stratum) * pow(2, floor(log2(gt)))), 9) AS density
  FROM w_reg WHERE gt >= 1024 AND gt < 1048576 GROUP BY stratum, floor(log2(gt))""")  # fmt: skip
def e23(spark, sf):
    h = strata.edge_histogram(views.reg(spark, sf), "gt", LOG_EDGES, ["stratum"], density=True)
    return h.select("stratum", "bin", "n", F.round("density", 9).alias("density"))


@query("e24_binned_mean_curve", """SELECT (floor(weight / 5) * 5 + 2.5) AS x, round(avg(abs(pred - gt)), 4) AS y FROM w_reg WHERE weight < 50 GROUP BY 1""")
def e24(spark, sf):
    df = views.reg(spark, sf).withColumn("err", F.abs(F.col("pred") - F.col("gt")))
    return strata.binned_mean(df, "weight", "err", [float(x) for x in range(0, 51, 5)]).select("x", F.round("y", 4).alias("y"))


@query("e25_group_mean_curve", "SELECT weight AS x, round(avg(abs(pred - gt)), 4) AS mae FROM w_reg GROUP BY 1")
def e25(spark, sf):
    return views.reg(spark, sf).groupBy(F.col("weight").alias("x")).agg(F.round(F.avg(F.abs(F.col("pred") - F.col("gt"))), 4).alias("mae"))


@query("e25_failure_rate_curve", """SELECT t.v AS threshold, round(count(*) FILTER (WHERE abs(pred - gt) / gt > t.v) / count(*), 6) AS rate FROM w_reg, (SELECT CAST(x AS DOUBLE) / 1000 AS v FROM range(0, 251) r(x)) t GROUP BY 1""")
def e25b(spark, sf):
    df = views.reg(spark, sf).select((F.abs(F.col("pred") - F.col("gt")) / F.col("gt")).alias("e"))
    return strata.failure_rate_curve(df, "e", [x / 1000 for x in range(251)]).select("threshold", r6("rate").alias("rate"))


@query("e26_categorical_stats", "SELECT 'segment' AS field, segment AS value, count(*) AS n FROM w_dp GROUP BY 2 UNION ALL SELECT 'priority', priority, count(*) FROM w_dp GROUP BY 2")
def e26(spark, sf):
    values = views.dp(spark, sf).unpivot([], ["segment", "priority"], "field", "value")
    return values.groupBy("field", "value").agg(F.count("*").alias("n"))


@query("e26_numeric_stats", """SELECT count(price) AS count, round(avg(price), 4) AS mean, round(median(price), 4) AS median, round(min(price), 4) AS min, round(max(price), 4) AS max,
  round(stddev(price), 4) AS stddev, round(sum(price), 1) AS sum FROM w_dp""")  # fmt: skip
def e26b(spark, sf):
    s = strata.numeric_stats(views.dp(spark, sf), "price")
    return s.select("count", *[F.round(c, 4).alias(c) for c in ("mean", "median", "min", "max", "stddev")], F.round("sum", 1).alias("sum"))


@query("e26_numeric_histogram", """SELECT CAST(least(floor((price - lo) / ((hi - lo) / 50)), 49) AS BIGINT) AS bin, count(*) AS n FROM w_dp, (SELECT min(price) AS lo, max(price) AS hi FROM w_dp) r GROUP BY 1""")
def e26c(spark, sf):
    df = views.dp(spark, sf)
    span = df.agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    return strata.even_histogram(df, "price", span.select("lo").scalar(), span.select("hi").scalar(), 50).where("n > 0").select("bin", "n")


@query("e26_array_stats", """SELECT lang, min(n) AS min, max(n) AS max, round(avg(n), 4) AS mean, CAST(sum(n) AS BIGINT) AS sum FROM (SELECT lang, CAST(len(string_split(text, ' ')) AS INT) AS n FROM documents) GROUP BY 1""")
def e26d(spark, sf):
    words = table(spark, sf, "documents").select("lang", F.size(F.split("text", " ")).alias("n"))
    return words.groupBy("lang").agg(F.min("n").alias("min"), F.max("n").alias("max"), F.round(F.avg("n"), 4).alias("mean"), F.sum("n").alias("sum"))


@query("e27_stratify_category", "SELECT segment, priority, count(*) AS n, round(avg(price), 4) AS mean_price FROM w_dp GROUP BY 1, 2")
def e27(spark, sf):
    return views.dp(spark, sf).groupBy("segment", "priority").agg(F.count("*").alias("n"), F.round(F.avg("price"), 4).alias("mean_price"))


@query("e27_stratify_edges", """SELECT CASE WHEN price < 50000 THEN 0 WHEN price < 150000 THEN 1 WHEN price <= 400000 THEN 2 END AS bucket, count(*) AS n FROM w_dp WHERE price BETWEEN 0 AND 400000 GROUP BY 1""")
def e27b(spark, sf):
    bucket = strata.bin_by_edges("price", [0, 50000, 150000, 400000])
    return views.dp(spark, sf).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).where("bucket IS NOT NULL")


@query("e27_stratify_equal_width", """SELECT CAST(least(floor((price - lo) / ((hi - lo) / 5)), 4) AS BIGINT) AS bucket, count(*) AS n FROM w_dp, (SELECT min(price) AS lo, max(price) AS hi FROM w_dp) r GROUP BY 1""")
def e27c(spark, sf):
    df = views.dp(spark, sf)
    return df.groupBy(strata.equal_width(df, "price", 5).alias("bucket")).agg(F.count("*").alias("n"))


@query("e27_stratify_equal_height", """SELECT CASE WHEN price < q[1] THEN 0 WHEN price < q[2] THEN 1 WHEN price < q[3] THEN 2 ELSE 3 END AS bucket, count(*) AS n, round(avg(price), 4) AS mean_price
  FROM w_dp, (SELECT quantile_cont(price, [0.25, 0.5, 0.75]) AS q FROM w_dp) GROUP BY 1""")  # fmt: skip
def e27d(spark, sf):
    df = views.dp(spark, sf)
    return df.groupBy(strata.equal_height(df, "price", 4).alias("bucket")).agg(F.count("*").alias("n"), F.round(F.avg("price"), 4).alias("mean_price"))


@query("e28_tertile_split", """SELECT CASE WHEN price < a THEN 'low' WHEN price < b THEN 'mid' ELSE 'high' END AS tertile, count(*) AS n FROM w_dp, (SELECT quantile_cont(price, 0.333) AS a, quantile_cont(price, 0.667) AS b FROM w_dp) GROUP BY 1""")
def e28(spark, sf):
    df = views.dp(spark, sf)
    q = exact_quantiles(df, [], "price", [0.333, 0.667])
    low, high = (q.where(F.col("fraction") == f).select("quantile").scalar() for f in (0.333, 0.667))
    return df.groupBy(F.when(F.col("price") < low, "low").when(F.col("price") < high, "mid").otherwise("high").alias("tertile")).agg(F.count("*").alias("n"))


@query("f07_quantile_bucket_names", """SELECT CASE WHEN price < q[1] THEN '1st tertile' WHEN price < q[2] THEN '2nd tertile' ELSE '3rd tertile' END AS bucket, count(*) AS n
  FROM w_dp, (SELECT quantile_cont(price, [1.0 / 3, 2.0 / 3]) AS q FROM w_dp) GROUP BY 1""")  # fmt: skip
def f07(spark, sf):
    df = views.dp(spark, sf)
    return df.groupBy(strata.bucket_name(strata.equal_height(df, "price", 3), 3).alias("bucket")).agg(F.count("*").alias("n"))


KAPPA = """m AS (SELECT (SELECT count(*) FROM w_cls) AS n, (SELECT count(*) FROM w_cls WHERE gt = pred) AS ok,
  (SELECT sum(a.n * b.n) FROM (SELECT gt AS l, count(*) AS n FROM w_cls GROUP BY 1) a JOIN (SELECT pred AS l, count(*) AS n FROM w_cls GROUP BY 1) b USING (l)) AS chance)"""


@query("e36_cohens_kappa", "SELECT round(ok / n, 6) AS po, round(chance / (n * n), 6) AS pe, round((ok / n - chance / (n * n)) / (1 - chance / (n * n)), 6) AS kappa FROM m", ctes=KAPPA)
def e36(spark, sf):
    return classification.cohens_kappa(classification.confusion_counts(views.cls(spark, sf))).select(*[r6(c).alias(c) for c in ("po", "pe", "kappa")])


@query("e36_kappa_two_class", "SELECT stratum, round(2 * (tp * tn - fn * fp) / ((tp + fp) * (fp + tn) + (tp + fn) * (fn + tn)), 6) AS kappa FROM c", ctes=COUNTS)
def e36b(spark, sf):
    return classification.kappa_2x2(one_class(spark, sf)).select("stratum", r6("kappa").alias("kappa"))


@query("e43_case_aggregates", """SELECT stratum, round(avg(abs(pred - gt)) FILTER (WHERE pred >= 0), 4) AS mae, round(sqrt(avg((pred - gt) ** 2) FILTER (WHERE pred >= 0)), 4) AS rmse,
  round(count(*) FILTER (WHERE abs(pred - gt) > 5000) / count(*), 6) AS failure_rate, round(avg(pred) FILTER (WHERE abs(pred - gt) <= 5000), 3) AS mean_of_good, round(sum(weight), 2) AS total_cost,
  round(avg(weight), 4) AS mean_cost FROM w_reg GROUP BY 1""")  # fmt: skip
def e43(spark, sf):
    e = regression.errors(views.reg(spark, sf))
    bad = F.coalesce(F.col("abs_error") > 5000, F.lit(False))
    return e.groupBy("stratum").agg(
        F.round(F.avg("abs_error"), 4).alias("mae"), F.round(F.sqrt(F.avg("squared_error")), 4).alias("rmse"),
        r6(F.count_if(bad) / F.count("*")).alias("failure_rate"), F.round(F.avg(F.when(~bad, F.col("pred"))), 3).alias("mean_of_good"),
        F.round(F.sum("weight"), 2).alias("total_cost"), F.round(F.avg("weight"), 4).alias("mean_cost"),
    )


@query("i10_regression_errors", """SELECT stratum, count(*) FILTER (WHERE pred IS NULL OR pred < 0) AS failed, round(sum(pred - gt), 1) AS error, round(sum(abs(pred - gt)), 1) AS abs_error FROM (
  SELECT stratum, gt, CASE WHEN order_id % 13 = 0 THEN NULL WHEN order_id % 17 = 0 THEN -1 ELSE pred END AS pred FROM w_reg) WHERE true GROUP BY 1""".replace(
  "sum(pred - gt)", "sum(pred - gt) FILTER (WHERE pred >= 0)").replace("sum(abs(pred - gt))", "sum(abs(pred - gt)) FILTER (WHERE pred >= 0)"))
def i10(spark, sf):
    df = views.reg(spark, sf).withColumn("pred", F.expr("CASE WHEN order_id % 13 = 0 THEN NULL WHEN order_id % 17 = 0 THEN -1D ELSE pred END"))
    e = regression.errors(df)
    return e.groupBy("stratum").agg(F.count_if("failed").alias("failed"), F.round(F.sum("error"), 1).alias("error"), F.round(F.sum("abs_error"), 1).alias("abs_error"))


@query("e44_three_valued_forecast", """SELECT lang, CAST(sum(CASE WHEN quality = 1 AND guess THEN 1 ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN quality = 0 AND guess THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN quality = 1 AND NOT guess THEN 1 ELSE 0 END) AS BIGINT) AS fn, CAST(sum(CASE WHEN quality = 0 AND NOT guess THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  count(*) FILTER (WHERE quality IS NULL) AS unknown, count(*) FILTER (WHERE (quality = 1) = guess) AS correct FROM (SELECT lang, quality, n_chars % 1000 >= 500 AS guess FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1""")  # fmt: skip
def e44(spark, sf):
    """Forecast with missing truth: all four flags are 0 and correctness is null."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    df = docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left").withColumn("guess", F.expr("n_chars % 1000 >= 500"))
    truth, guess = F.col("quality") == 1, F.col("guess")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    rows = df.select("lang", flag(truth & guess).alias("tp"), flag(~truth & guess).alias("fp"), flag(truth & ~guess).alias("fn"), flag(~truth & ~guess).alias("tn"),
                     (truth == guess).alias("is_correct"))
    sums = [F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]
    return rows.groupBy("lang").agg(*sums, F.count_if(F.col("is_correct").isNull()).alias("unknown"), F.count_if("is_correct").alias("correct"))
