"""Queries on checks, filters, joins, set operations, paging and quality standards."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions.ratios import f1_score, precision, r6, recall
from sparkeval.operators import checks, filters, joins, standard
from sparkeval.operators.filters import FieldFilter, Range, ResultFilter
from sparkeval.plans import views
from sparkeval.plans.registry import query
from sparkeval.session import materialize, table

LOC = """loc AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'bad/' || source ELSE 'S3://data/' || source || '/' || doc_id || '.' ||
  CASE doc_id % 6 WHEN 0 THEN 'png' WHEN 1 THEN 'PDF' WHEN 2 THEN 'mp4?v=1' WHEN 3 THEN 'wav#t=2' WHEN 4 THEN 'pcd' ELSE 'dat' END END AS locator FROM documents)"""


def locators(spark, sf):
    return table(spark, sf, "documents").selectExpr(
        "doc_id", """CASE WHEN doc_id % 7 = 0 THEN 'bad/' || source ELSE 'S3://data/' || source || '/' || doc_id || '.' ||
        CASE doc_id % 6 WHEN 0 THEN 'png' WHEN 1 THEN 'PDF' WHEN 2 THEN 'mp4?v=1' WHEN 3 THEN 'wav#t=2' WHEN 4 THEN 'pcd' ELSE 'dat' END END AS locator""",
    )


@query("b01_infer_data_type", """SELECT CASE WHEN doc_id % 7 = 0 THEN 'DATAPOINT/TABULAR' ELSE CASE doc_id % 6 WHEN 0 THEN 'DATAPOINT/IMAGE' WHEN 1 THEN 'DATAPOINT/DOCUMENT'
  WHEN 2 THEN 'DATAPOINT/VIDEO' WHEN 3 THEN 'DATAPOINT/AUDIO' WHEN 4 THEN 'DATAPOINT/POINT_CLOUD' ELSE 'DATAPOINT/TABULAR' END END AS data_type, count(*) AS n FROM loc GROUP BY 1""", ctes=LOC)  # fmt: skip
def b01(spark, sf):
    df = locators(spark, sf)
    return df.groupBy(checks.data_type(df).alias("data_type")).agg(F.count("*").alias("n"))


@query("b02_infer_id_fields", "SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1")
def b02(spark, sf):
    df = table(spark, sf, "conversations")
    return df.groupBy(*checks.infer_id_fields(df.columns)).agg(F.count("*").alias("n"))


@query("b03_duplicate_keys", "SELECT l_linenumber, l_orderkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def b03(spark, sf):
    return checks.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("b04_result_checks", "SELECT model, eval_config, count(*) AS n, count(DISTINCT id) AS ids FROM w_res GROUP BY 1, 2")
def b04(spark, sf):
    res = views.res(spark, sf)
    runs = res.select("eval_config").distinct().collect()  # one row per configuration
    checks.check_results(res.columns, ["id"], [], [r.eval_config for r in runs], ["tag"])
    return res.groupBy("model", "eval_config").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


@query("b04_result_violations", """SELECT 'duplicate_config' AS rule, model, eval_config, count(DISTINCT id % k) AS n FROM w_res, (SELECT 3 AS k) WHERE model = 'b' GROUP BY 2, 3 UNION ALL
  SELECT 'blank_tag', model, eval_config, 1 FROM w_res WHERE model = 'a' GROUP BY 2, 3 UNION ALL
  SELECT 'duplicate_id', model, eval_config, count(*) FROM w_res WHERE id % 13 = 0 GROUP BY 2, 3 UNION ALL SELECT 'no_result', model, eval_config, sum(CASE WHEN id % 13 = 0 THEN 2 ELSE 1 END)::BIGINT FROM w_res WHERE id % 7 = 0 GROUP BY 2, 3""")  # fmt: skip
def b04_violations(spark, sf):
    """Result sets with everything wrong: a configuration sent in three parts, a blank tag, repeated ids, rows without any result."""
    res = views.res(spark, sf).withColumn("score", F.expr("CASE WHEN id % 7 <> 0 THEN score END")).select("model", "eval_config", "id", "score", "tp")
    rows = res.unionByName(res.where("id % 13 = 0"))
    part = F.when(F.col("model") == "b", F.col("id") % 3).otherwise(F.lit(0))
    uploads = res.select("model", "eval_config", part.alias("part"), F.when(F.col("model") == "a", " ").otherwise("ok").alias("tag")).distinct()
    return checks.result_violations(uploads, rows, ["id"], ["tp"])


@query("b05_bad_locators", """SELECT doc_id, regexp_full_match(lower(locator), '(s3|gs|https)://(.+/)+.+') AS valid, regexp_full_match(lower(locator), '(s3|gs|https)://(.+/)+.+[.](png|jpe?g|gif|tiff?)') AS valid_image FROM loc""", ctes=LOC)
def b05(spark, sf):
    c = F.col("locator")
    return locators(spark, sf).select("doc_id", checks.valid_locator(c).alias("valid"), checks.valid_locator(c, True).alias("valid_image"))


@query("b06_bad_inferences", """SELECT label, count(*) AS n FROM (SELECT CASE WHEN line = 3 THEN ' ' ELSE pred END AS label, score * 1.5 AS score FROM w_cls) WHERE trim(label) = '' OR score > 1 OR score < 0 GROUP BY 1""")
def b06(spark, sf):
    df = views.cls(spark, sf).selectExpr("CASE WHEN line = 3 THEN ' ' ELSE pred END AS label", "score * 1.5D AS score")
    return checks.bad_inferences(df).groupBy("label").agg(F.count("*").alias("n"))


@query("b07_coercion_failures", """SELECT 'props' AS field, count(*) FILTER (WHERE try_cast(props AS BIGINT) IS NULL) AS failures FROM events UNION ALL
  SELECT 'event_type', count(*) FILTER (WHERE try_cast(event_type AS DOUBLE) IS NULL) FROM events UNION ALL SELECT 'value', 0 FROM events GROUP BY 1""")  # fmt: skip
def b07(spark, sf):
    return checks.coercion_failures(table(spark, sf, "events"), {"props": "bigint", "event_type": "double", "value": "double"})


@query("b07_trusted_sample", """WITH s AS (SELECT DISTINCT event_id FROM ((SELECT event_id FROM events ORDER BY event_id LIMIT 10) UNION ALL (SELECT event_id FROM events ORDER BY md5(event_id::VARCHAR) LIMIT 1000) UNION ALL (SELECT event_id FROM events ORDER BY event_id DESC LIMIT 10)))
SELECT 'event_type' AS field, count(*) FILTER (WHERE try_cast(event_type AS DOUBLE) IS NULL) AS failures FROM events WHERE event_id IN (SELECT event_id FROM s) UNION ALL SELECT 'value', 0""")  # fmt: skip
def b07_trusted(spark, sf):
    """A trusted frame is checked on its first and last rows and a sample of a thousand."""
    return checks.coercion_failures(checks.trusted_sample(table(spark, sf, "events"), "event_id"), {"event_type": "double", "value": "double"})


FF = {
    "value_in": ("segment", FieldFilter(value_in=["BUILDING", "MACHINERY"]), "segment IN ('BUILDING', 'MACHINERY')"),
    "not_in": ("segment", FieldFilter(value_in=["BUILDING"], inverse=True), "segment <> 'BUILDING'"),
    "range": ("price", FieldFilter(number_range=Range(1e5, 2e5)), "price BETWEEN 100000 AND 200000"),
    "modulo": ("id", FieldFilter(number_range=Range(min=10, modulo=4)), "id >= 10 AND id % 4 = 0"),
    "contains": ("priority", FieldFilter(contains="HIGH"), "priority LIKE '%HIGH%'"),
    "regex": ("priority", FieldFilter(contains="^[0-9]-(low|medium)", regex_match=True, regex_flags="i"), "regexp_matches(priority, '(?i)^[0-9]-(low|medium)')"),
    "is_null": ("odd", FieldFilter(null_value=True), "id % 2 = 0"),
    "array": ("words", FieldFilter(array_contains=["URGENT", "LOW"]), "priority LIKE '%URGENT%' OR priority LIKE '%LOW%'"),
}


@query("b08_field_filters", " UNION ALL ".join(f"SELECT '{n}' AS filter, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids FROM w_dp WHERE {w}" for n, (_, _, w) in FF.items()))
def b08(spark, sf):
    df = views.dp(spark, sf).withColumn("odd", F.expr("nullif(id % 2, 0)")).withColumn("words", F.split("priority", "-"))
    flags = F.explode(F.array(*[F.struct(F.lit(n).alias("filter"), F.coalesce(f.predicate(F.col(c)), F.lit(False)).alias("hit")) for n, (c, f, _) in FF.items()]))
    return df.select("id", flags.alias("f")).where("f.hit").groupBy("f.filter").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("b09_result_filter", "SELECT 'high' AS filter, count(*) AS n FROM w_res WHERE model = 'b' AND score >= 0.8 UNION ALL SELECT 'untested', count(*) FROM w_dp WHERE id NOT IN (SELECT id FROM w_res WHERE model = 'b')")
def b09(spark, sf):
    points, res = views.dp(spark, sf), views.res(spark, sf)
    config = '{"threshold": 0.5}'
    high = filters.by_results(points, res, [ResultFilter("b", config, {"score": FieldFilter(number_range=Range(min=0.8))})])
    none = filters.by_results(points, res, [ResultFilter("b", config, untested=True)])
    return high.select(F.lit("high").alias("filter")).unionAll(none.select(F.lit("untested"))).groupBy("filter").agg(F.count("*").alias("n"))


def both_models(spark, sf):
    points, res = views.dp(spark, sf), views.res(spark, sf)
    one = filters.with_result(points, res, "a", None, "resultA")
    return filters.with_result(one, res, "b", '{"threshold": 0.5}', "resultB")


AB = """ab AS (SELECT w_dp.*, a.score AS sa, b.score AS sb, a.tp AS ta, b.tp AS tb FROM w_dp LEFT JOIN (SELECT * FROM w_res WHERE model = 'a') a USING (id) LEFT JOIN (SELECT * FROM w_res WHERE model = 'b') b USING (id))"""


@query("b10_compare_filter", """SELECT count(*) FILTER (WHERE sa = sb) AS equal, count(*) FILTER (WHERE sa <> sb) AS not_equal, count(*) FILTER (WHERE sa > sb) AS greater_than,
  count(*) FILTER (WHERE sa < sb) AS smaller_than, count(*) FILTER (WHERE sa - sb BETWEEN -0.1 AND 0.1) AS difference_range FROM ab""", ctes=AB)  # fmt: skip
def b10(spark, sf):
    a, b = F.col("resultA.score"), F.col("resultB.score")
    ops = ["equal", "not_equal", "greater_than", "smaller_than", "difference_range"]
    return both_models(spark, sf).agg(*[F.count_if(filters.compared(a, op, b, Range(-0.1, 0.1))).alias(op) for op in ops])


@query("b11_filter_conjunction", "SELECT id, price FROM w_dp WHERE segment = 'BUILDING' AND price >= 50000 AND id IN (SELECT id FROM w_res WHERE model = 'b')")
def b11(spark, sf):
    tested = views.res(spark, sf).where("model = 'b'").select("id")
    f = {"segment": FieldFilter(value_in=["BUILDING"]), "price": FieldFilter(number_range=Range(min=50000))}
    return filters.by_fields(views.dp(spark, sf), f, tested).select("id", "price")


@query("b12_human_evaluation_filter", "SELECT lang, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0 GROUP BY 1")
def b12(spark, sf):
    human = table(spark, sf, "labels").selectExpr("doc_id", "'human' AS model", "CAST(NULL AS STRING) AS eval_config", "quality", "toxic")
    good = {"quality": FieldFilter(number_range=Range(1, 1)), "toxic": FieldFilter(number_range=Range(0, 0))}
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return filters.by_results(docs, human, [ResultFilter("human", None, good)], ["doc_id"]).groupBy("lang").agg(F.count("*").alias("n"))


DIFF = """sp AS (SELECT model, min(-score) AS l1, max(-score) AS h1, min(fp) AS l2, max(fp) AS h2 FROM w_res GROUP BY 1),
df AS (SELECT id, model, ((-score - l1) / (h1 - l1) + (fp - l2) / (h2 - l2)) / 2 AS d FROM w_res JOIN sp USING (model))"""


def difficulties(spark, sf):
    return standard.difficulty(views.res(spark, sf), ["id"], lower_better=["fp"], higher_better=["score"])


@query("b13_difficulty_filter", "SELECT id, round(avg(d), 6) AS difficulty FROM df GROUP BY 1 HAVING avg(d) > 0.750001", ctes=DIFF)
def b13(spark, sf):
    return difficulties(spark, sf).groupBy("id").agg(F.avg("difficulty").alias("difficulty")).where("difficulty > 0.750001").withColumn("difficulty", r6("difficulty"))


@query("b14_scope", "SELECT id, segment FROM w_dp")
def b14(spark, sf):
    return filters.scope(views.dp(spark, sf), ["id", "segment"])


@query("b15_derived_field", "SELECT id, round(abs(sa - 0.5) ** 2 + floor(price / 1000), 6) AS penalty FROM ab", ctes=AB)
def b15(spark, sf):
    df = both_models(spark, sf).select("id", F.struct("price").alias("datapoint"), F.col("resultA").alias("result"))
    return filters.derived(df, "penalty", "round(abs(@result.score - 0.5) ^ 2 + floor(@datapoint.price / 1000), 6)").select("id", "penalty")


@query("b16_custom_query_filter", "SELECT id FROM ab WHERE sa - sb > 0.25 AND ta <> tb", ctes=AB)
def b16(spark, sf):
    return filters.custom_filter(both_models(spark, sf), "@resultA.score - @resultB.score > 0.25 and not (@resultA.tp == @resultB.tp)").select("id")


@query("i16_custom_functions", "SELECT priority, count(*) AS n, round(sum(sqrt(price)), 2) AS root_sum FROM w_dp WHERE length(priority) - length(replace(priority, '-', '')) + 1 >= 2 GROUP BY 1")
def i16(spark, sf):
    df = views.dp(spark, sf).withColumn("words", F.split("priority", "-"))
    df = filters.custom_filter(df, "array_size(filter(@words, v -> v != '')) >= 2")
    return filters.derived(df, "root", "sqrt(@price)").groupBy("priority").agg(F.count("*").alias("n"), F.round(F.sum("root"), 2).alias("root_sum"))


@query("g01_sort_by_expression", "SELECT id, round(sa - sb, 6) AS gap FROM ab WHERE sb IS NOT NULL ORDER BY sa - sb DESC, id LIMIT 50", ctes=AB)
def g01(spark, sf):
    df = both_models(spark, sf).where("resultB IS NOT NULL")
    return filters.custom_sort(df, "@resultA.score - @resultB.score", True, "id").limit(50).selectExpr("id", "round(resultA.score - resultB.score, 6) AS gap")


@query("b18_split_thresholded", """SELECT 'bev' AS source, label, t.v AS threshold, count(*) FILTER (WHERE pred = gt AND score >= t.v) AS tp FROM (SELECT *, gt AS label FROM w_cls), (SELECT CAST(x AS DOUBLE) / 4 AS v FROM range(1, 4) r(x)) t GROUP BY 1, 2, 3""")
def b18(spark, sf):
    """Metric records nest objects of several kinds; the thresholded ones become long rows tagged with their column."""
    cuts = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    kind = lambda t: F.lit(t).alias("data_type")
    hits = F.transform(cuts, lambda t: F.struct(kind("METRICS/THRESHOLDED"), t.alias("threshold"), ((F.col("gt") == F.col("pred")) & (F.col("score") >= t)).cast("long").alias("tp")))
    other = F.array(F.struct(kind("METRICS/SCALAR"), F.lit(0.0).alias("threshold"), F.lit(1).cast("long").alias("tp")))
    records = views.cls(spark, sf).select(F.col("gt").alias("label"), F.concat(hits, other).alias("bev"))
    kept = records.select("label", F.explode(F.filter("bev", lambda x: x["data_type"] == "METRICS/THRESHOLDED")).alias("x"))
    return kept.groupBy(F.lit("bev").alias("source"), "label", F.col("x.threshold").alias("threshold")).agg(F.sum("x.tp").alias("tp"))


@query("b19_field_profile", """SELECT 'segment' AS field, count(DISTINCT segment) AS distinct_count, false AS has_null, CAST(NULL AS DOUBLE) AS lo, CAST(NULL AS DOUBLE) AS hi FROM w_dp UNION ALL
  SELECT 'priority', count(DISTINCT priority), false, NULL, NULL FROM w_dp UNION ALL SELECT 'discount', count(DISTINCT id % 7), true, 0, 6 FROM w_dp WHERE id % 3 <> 0
  UNION ALL SELECT 'price', count(DISTINCT price), false, min(price), max(price) FROM w_dp""")  # fmt: skip
def b19(spark, sf):
    df = views.dp(spark, sf).withColumn("discount", F.expr("CASE WHEN id % 3 <> 0 THEN id % 7 END"))
    return checks.field_profile(df, ["segment", "priority", "discount", "price"])


@query("b19_field_values", "SELECT 'segment' AS field, segment AS value, count(*) AS n FROM w_dp GROUP BY 2 UNION ALL SELECT 'priority', priority, count(*) FROM w_dp GROUP BY 2")
def b19b(spark, sf):
    return checks.field_values(views.dp(spark, sf), ["segment", "priority"])


@query("b20_shape_checks", """SELECT lang, count(*) FILTER (WHERE n_chars % 100 < n_chars % 130) AS segments, count(*) FILTER (WHERE len(w) >= 3) AS polygons,
  count(*) FILTER (WHERE len(w) = 1 + n_chars % 5) AS curves FROM (SELECT *, string_split(text, ' ') AS w FROM documents) GROUP BY 1""")  # fmt: skip
def b20(spark, sf):
    df = table(spark, sf, "documents").withColumn("w", F.split("text", " "))
    start, end = F.col("n_chars") % 100, F.col("n_chars") % 130
    return df.groupBy("lang").agg(
        F.count_if(checks.valid_text_segment(start, end)).alias("segments"), F.count_if(checks.valid_polygon(F.col("w"))).alias("polygons"),
        F.count_if(checks.valid_curve(F.col("w"), F.sequence(F.lit(0).cast("long"), F.col("n_chars") % 5))).alias("curves"),
    )


@query("b20_plot_faults", """WITH a AS (SELECT lang, doc_id, n_chars, [CASE WHEN doc_id % 4 = 0 THEN -i ELSE i END for i in range(n_chars % 6)] AS b, range(n_chars % 6 - CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END) AS f,
  range(n_chars % 4) AS l, [range(n_chars % 4 + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END) for i in range(n_chars % 4 + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END)] AS m FROM documents),
z AS (SELECT lang, 'histogram' AS kind, CASE WHEN len(b) < 2 THEN 'few' WHEN len(b) <> len(f) + 1 THEN 'sizes' WHEN doc_id % 4 = 0 THEN 'rising' END AS fault FROM a UNION ALL
  SELECT lang, 'matrix', CASE WHEN len(l) < 2 THEN 'few' WHEN len(m) <> len(l) THEN 'rows' WHEN len(m[1]) <> len(l) THEN 'columns' END FROM a)
SELECT lang, kind, coalesce(fault, 'none') AS fault, count(*) AS n FROM z GROUP BY 1, 2, 3""")  # fmt: skip
def b20_faults(spark, sf):
    """Histograms and matrices of every kind of fault, and without any, by language."""
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
    chars, doc = F.col("n_chars").cast("long"), F.col("doc_id")
    edges = F.transform(upto(chars % 6), lambda i: F.when(doc % 4 == 0, -i).otherwise(i))
    counts = upto(chars % 6 - F.when(doc % 3 == 0, 2).otherwise(1))
    side = chars % 4
    matrix = F.transform(upto(side + F.when(doc % 7 == 0, 1).otherwise(0)), lambda i: upto(side + F.when(doc % 5 == 0, 1).otherwise(0)))
    faults = F.array(F.struct(F.lit("histogram").alias("kind"), checks.histogram_fault(edges, counts).alias("fault")), F.struct(F.lit("matrix").alias("kind"), checks.matrix_fault(upto(side), matrix).alias("fault")))
    z = table(spark, sf, "documents").select("lang", F.explode(faults).alias("z"))
    return z.groupBy("lang", "z.kind", F.coalesce("z.fault", F.lit("none")).alias("fault")).agg(F.count("*").alias("n"))


@query("b21_repeated_names", """SELECT r_name AS scope, left(n_name, 1) AS name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2 HAVING count(*) > 1 UNION ALL
  SELECT 'test cases', trim(lower(segment)), count(DISTINCT priority) FROM w_dp GROUP BY 2 HAVING count(DISTINCT priority) > 1""")  # fmt: skip
def b21_names(spark, sf):
    """Metric labels that repeat within a group, and test-case names that repeat in a standard."""
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    metrics = n.select(F.col("r_name").alias("scope"), F.left("n_name", F.lit(1)).alias("name"))
    cases = views.dp(spark, sf).select("segment", "priority").distinct().select(F.lit("test cases").alias("scope"), F.trim(F.lower("segment")).alias("name"))
    return checks.repeated_names(metrics.unionByName(cases), ["scope"], "name")


@query("b21_standard_checks", "SELECT segment AS test_case, count(*) AS n FROM w_res JOIN w_dp USING (id) GROUP BY 1")
def b21(spark, sf):
    standard.check_standard(groups(), strata())
    return results(spark, sf).groupBy(F.col("segment").alias("test_case")).agg(F.count("*").alias("n"))


@query("c01_results_left_join", "SELECT segment, count(*) AS n, count(r.id) AS tested, round(sum(score), 4) AS score FROM w_dp LEFT JOIN (SELECT * FROM w_res WHERE model = 'b') r USING (id) GROUP BY 1")
def c01(spark, sf):
    b = views.res(spark, sf).where("model = 'b'").select("id", "score", F.lit(1).alias("hit"))
    j = joins.left_results(views.dp(spark, sf).select("id", "segment"), b, ["id"])
    return j.groupBy("segment").agg(F.count("*").alias("n"), F.count("hit").alias("tested"), F.round(F.sum("score"), 4).alias("score"))


@query("c02_prediction_truth_inner", "SELECT l_returnflag, count(*) AS n, round(sum(o_totalprice), 0) AS price FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def c02(spark, sf):
    o, li = table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    return o.join(li, F.expr("o_orderkey = l_orderkey")).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 0).alias("price"))


@query("c03_validated_left_join", "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)")
def c03(spark, sf):
    return joins.one_to_one(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"])


@query("c04_suffixed_join", "SELECT a.id, a.price AS price_inf, b.price AS price_gt FROM (SELECT * FROM w_ver WHERE version = 2) a JOIN (SELECT * FROM w_ver WHERE version = 1) b USING (id)")
def c04(spark, sf):
    return joins.suffixed(views.ver(spark, sf, 2), views.ver(spark, sf, 1), ["id"]).select("id", "price_inf", "price_gt")


@query("c05_tested_by_all", "SELECT model, count(*) AS n, round(avg(score), 6) AS score FROM w_res WHERE id IN (SELECT id FROM w_res GROUP BY 1 HAVING count(DISTINCT model) = 2) GROUP BY 1")
def c05(spark, sf):
    return standard.tested_by_all(views.res(spark, sf), ["id"]).groupBy("model").agg(F.count("*").alias("n"), r6(F.avg("score")).alias("score"))


@query("c06_without_inference", "SELECT id FROM w_dp WHERE id NOT IN (SELECT id FROM w_res WHERE model = 'b')")
def c06(spark, sf):
    return joins.without_inference(views.dp(spark, sf), views.res(spark, sf).where("model = 'b'"), ["id"]).select("id")


@query("c07_test_case_membership", """SELECT test_case, count(*) AS n, CAST(sum(tp) AS BIGINT) AS tp FROM w_res JOIN (SELECT id, segment AS test_case FROM w_dp UNION ALL SELECT id, 'all' FROM w_dp UNION ALL
  SELECT id, 'expensive' FROM w_dp WHERE price > 200000) m USING (id) WHERE model = 'a' GROUP BY 1""")  # fmt: skip
def c07(spark, sf):
    points = views.dp(spark, sf)
    cases = F.array_compact(F.array("segment", F.lit("all"), F.when(F.col("price") > 200000, "expensive")))
    members = points.select("id", F.explode(cases).alias("test_case"))
    a = views.res(spark, sf).where("model = 'a'").select("id", "tp")
    return joins.per_case(a, members, ["id"]).groupBy("test_case").agg(F.count("*").alias("n"), F.sum("tp").alias("tp"))


@query("c08_model_compare", "SELECT CASE WHEN sb < sa THEN 'regressed' WHEN sb > sa THEN 'improved' ELSE 'same' END AS verdict, count(*) AS n FROM ab WHERE sb IS NOT NULL GROUP BY 1", ctes=AB)
def c08(spark, sf):
    verdict = F.when(F.col("b") < F.col("a"), "regressed").when(F.col("b") > F.col("a"), "improved").otherwise("same")
    return joins.by_model(views.res(spark, sf), ["id"], "score", "a", "b").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query("c14_align_by_id", "SELECT id, segment, score FROM w_dp JOIN w_res USING (id) WHERE model = 'a'")
def c14(spark, sf):
    a = views.res(spark, sf).where("model = 'a'").select("id", "score")
    return views.dp(spark, sf).select("id", "segment").join(a, "id")


def groups():
    """Two metric groups; columns need a running session, so they are built on use."""
    return [
        standard.MetricGroup("quality", [
            standard.Metric("mean_score", F.avg("score"), True),
            standard.Metric("f1", f1_score(F.sum("tp"), F.sum("fp"), F.sum("fn")), True),
        ]),
        standard.MetricGroup("errors", [
            standard.Metric("false_positives", F.sum("fp"), False),
            standard.Metric("precision", precision(F.sum("tp"), F.sum("fp"))),
            standard.Metric("recall", recall(F.sum("tp"), F.sum("fn"))),
        ]),
    ]


def strata():
    return [standard.Stratification("by_segment", F.col("segment")), standard.Stratification("by_priority", F.col("priority"))]


def results(spark, sf):
    return views.res(spark, sf).join(views.dp(spark, sf), "id")


def standard_table(spark, sf):
    """The long result is small; it is written once because deltas and ranks read it twice."""
    return materialize(standard.evaluate(standard.tested_by_all(results(spark, sf), ["id"]), groups(), strata()), "standard")


F1SQL = "2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn))"
STD = f"""common AS (SELECT id FROM w_res GROUP BY 1 HAVING count(DISTINCT model) = 2),
rr AS (SELECT * FROM w_res JOIN w_dp USING (id) JOIN common USING (id)),
st AS (SELECT model, eval_config, 'Dataset' AS stratification, 'Dataset' AS test_case, count(*) AS n, avg(score) AS mean_score, {F1SQL} AS f1, CAST(sum(fp) AS DOUBLE) AS false_positives,
   sum(tp) / (sum(tp) + sum(fp)) AS precision, sum(tp) / (sum(tp) + sum(fn)) AS recall FROM rr GROUP BY 1, 2
 UNION ALL SELECT model, eval_config, 'by_segment', segment, count(*), avg(score), {F1SQL}, sum(fp), sum(tp) / (sum(tp) + sum(fp)), sum(tp) / (sum(tp) + sum(fn)) FROM rr GROUP BY 1, 2, 4
 UNION ALL SELECT model, eval_config, 'by_priority', priority, count(*), avg(score), {F1SQL}, sum(fp), sum(tp) / (sum(tp) + sum(fp)), sum(tp) / (sum(tp) + sum(fn)) FROM rr GROUP BY 1, 2, 4),
lg AS (SELECT model, eval_config, stratification, test_case, n, CASE WHEN metric IN ('mean_score', 'f1') THEN 'quality' ELSE 'errors' END AS metric_group, metric, value
  FROM (UNPIVOT st ON mean_score, f1, false_positives, precision, recall INTO NAME metric VALUE value))"""


@query("e29_test_case_table", "SELECT model, stratification, test_case, n, round(mean_score, 6) AS mean_score, round(f1, 6) AS f1 FROM st", ctes=STD)
def e29(spark, sf):
    t = standard.evaluate(standard.tested_by_all(results(spark, sf), ["id"]), groups()[:1], strata())
    wide = t.groupBy("model", "stratification", "test_case", "n").pivot("metric", ["mean_score", "f1"]).agg(F.first("value"))
    return wide.select("model", "stratification", "test_case", "n", r6("mean_score").alias("mean_score"), r6("f1").alias("f1"))


@query("e30_standard_long", "SELECT model, eval_config, stratification, test_case, n, metric_group, metric, round(value, 6) AS value FROM lg", ctes=STD)
def e30(spark, sf):
    return standard_table(spark, sf).withColumn("value", r6("value"))


@query("e30_standard_pivot", """SELECT stratification, test_case, round(max(f1) FILTER (WHERE model = 'a'), 6) AS a_quality_f1, round(max(f1) FILTER (WHERE model = 'b'), 6) AS b_quality_f1 FROM st GROUP BY 1, 2""", ctes=STD)
def e30b(spark, sf):
    wide = standard.pivoted(standard_table(spark, sf), ["a.quality.f1", "b.quality.f1"])
    return wide.select("stratification", "test_case", r6(F.col("`a.quality.f1`")).alias("a_quality_f1"), r6(F.col("`b.quality.f1`")).alias("b_quality_f1"))


Z95 = f"{standard.z_score(0.95)!r}e0"


@query("e31_margin_of_error", f"SELECT stratification, test_case, model, round(100 * {Z95} * 0.5 / sqrt(n), 6) AS margin FROM st", ctes=STD)
def e31(spark, sf):
    rows = standard_table(spark, sf).where("metric = 'f1'")
    return rows.select("stratification", "test_case", "model", r6(standard.margin_of_error(F.col("n"))).alias("margin"))


DELTA = f""", ref AS (SELECT *, max(value) OVER (PARTITION BY stratification, metric) AS mx FROM lg WHERE model = 'a'),
dl AS (SELECT lg.*, CASE WHEN metric_group = 'quality' THEN 1 WHEN lg.metric = 'false_positives' THEN -1 END AS sgn, ref.value AS rv, CASE WHEN mx <> 0 THEN mx ELSE greatest(lg.value, ref.value) END AS lim
  FROM lg JOIN ref USING (stratification, test_case, metric_group, metric)),
dp AS (SELECT *, sgn * 100 * (value - rv) / CASE WHEN lim > 0 THEN CASE WHEN pow(10, ceil(log10(lim))) >= 1000 THEN lim ELSE pow(10, ceil(log10(lim))) END ELSE value + 2.220446049250313e-16 END AS d, 100 * {Z95} * 0.5 / sqrt(n) AS moe FROM dl)"""


@query("e32_performance_delta", """SELECT model, stratification, test_case, metric, round(value, 6) AS value, CASE WHEN sgn IS NULL THEN 'unknown' WHEN d > moe THEN 'improved' WHEN d < -moe THEN 'regressed' ELSE 'similar' END AS performance_delta FROM dp""", ctes=STD + DELTA)
def e32(spark, sf):
    rows = standard.compare(standard_table(spark, sf), groups(), "a", None, 0.95)
    return rows.select("model", "stratification", "test_case", "metric", r6("value").alias("value"), "performance_delta")


@query("e33_commit_accounting", """SELECT count(*) FILTER (WHERE o.id IS NULL OR n.id IS NOT NULL AND (o.price <> n.price OR o.segment <> n.segment)) AS n_added,
  count(*) FILTER (WHERE n.id IS NULL OR o.id IS NOT NULL AND (o.price <> n.price OR o.segment <> n.segment)) AS n_removed FROM (SELECT * FROM w_ver WHERE version = 1) o FULL JOIN (SELECT * FROM w_ver WHERE version = 2) n USING (id)""")  # fmt: skip
def e33(spark, sf):
    from sparkeval.sources.datasets import change_counts

    return change_counts(views.ver(spark, sf, 1), views.ver(spark, sf, 2), ["id"])


@query("e34_difficulty_score", "SELECT id, round(avg(d), 6) AS difficulty, round(max(d) FILTER (WHERE model = 'b') - max(d) FILTER (WHERE model = 'a'), 6) AS delta FROM df GROUP BY 1", ctes=DIFF)
def e34(spark, sf):
    pick = lambda m: F.max(F.when(F.col("model") == m, F.col("difficulty")))
    return difficulties(spark, sf).groupBy("id").agg(r6(F.avg("difficulty")).alias("difficulty"), r6(pick("b") - pick("a")).alias("delta"))


LEAD = """, lz AS (SELECT model, CASE WHEN metric = 'false_positives' THEN -1 ELSE 1 END * coalesce((value - avg(value) OVER w) / nullif((max(value) OVER w - min(value) OVER w) / 4, 0), 0) AS z FROM lg
  WHERE stratification = 'Dataset' AND metric IN ('mean_score', 'f1', 'false_positives') WINDOW w AS (PARTITION BY metric))"""


@query("e35_leaderboard", "SELECT model, round(avg(z), 6) AS score, rank() OVER (ORDER BY avg(z) DESC) AS rank FROM lz GROUP BY 1", ctes=STD + LEAD)
def e35(spark, sf):
    board = standard.leaderboard(standard_table(spark, sf), groups())
    return board.select("model", r6("score").alias("score"), F.col("rank").cast("long").alias("rank"))


@query("f09_model_rank", "SELECT model, rank() OVER (ORDER BY mean_score DESC) AS rank FROM st WHERE stratification = 'Dataset'", ctes=STD)
def f09(spark, sf):
    rows = standard_table(spark, sf).where("stratification = 'Dataset' AND metric = 'mean_score'")
    return rows.select("model", F.rank().over(W.orderBy(F.col("value").desc())).cast("long").alias("rank"))


@query("f02_top_class_margin", """SELECT order_id, line, top, round(s1 - s2, 6) AS margin, CASE WHEN s1 >= 0.4 THEN top END AS prediction FROM (SELECT l_orderkey AS order_id, l_linenumber AS line,
  l_discount AS a, l_tax AS n, l_quantity / 100 AS r, list_sort([{'s': l_discount, 'l': 'A'}, {'s': l_tax, 'l': 'N'}, {'s': l_quantity / 100, 'l': 'R'}], 'DESC') AS o, o[1].l AS top, o[1].s AS s1, o[2].s AS s2 FROM lineitem)""")  # fmt: skip
def f02(spark, sf):
    scored = F.array(*[F.struct(c.cast("double").alias("s"), F.lit(n).alias("l")) for n, c in
                       (("A", F.col("l_discount")), ("N", F.col("l_tax")), ("R", F.col("l_quantity") / 100))])
    best = F.sort_array(scored, asc=False)
    df = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), best.alias("o"))
    s1, s2, top = F.col("o")[0]["s"], F.col("o")[1]["s"], F.col("o")[0]["l"]
    return df.select("order_id", "line", top.alias("top"), r6(s1 - s2).alias("margin"), F.when(s1 >= 0.4, top).alias("prediction"))


@query("f08_keep_first", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM w_line")
def f08(spark, sf):
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus"]
    return joins.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("f04_cumulative_counts", "SELECT score, CAST(sum(sum(CASE WHEN gt = pred THEN 1 ELSE 0 END)) OVER w AS BIGINT) AS tp, CAST(sum(sum(CASE WHEN gt <> pred THEN 1 ELSE 0 END)) OVER w AS BIGINT) AS fp FROM w_cls GROUP BY score WINDOW w AS (ORDER BY score DESC)")
def f04(spark, sf):
    from sparkeval.operators import curves
    from sparkeval.operators.running import running

    counts = curves.score_counts(views.cls(spark, sf), [], F.col("gt") == F.col("pred"), F.col("score"))
    return running(counts, [], "score", {"tp": F.col("pos"), "fp": F.col("neg")}).select("score", "tp", "fp")


@query("g02_page", "SELECT id, price FROM w_dp ORDER BY price DESC, id LIMIT 50 OFFSET 100")
def g02(spark, sf):
    return filters.page(views.dp(spark, sf), [F.col("price").desc(), F.col("id")], 100, 50).select("id", "price")


@query("g05_first_n", "SELECT id, segment FROM w_dp ORDER BY id LIMIT 25")
def g05(spark, sf):
    return views.dp(spark, sf).orderBy("id").limit(25).select("id", "segment")


@query("h01_union_by_name", "SELECT id, price, score FROM (SELECT id, price, NULL AS score FROM w_ver WHERE version = 3 UNION ALL SELECT id, NULL, score FROM w_res WHERE model = 'b')")
def h01(spark, sf):
    b = views.res(spark, sf).where("model = 'b'").select("id", "score")
    return views.ver(spark, sf, 3).select("id", "price").unionByName(b, allowMissingColumns=True)


@query("h02_version_diff", """SELECT CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.price <> n.price THEN 'changed' ELSE 'unchanged' END AS change, count(*) AS n
  FROM (SELECT * FROM w_ver WHERE version = 1) o FULL JOIN (SELECT * FROM w_ver WHERE version = 2) n USING (id) GROUP BY 1""")  # fmt: skip
def h02(spark, sf):
    from sparkeval.sources.datasets import diff

    return diff(views.ver(spark, sf, 1), views.ver(spark, sf, 2), ["id"]).groupBy("change").agg(F.count("*").alias("n"))


@query("h03_label_union", "SELECT DISTINCT label FROM (SELECT label FROM w_det_gt UNION SELECT label FROM w_det_inf)")
def h03(spark, sf):
    return views.det_gt(spark, sf).select("label").union(views.det_inf(spark, sf).select("label")).distinct()
