"""Queries on readers, writers, versioned datasets, streams and user-defined evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkeval import evaluator
from sparkeval.functions.ratios import r6
from sparkeval.operators import curves, suites
from sparkeval.plans import detection as det
from sparkeval.plans import views
from sparkeval.plans.detection import AP, CASE, CLASS, IOU, SCORES, THRESH
from sparkeval.plans.registry import query
from sparkeval.session import new_path, shared, table
from sparkeval.sources import files
from sparkeval.sources.datasets import Datasets
from sparkeval.streaming import ingest

MIXED = """CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'NaN' WHEN 2 THEN 'True' WHEN 3 THEN '3e2' WHEN 4 THEN '"quoted"' WHEN 5 THEN '[1, 2]' WHEN 6 THEN '-1.5' ELSE '{broken' END"""


@query("a01_csv_cell_recovery", """SELECT CASE event_id % 8 WHEN 0 THEN 'null' WHEN 1 THEN 'null' WHEN 2 THEN 'boolean' WHEN 5 THEN 'json' WHEN 6 THEN 'number' ELSE 'text' END AS kind,
  CASE event_id % 8 WHEN 3 THEN '3e2' WHEN 4 THEN 'quoted' WHEN 7 THEN '{broken' END AS value, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")  # fmt: skip
def a01(spark, sf):
    path = new_path(spark, "cells")
    files.write_csv(table(spark, sf, "events").selectExpr("event_id", "value", f"{MIXED} AS cell"), path)
    raw = spark.read.options(**files._CSV).csv(path)
    kind = files.cell_kind(F.col("cell"))
    typed = files.recovered(raw.select("event_id", "value", kind.alias("kind"), F.when(kind == "text", files.cell_text(F.col("cell"))).alias("shown")), ["event_id", "value"])
    return typed.groupBy("kind", F.col("shown").alias("value")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 2).alias("total"))


@query("a02_csv_round_trip", "SELECT event_id, event_type, value, CAST(props::JSON->>'k' AS BIGINT) AS k FROM events")
def a02(spark, sf):
    path = new_path(spark, "csv")
    df = table(spark, sf, "events").select("event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
    files.write_csv(df, path)
    back = files.read_csv(spark, path)
    return back.select("event_id", "event_type", "value", F.try_variant_get("props", "$.k", "bigint").alias("k"))


@query("a03_parquet_decode", "SELECT event_type, count(*) AS n, CAST(sum(CAST(props::JSON->>'k' AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def a03(spark, sf):
    typed = files.read_parquet(spark, f"{sf}/events.parquet")
    return typed.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.try_variant_get("props", "$.k", "bigint")).alias("k"))


@query("a04_parquet_encoded", "SELECT vec_id, label, len(embedding) AS size FROM embeddings")
def a04(spark, sf):
    path = new_path(spark, "encoded")
    files.write_parquet(table(spark, sf, "embeddings"), path)
    back = spark.read.parquet(path)
    return back.select("vec_id", "label", F.size(F.from_json("embedding", "array<double>")).cast("long").alias("size"))


@query("a05_json_documents", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def a05(spark, sf):
    """Each file holds one JSON array of at most about a thousand records."""
    path = new_path(spark, "json")
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    parts = max(1, -(-e.count() // 1000))
    arrays = e.groupBy(F.pmod(F.xxhash64("event_id"), F.lit(parts)).alias("p")).agg(F.to_json(F.collect_list(F.struct("event_id", "user_id", "value"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    back = files.read_json(spark, path, "event_id bigint, user_id bigint, value double")
    return back.groupBy("user_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("a06_json_lines", "SELECT doc_id, lang, n_chars FROM documents")
def a06(spark, sf):
    path = new_path(spark, "lines")
    table(spark, sf, "documents").select("doc_id", F.struct("lang", "n_chars").alias("meta")).write.json(path)
    return files.read_json_lines(spark, path, "doc_id bigint, meta struct<lang: string, n_chars: bigint>").select("doc_id", "meta.lang", "meta.n_chars")


@query("a07_rows_to_objects", """SELECT id, '{"id":' || id || ',"priority":"' || priority || '","segment":"' || segment || '"}' AS datapoint, '{"id":' || id || '}' AS datapoint_id_object FROM w_dp""")
def a07(spark, sf):
    return views.dp(spark, sf).select("id", files.as_object(["segment", "priority", "id"]).alias("datapoint"), files.as_object(["id"]).alias("datapoint_id_object"))


@query("a08_objects_to_columns", "SELECT event_id, CAST(props::JSON->>'k' AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN event_type END AS type, user_id AS \"who.user\" FROM events")
def a08(spark, sf):
    kind = F.when(F.col("event_id") % 2 == 0, F.col("event_type"))
    obj = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"), kind.alias("type"), F.struct(F.col("user_id").alias("user")).alias("who"), F.lit("DATAPOINT/TABULAR").alias("data_type")))
    return files.from_objects(table(spark, sf, "events").select("event_id", obj.alias("datapoint")), "datapoint", flatten=True)


# -- versioned datasets -------------------------------------------------------------
def versions(spark, sf):
    """A dataset with three versions (replace, upsert, replace), built once per application."""
    if (spark.sparkContext.applicationId, sf) not in _STORES:
        store = Datasets(spark, new_path(spark, "store"))
        store.upload("points", views.ver(spark, sf, 1), ["id"], tags=["first"])
        store.upload("points", views.ver(spark, sf, 2), ["id"], append_only=True)
        store.upload("points", views.ver(spark, sf, 3), ["id"])
        store.upload("labels", table(spark, sf, "labels"), ["doc_id"])
        _STORES[spark.sparkContext.applicationId, sf] = store
    return _STORES[spark.sparkContext.applicationId, sf]


_STORES: dict[tuple[str, str], Datasets] = {}


@query("a09_replace_dataset", "SELECT id, segment, price, 'DATAPOINT/TABULAR' AS data_type FROM w_ver WHERE version = 3")
def a09(spark, sf):
    return versions(spark, sf).download("points")


UPSERTED = "SELECT id, segment, price FROM w_ver WHERE version = 2 UNION ALL SELECT id, segment, price FROM w_ver WHERE version = 1 AND id NOT IN (SELECT id FROM w_ver WHERE version = 2)"


@query("a10_upsert_dataset", UPSERTED)
def a10(spark, sf):
    return versions(spark, sf).download("points", 2).drop("data_type")


@query("a11_time_travel", "SELECT id, segment, price FROM w_ver WHERE version = 1")
def a11(spark, sf):
    return versions(spark, sf).download("points", 1).drop("data_type")


@query("a12_list_datasets", "SELECT 'points' AS dataset, 3 AS n_commits, count(*) AS n_datapoints FROM w_ver WHERE version = 3 UNION ALL SELECT 'labels', 1, count(*) FROM labels")
def a12(spark, sf):
    """Every dataset with its size, which the added and removed rows of its commits make up."""
    return versions(spark, sf).list_datasets()


COMMITS = f"""v2 AS ({UPSERTED}),
n AS (SELECT 1 AS commit, (SELECT count(*) FROM w_ver WHERE version = 1) AS n_added, 0 AS n_removed UNION ALL
SELECT 2, (SELECT count(*) FROM (SELECT * FROM v2 EXCEPT SELECT id, segment, price FROM w_ver WHERE version = 1)), (SELECT count(*) FROM (SELECT id, segment, price FROM w_ver WHERE version = 1 EXCEPT SELECT * FROM v2)) UNION ALL
SELECT 3, (SELECT count(*) FROM (SELECT id, segment, price FROM w_ver WHERE version = 3 EXCEPT SELECT * FROM v2)), (SELECT count(*) FROM (SELECT * FROM v2 EXCEPT SELECT id, segment, price FROM w_ver WHERE version = 3)))"""


@query("a13_commit_history", "SELECT commit, n_added, n_removed FROM n ORDER BY commit DESC LIMIT 2 OFFSET 1", ctes=COMMITS)
def a13(spark, sf):
    return versions(spark, sf).history("points", descending=True, limit=2, offset=1).select("commit", "n_added", "n_removed")


def with_results(spark, sf):
    """Results of two models on the latest version; ids unknown to it are dropped, a second upload updates."""
    store = versions(spark, sf)
    if (spark.sparkContext.applicationId, sf) not in _RESULTS:
        res = views.res(spark, sf)
        a = res.where("model = 'a'").select("id", "score", "tp")
        b = res.where("model = 'b'").select("id", "score", "tp")
        store.upload_results("points", "a", a, tags=["base"])
        store.upload_results("points", "b", b.where("id % 2 = 0"), '{"threshold": 0.5}', tags=["new", "best"])
        store.upload_results("points", "b", b, '{"threshold": 0.5}', tags=["new", "best"])
        _RESULTS.add((spark.sparkContext.applicationId, sf))
    return store


_RESULTS: set[tuple[str, str]] = set()
V3 = "v3 AS (SELECT id FROM w_ver WHERE version = 3), ok AS (SELECT * FROM w_res WHERE id IN (SELECT id FROM v3))"


@query("a14_upload_results", """SELECT 'a' AS model, 1 AS version, count(*) AS n_inserted, 0 AS n_updated FROM ok WHERE model = 'a' UNION ALL SELECT 'b', 1, count(*), 0 FROM ok WHERE model = 'b' AND id % 2 = 0 UNION ALL
  SELECT 'b', 2, count(*) FILTER (WHERE id % 2 = 1), count(*) FILTER (WHERE id % 2 = 0) FROM ok WHERE model = 'b'""", ctes=V3)  # fmt: skip
def a14(spark, sf):
    """What the store wrote down for every upload."""
    return with_results(spark, sf).uploads("points").drop("eval_config")


@query("a15_download_results", "SELECT p.id, p.segment, p.price, r.score, r.tp FROM (SELECT * FROM w_ver WHERE version = 3) p LEFT JOIN (SELECT * FROM w_res WHERE model = 'b') r USING (id)")
def a15(spark, sf):
    return with_results(spark, sf).download_results("points", "b")['{"threshold": 0.5}'].drop("data_type")


@query("a16_results_by_tag", "SELECT segment, count(*) AS n, round(sum(score), 4) AS score FROM (SELECT * FROM w_ver WHERE version = 3) LEFT JOIN (SELECT * FROM w_res WHERE model = 'b') r USING (id) GROUP BY 1")
def a16(spark, sf):
    found = with_results(spark, sf).download_results_by_tag("points", "best")
    return found['{"threshold": 0.5}'].groupBy("segment").agg(F.count("*").alias("n"), F.round(F.sum("score"), 4).alias("score"))


@query("a17_models_by_tags", "SELECT DISTINCT model FROM ok WHERE model = 'b'", ctes=V3)
def a17(spark, sf):
    return with_results(spark, sf).models("points", ["new", "best"]).select("model")


@query("a18_sized_chunks", "SELECT count(*) AS documents, count(DISTINCT doc_id) AS ids, sum(n_chars)::BIGINT AS chars, true AS several, true AS within_rows, true AS within_bytes FROM documents")
def a18_sized(spark, sf):
    """Documents in files of a size measured on a sample: how many rows arrive, and whether any file holds too much."""
    docs, path, limit = table(spark, sf, "documents"), new_path(spark, "sized"), 100_000
    each = files.write_chunks(docs, path, chunk_bytes=limit, single_bytes=limit, rows=100)
    back = spark.read.parquet(f"{path}/chunks").select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    per_file = back.groupBy("file").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"), F.count_distinct("doc_id").alias("ids"), F.sum("n_chars").alias("chars"))
    # Documents differ in length, so a file may pass the aim, but not by much.
    return per_file.agg(
        F.sum("n").alias("documents"), F.sum("ids").alias("ids"), F.sum("chars").alias("chars"), (F.count("*") > 1).alias("several"),
        (F.max("n") <= each).alias("within_rows"), (F.max("bytes") <= 3 * limit).alias("within_bytes"),
    )


@query("a18_chunked_ingest", "SELECT doc_id, quality, toxic FROM labels")
def a18(spark, sf):
    """Chunks upserted one after the other give the same dataset as one upload."""
    store = Datasets(spark, new_path(spark, "chunks"))
    df = table(spark, sf, "labels")
    for k in range(3):
        store.upload("labels", df.where(F.col("doc_id") % 3 == k), ["doc_id"], append_only=True)
    return store.download("labels").drop("data_type")


@query("a19_coco_rows", """SELECT 'img/' || image_id AS locator, count(*) AS boxes, round(sum(x1), 3) AS x1, round(sum(x2), 3) AS x2, count(*) FILTER (WHERE label = 'A') AS n_a FROM w_det_gt GROUP BY 1""")
def a19(spark, sf):
    g = views.det_gt(spark, sf)
    category = F.when(F.col("label") == "A", 1).when(F.col("label") == "N", 2).otherwise(3)
    annotations = g.select("image_id", category.alias("category_id"), F.array("x1", "y1", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")).alias("bbox"))
    images = g.select(F.col("image_id").alias("id"), F.concat(F.lit("img/"), "image_id").alias("locator")).distinct()
    categories = g.select(category.alias("id"), F.col("label").alias("name")).distinct()
    rows = files.coco_rows(images, annotations, categories)
    add = lambda c: F.round(F.aggregate("boxes", F.lit(0.0), lambda acc, b: acc + b[c]), 3)
    hits = F.size(F.filter("boxes", lambda b: b["label"] == "A")).cast("long")
    return rows.select("locator", F.size("boxes").cast("long").alias("boxes"), add("x1").alias("x1"), add("x2").alias("x2"), hits.alias("n_a"))


@query("a20_nested_boxes", "SELECT image_id, count(*) AS boxes, max(stratum) AS stratum, max(y2) AS y2 FROM w_det_gt GROUP BY 1")
def a20(spark, sf):
    rows = files.nested_boxes(views.det_gt(spark, sf), "image_id", ["stratum"], ["label", "x1", "y1", "x2", "y2"])
    top = F.array_max(F.transform("boxes", lambda b: b["y2"]))
    return rows.select("image_id", F.size("boxes").cast("long").alias("boxes"), "stratum", top.alias("y2"))


@query("a21_embedding_sink", "SELECT vec_id, 'clip' AS key, len(embedding) AS size, round(embedding[1]::DOUBLE, 6) AS first FROM embeddings")
def a21(spark, sf):
    path = new_path(spark, "embeddings")
    files.write_embeddings(table(spark, sf, "embeddings"), path, "clip", ["vec_id"])
    back = spark.read.parquet(path)
    return back.select("vec_id", "key", F.size("embedding").cast("long").alias("size"), r6(F.col("embedding")[0]).alias("first"))


@query("a22_extracted_properties", "SELECT doc_id, quality, n_chars FROM labels JOIN documents USING (doc_id)")
def a22(spark, sf):
    properties = table(spark, sf, "documents").select("doc_id", "n_chars")
    return versions(spark, sf).download("labels", properties=properties).select("doc_id", "quality", "n_chars")


# -- test suites --------------------------------------------------------------------
@query("h04_suite_edits", """SELECT user_id AS test_case, event_id % 50 AS sample, arg_max(value, event_id) AS truth FROM events GROUP BY 1, 2 HAVING arg_max(event_type, event_id) <> 'error'""")
def h04(spark, sf):
    action = F.when(F.col("event_type") == "error", "remove").otherwise("add")
    e = table(spark, sf, "events").select(F.col("user_id").alias("test_case"), (F.col("event_id") % 50).alias("sample"), F.col("value").alias("truth"), action.alias("action"), "event_id")
    return suites.after_edits(e, ["test_case", "sample"], "event_id").select("test_case", "sample", "truth")


LOG = """lg AS (SELECT user_id % 7 AS suite, CASE WHEN a = 'reset' THEN NULL ELSE user_id END AS test_case, CASE WHEN a IN ('reset', 'replace', 'drop') THEN NULL ELSE event_id % 50 END AS sample, a AS action, value AS truth, event_id AS n
  FROM (SELECT *, CASE WHEN event_id % 397 = 0 THEN 'reset' WHEN event_type = 'purchase' AND event_id % 13 = 0 THEN 'replace' WHEN event_type = 'view' AND event_id % 41 = 0 THEN 'drop' WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS a FROM events)),
ls AS (SELECT suite, test_case, sample, arg_max(truth, n) AS truth, arg_max(action, n) AS action FROM lg e WHERE action IN ('add', 'remove')
  AND n > coalesce((SELECT max(n) FROM lg r WHERE r.suite = e.suite AND r.action = 'reset'), -1) AND n > coalesce((SELECT max(n) FROM lg r WHERE r.suite = e.suite AND r.test_case = e.test_case AND r.action IN ('replace', 'drop')), -1) GROUP BY 1, 2, 3)"""


@query("h04_suite_replay", "SELECT suite, test_case, sample, truth FROM ls WHERE action = 'add'", ctes=LOG)
def h04_replay(spark, sf):
    """Suites after a log with resets, cases replaced by name, cases taken out, and edits of single samples."""
    n = F.col("event_id")
    kind = F.col("event_type")
    action = F.when(n % 397 == 0, "reset").when((kind == "purchase") & (n % 13 == 0), "replace").when((kind == "view") & (n % 41 == 0), "drop").when(kind == "error", "remove").otherwise("add")
    e = table(spark, sf, "events").withColumn("action", action)
    whole = F.col("action").isin("reset", "replace", "drop")
    e = e.select(
        (F.col("user_id") % 7).alias("suite"), F.when(F.col("action") != "reset", F.col("user_id")).alias("test_case"), F.when(~whole, n % 50).alias("sample"),
        "action", F.col("value").alias("truth"), n.alias("n"),
    )
    return suites.replayed(e, "suite", "test_case", "sample", "n").select("suite", "test_case", "sample", "truth")


@query("h05_bulk_cases", """SELECT segment AS test_case, count(*) AS n FROM w_dp WHERE segment <> 'BUILDING' GROUP BY 1 UNION ALL SELECT 'BUILDING', count(*) FROM w_dp WHERE segment = 'BUILDING' AND price > 100000 UNION ALL SELECT 'rich', count(*) FROM w_dp WHERE price > 300000""")
def h05(spark, sf):
    points = views.dp(spark, sf)
    current = points.select(F.col("segment").alias("test_case"), F.col("id").alias("sample"))
    new = points.where("segment = 'BUILDING' AND price > 100000").select(F.lit("BUILDING").alias("test_case"), F.col("id").alias("sample"))
    new = new.unionByName(points.where("price > 300000").select(F.lit("rich").alias("test_case"), F.col("id").alias("sample")))
    return suites.bulk_cases(current, new).groupBy("test_case").agg(F.count("*").alias("n"))


STD = "sd AS (SELECT r_name AS dataset, CASE WHEN n_nationkey % 2 = 0 THEN 'metric_groups' ELSE 'test_cases' END AS part, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query("h06_copy_standard", "SELECT * FROM sd WHERE NOT (dataset = 'EUROPE' AND part = 'metric_groups') UNION ALL SELECT 'EUROPE', part, name FROM sd WHERE dataset = 'ASIA' AND part = 'metric_groups'", ctes=STD)
def h06(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.expr("n_regionkey = r_regionkey"))
    part = F.when(F.col("n_nationkey") % 2 == 0, "metric_groups").otherwise("test_cases")
    return suites.copy_standard(n.select(F.col("r_name").alias("dataset"), part.alias("part"), F.col("n_name").alias("name")), "ASIA", "EUROPE", ["metric_groups"])


# -- streams ------------------------------------------------------------------------
def utc_events(spark, sf):
    """Events with their zone-less times read as UTC, which watermarks need."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def event_files(spark, sf):
    """The events as written files, one batch of the stream each."""
    key = f"{sf}/event_files"
    return shared(spark, key, lambda: utc_events(spark, sf))


def event_stream(spark, sf):
    stored = event_files(spark, sf)
    folder = stored.inputFiles()[0].rsplit("/", 1)[0]
    return ingest.stream_of(spark, folder, stored.schema, files_per_trigger=1)


@query("j01_stream_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def j01(spark, sf):
    store = Datasets(spark, new_path(spark, "stream-store"))
    ingest.ingest(event_stream(spark, sf).select("event_id", "user_id", "event_type", "value"), store, "events", ["event_id"])
    return store.download("events").drop("data_type")


def calls(stream):
    return stream.withColumnsRenamed({"ts": "start", "event_type": "model_name"}).withColumn("end", F.expr("timestampadd(MICROSECOND, CAST(value * 1000000 AS BIGINT), start)"))


@query("j02_trace_split", "SELECT event_type AS model_name, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def j02(spark, sf):
    path = new_path(spark, "trace")
    ingest.trace(calls(event_stream(spark, sf)), path, ["event_id"], ["user_id"], ["value"])
    points, results = (spark.read.parquet(f"{path}/{n}").drop("batch") for n in ("datapoints", "results"))
    return results.join(points, "event_id").groupBy("model_name").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("j03_first_call_wins", "SELECT event_id, user_id, value FROM events")
def j03(spark, sf):
    """Every event arrives twice; one call per id is kept."""
    s = calls(event_stream(spark, sf)).select("event_id", "start", "user_id", "value")
    twice = s.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(2)))).drop("_copy")
    return ingest.first_calls(twice, ["event_id"], new_path(spark, "first-calls")).select("event_id", "user_id", "value")


@query("j04_call_elapsed", "SELECT event_id, round(floor(round(value * 1000000, 3)) / 1000000, 6) AS elapsed_s, epoch_us(ts) AS start_us FROM events")
def j04(spark, sf):
    c = calls(utc_events(spark, sf)).withColumn("end", F.timestamp_micros(F.unix_micros("start") + F.round(F.col("value") * 1000000).cast("bigint")))
    return ingest.with_elapsed(c).select("event_id", r6("elapsed_s").alias("elapsed_s"), F.unix_micros("start").alias("start_us"))


LIVE = """SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS window_us, event_type AS stratum, CAST(sum(event_id % 3) AS BIGINT) AS tp, CAST(sum(event_id % 2) AS BIGINT) AS fp, CAST(sum(event_id % 5) AS BIGINT) AS fn, count(*) AS n,
  round(sum(event_id % 3) / nullif(sum(event_id % 3) + sum(event_id % 2), 0), 6) AS precision, round(sum(event_id % 3) / nullif(sum(event_id % 3) + sum(event_id % 5), 0), 6) AS recall FROM events GROUP BY 1, 2"""


@query("j05_live_metrics", LIVE)
def j05(spark, sf):
    s = event_stream(spark, sf).selectExpr("ts", "event_type AS stratum", "event_id % 3 AS tp", "event_id % 2 AS fp", "event_id % 5 AS fn")
    rates = ingest.live_rates(ingest.live_counts(s, "ts", ["stratum"], new_path(spark, "live")))
    return rates.select(F.unix_micros("window_start").alias("window_us"), "stratum", "tp", "fp", "fn", "n", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("j06_progress_per_case", "SELECT event_type AS test_case, count(*) AS samples, CAST(sum(event_id % 3) AS BIGINT) AS tp FROM events GROUP BY 1")
def j06(spark, sf):
    """Samples evaluated so far, per test case, whatever the number of cases."""
    s = event_stream(spark, sf).selectExpr("event_type AS test_case", "event_id % 3 AS tp")
    return ingest.running_totals(s, ["test_case"], {"samples": F.count("*"), "tp": F.sum("tp")}, new_path(spark, "progress"))


# -- user-defined evaluation --------------------------------------------------------
class AbsoluteError(evaluator.Evaluator):
    """Sample errors, their mean per case and a failure rate per configured limit."""

    configurations = (1000.0, 5000.0)

    def sample_metrics(self, samples, configuration):
        err = F.abs(F.col("pred") - F.col("gt"))
        return samples.select("order_id", "line", "stratum", err.alias("err"), (err > configuration).alias("failed"))

    def case_metrics(self, metrics, configuration):
        return metrics.groupBy("test_case").agg(F.avg("err").alias("mae"), F.avg(F.col("failed").cast("double")).alias("failure_rate"))

    def case_plots(self, metrics, configuration):
        return metrics.groupBy("test_case", F.floor(F.col("err") / 1000).alias("x")).agg(F.count("*").alias("y"))

    def suite_metrics(self, cases, configuration):
        return cases.agg(F.var_pop("mae").alias("variance"), F.count("*").alias("cases"))


CASES = "(SELECT DISTINCT l_returnflag AS stratum, l_returnflag AS test_case FROM lineitem UNION ALL SELECT DISTINCT l_returnflag, 'all' FROM lineitem)"


def membership(spark, sf):
    flags = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("stratum")).distinct()
    return flags.select("stratum", F.explode(F.array("stratum", F.lit("all"))).alias("test_case"))


@query("k01_evaluator_class", f"""SELECT c.v AS configuration, test_case, round(avg(abs(pred - gt)), 4) AS mae, round(avg(CASE WHEN abs(pred - gt) > c.v THEN 1.0 ELSE 0 END), 6) AS failure_rate FROM w_reg JOIN {CASES} m USING (stratum),
  (SELECT CAST(x AS DOUBLE) AS v FROM (VALUES (1000), (5000)) t(x)) c GROUP BY 1, 2""")  # fmt: skip
def k01(spark, sf):
    out = AbsoluteError().run(views.reg(spark, sf), membership(spark, sf), ["stratum"])
    parts = [r["cases"].withColumn("configuration", F.lit(c)) for c, r in out.items()]
    both = parts[0].unionByName(parts[1])
    return both.select("configuration", "test_case", F.round("mae", 4).alias("mae"), r6("failure_rate").alias("failure_rate"))


@query("k01_evaluator_suite", f"""SELECT round(var_pop(mae), 2) AS variance, count(*) AS cases FROM (SELECT test_case, avg(abs(pred - gt)) AS mae FROM w_reg JOIN {CASES} m USING (stratum) GROUP BY 1)""")
def k01b(spark, sf):
    out = AbsoluteError().run(views.reg(spark, sf), membership(spark, sf), ["stratum"])
    return out[1000.0]["suite"].select(F.round("variance", 2).alias("variance"), "cases")


@query("k02_evaluator_function", f"SELECT test_case, count(*) AS n, round(sum(abs(pred - gt)), 0) AS err FROM w_reg JOIN {CASES} m USING (stratum) GROUP BY 1")
def k02(spark, sf):
    rows = evaluator.evaluate_with(lambda s: s.select("stratum", F.abs(F.col("pred") - F.col("gt")).alias("err")), views.reg(spark, sf), membership(spark, sf), ["stratum"])
    return rows.groupBy("test_case").agg(F.count("*").alias("n"), F.round(F.sum("err"), 0).alias("err"))


def halve(pdf):
    """Stands for a user's model: any function of a batch of samples."""
    return pdf.assign(score=pdf["n_chars"] / 2.0)[["doc_id", "score"]]


@query("k03_inference_function", "SELECT doc_id, n_chars / 2 AS score FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def k03(spark, sf):
    from sparkeval.operators.joins import without_inference

    todo = without_inference(table(spark, sf, "documents").select("doc_id", "n_chars"), table(spark, sf, "labels"), ["doc_id"])
    return evaluator.infer(todo, halve, "doc_id long, score double")


@query("k04_workflow_types", "SELECT label, count(*) AS n FROM w_det_inf GROUP BY 1")
def k04(spark, sf):
    df = det.infs(spark, sf)
    evaluator.check_type(df.schema, ["image_id", "geom", "score"])
    return df.groupBy("label").agg(F.count("*").alias("n"))


def partial_sums(g):
    return {"n": len(g), "s": float(g["gt"].sum()), "top": float(g["gt"].max())}


def merged_sums(p):
    return {"n": int(p["n"].sum()), "mean": float(p["s"].sum() / p["n"].sum()), "top": float(p["top"].max())}


@query("k05_user_aggregate", "SELECT stratum, count(*) AS n, round(avg(gt), 3) AS mean, round(max(gt), 3) AS top FROM w_reg GROUP BY 1")
def k05(spark, sf):
    df = views.reg(spark, sf).select("stratum", "gt")
    out = evaluator.grouped_aggregate(df, ["stratum"], partial_sums, merged_sums, "stratum string, n long, s double, top double", "stratum string, n long, mean double, top double")
    return out.select("stratum", "n", F.round("mean", 3).alias("mean"), F.round("top", 3).alias("top"))


def at_thresholds(rec):
    for t in (0.25, 0.5, 0.75):
        yield {"doc_id": rec["doc_id"], "threshold": t, "tp": int(rec["gt"] and rec["score"] >= t), "fp": int(not rec["gt"] and rec["score"] >= t)}


@query("k06_table_function", "SELECT t.v AS threshold, count(*) FILTER (WHERE gt AND score >= t.v) AS tp, count(*) FILTER (WHERE NOT gt AND score >= t.v) AS fp FROM w_bin, (SELECT CAST(x AS DOUBLE) / 4 AS v FROM range(1, 4) r(x)) t GROUP BY 1")
def k06(spark, sf):
    rows = evaluator.expand(views.binary(spark, sf).select("doc_id", "gt", "score"), at_thresholds, "doc_id long, threshold double, tp long, fp long")
    return rows.groupBy("threshold").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))


K7 = SCORES + THRESH
K7_CASES = """, kc AS (SELECT o_orderkey AS image_id, o_orderpriority AS test_case FROM orders)""" + CLASS.replace("SELECT mm.stratum AS test_case, ", "SELECT kc.test_case, ").replace(
    "FROM mm JOIN th", "FROM mm JOIN kc ON kc.image_id = mm.image_id JOIN th"
).replace("FROM ys GROUP BY ALL", "FROM (SELECT ys.* REPLACE (kc.test_case AS stratum) FROM ys JOIN kc USING (image_id)) GROUP BY ALL") + CASE


@query("k07_detection_evaluator", "SELECT test_case, round(macro_f1, 6) AS macro_f1, round(mean_ap, 6) AS mean_ap, tp, fp, fn FROM ct", ctes=K7 + K7_CASES)
def k07(spark, sf):
    cases = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_orderpriority").alias("test_case"))
    out = evaluator.DetectionEvaluator().run(det.gts(spark, sf), det.infs(spark, sf), cases)
    return out["cases"].select("test_case", r6("macro_f1").alias("macro_f1"), r6("mean_ap").alias("mean_ap"), "tp", "fp", "fn")


@query("k07_classification_evaluator", """SELECT stratum AS test_case, round(avg(tp / (tp + fp)), 6) AS precision, round(avg(tp / (tp + fn)), 6) AS recall, round(avg(2 * tp / (2 * tp + fp + fn)), 6) AS f1 FROM (SELECT stratum, label, count(*) FILTER (WHERE gt = label AND pred = label) AS tp,
  count(*) FILTER (WHERE gt <> label AND pred = label) AS fp, count(*) FILTER (WHERE gt = label AND pred <> label) AS fn FROM w_cls, (SELECT DISTINCT gt AS label FROM w_cls) l GROUP BY 1, 2) GROUP BY 1""")  # fmt: skip
def k07b(spark, sf):
    cases = evaluator.ClassificationEvaluator().run(views.cls(spark, sf).withColumnRenamed("stratum", "test_case"))["cases"]
    return cases.select("test_case", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("f05_precision_envelope", "SELECT label, threshold, round(best, 6) AS envelope FROM env", ctes=SCORES + AP)
def f05(spark, sf):
    from sparkeval.operators.running import running

    points = curves.threshold_points(curves.detection_counts(det.multi(spark, sf)), ["label"])
    env = running(points, ["label"], "threshold", {"envelope": F.col("precision")}, descending=False, how="max")
    return env.select("label", "threshold", r6("envelope").alias("envelope"))


@query("f03_match_priority", f"""SELECT image_id, gt_idx, inf_idx, row_number() OVER (PARTITION BY image_id, gt_idx ORDER BY score DESC, inf_idx) AS priority FROM (SELECT i.image_id, g.gt_idx, i.inf_idx, i.score, row_number() OVER (PARTITION BY i.image_id, i.inf_idx ORDER BY {IOU} DESC, g.gt_idx) AS rn
  FROM w_det_inf i JOIN w_det_gt g ON i.image_id = g.image_id AND i.label = g.label WHERE {IOU} >= 0.5) WHERE rn = 1""")  # fmt: skip
def f03(spark, sf):
    """Order in which inferences claim their best ground truth."""
    from pyspark.sql import Window as W

    from sparkeval.functions.boxes import box_iou
    from sparkeval.operators.matching import overlapping

    pairs = overlapping(det.gts(spark, sf), det.infs(spark, sf), ["image_id", "label"])
    pairs = pairs.withColumn("iou", box_iou(F.col("a.geom"), F.col("b.geom"))).where("iou >= 0.5")
    best = pairs.groupBy("image_id", F.col("b.inf_idx").alias("inf_idx")).agg(
        F.min_by(F.struct("a.gt_idx", "b.score"), F.struct((-F.col("iou")).alias("n"), F.col("a.gt_idx").alias("g"))).alias("p")
    ).select("image_id", "inf_idx", "p.*")
    order = W.partitionBy("image_id", "gt_idx").orderBy(F.col("score").desc(), "inf_idx")
    return best.select("image_id", "gt_idx", "inf_idx", F.row_number().over(order).cast("long").alias("priority"))
