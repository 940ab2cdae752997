"""Suite logs against a replay in order, listed violations, and face case metrics against plain counting."""

import random

import pytest
from pyspark.sql import functions as F

from sparkeval.operators import checks, detection, suites, vision
from sparkeval.session import new_path
from sparkeval.sources import files


def test__suite_replay_equals_the_log_in_order(spark):
    rng = random.Random(6)
    log = []
    for n in range(400):
        action = rng.choices(["add", "remove", "replace", "drop", "reset"], [60, 25, 6, 4, 2])[0]
        case = None if action == "reset" else rng.choice("abcd")
        log.append((rng.choice("st"), case, rng.randrange(6) if action in ("add", "remove") else None, action, n * 10, n))
    state = {}
    for suite, case, sample, action, truth, _ in log:
        if action == "reset":
            state = {k: v for k, v in state.items() if k[0] != suite}
        elif action in ("replace", "drop"):
            state = {k: v for k, v in state.items() if k[:2] != (suite, case)}
        elif action == "add":
            state[suite, case, sample] = truth
        else:
            state.pop((suite, case, sample), None)
    edits = spark.createDataFrame(log, "suite string, test_case string, sample int, action string, truth int, n int")
    got = {(r.suite, r.test_case, r.sample): r.truth for r in suites.replayed(edits, "suite", "test_case", "sample", "n").collect()}
    assert got == state and state
    assert suites.replayed(edits.limit(0), "suite", "test_case", "sample", "n").count() == 0


def test__violations_are_listed_and_clean_results_give_none(spark):
    results = spark.createDataFrame([("a", None, 1, 0.5), ("a", None, 2, 0.1), ("b", "{}", 1, 0.2)], "model string, eval_config string, id int, score double")
    uploads = spark.createDataFrame([("a", None, "x"), ("b", "{}", "y")], "model string, eval_config string, tag string")
    assert checks.result_violations(uploads, results, ["id"]).count() == 0
    bad = results.unionByName(results.where("model = 'b'")).unionByName(results.limit(1).selectExpr("model", "eval_config", "9 AS id", "CAST(NULL AS DOUBLE) AS score"))
    more = uploads.unionByName(uploads.where("model = 'a'")).unionByName(spark.createDataFrame([("c", "x", "  ")], uploads.schema))
    got = sorted((r.rule, r.model, r.n) for r in checks.result_violations(more, bad, ["id"]).collect())
    assert got == [("blank_tag", "c", 1), ("duplicate_config", "a", 2), ("duplicate_id", "b", 1), ("no_result", "a", 1)]
    # Thresholded columns alone are no result.
    assert checks.result_violations(uploads, results, ["id"], ["score"]).where("rule = 'no_result'").count() == 2


def test__face_case_metrics_take_the_last_listing(spark):
    pairs = [("p", "q", True, 0.9), ("q", "p", True, None), ("p", "r", False, 0.8), ("r", "s", True, 0.1), ("s", "t", False, 0.2)]
    samples = [("p", True), ("q", False), ("r", False), ("s", True), ("t", False)]
    m = vision.face_case_metrics(
        spark.createDataFrame(pairs, "a string, b string, is_match boolean, similarity double"), spark.createDataFrame(samples, "image_id string, failed boolean"), 0.5, 0.25
    ).first()
    assert (m.pairs, m.genuine, m.imposter, m.fm, m.fnm, m.pair_failures) == (4, 2, 2, 1, 1, 1)
    # p-q by its own missing similarity, p-r and s-t by the image that lists them.
    assert m.fte == 3 and m.fter == 3 / 5 and m.fmr == 0.5 and m.fnmr == 0.5 and m.delta_fnmr == 0.25 and m.pair_failure_rate == 0.25


def test__chunks_hold_what_their_measured_size_allows(spark):
    df = spark.range(5000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    path = new_path(spark, "chunks")
    each = files.write_chunks(df, path, chunk_bytes=50_000, single_bytes=100_000, rows=200)
    back = spark.read.parquet(f"{path}/chunks")
    sizes = [r.n for r in back.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 3 and max(sizes) <= each and sorted(r.id for r in back.collect()) == list(range(5000))
    assert files.chunk_rows(df, f"{path}/_again") == (5000, 5000)  # below two gigabytes: one chunk
    with pytest.raises(ValueError):
        files.write_chunks(df.limit(0), path)


def test__a_trusted_frame_is_checked_at_its_ends_and_on_a_sample(spark):
    df = spark.range(3000).select("id")
    got = sorted(r.id for r in checks.trusted_sample(df, "id", ends=5, rows=100).collect())
    assert set(range(5)) | set(range(2995, 3000)) <= set(got) and 100 <= len(got) <= 110
    assert checks.trusted_sample(df.where("id < 7"), "id").count() == 7


def test__threshold_grid_keeps_repeats_below_the_points(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.5), ("a", None), ("b", 0.0), ("b", 1.0), ("b", 0.2), ("b", 0.2)], "g string, score double")
    got = sorted(tuple(r) for r in detection.threshold_grid(df, points=3, by=["g"]).collect())
    assert got == [("a", 0.5), ("a", 0.5), ("b", 0.0), ("b", 0.5), ("b", 1.0)]
    assert sorted(r.threshold for r in detection.threshold_grid(df.where("g = 'a'")).collect()) == [0.5, 0.5]
    assert detection.threshold_grid(df.limit(0)).count() == 0
