import random
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkeval.operators import blocks, checks, classification, filters, intervals, polygons, suites, text, vision
from sparkeval.operators.running import average_ranks, exact_quantiles, following, running
from sparkeval.sources import files
from sparkeval.sources.datasets import Datasets
from sparkeval.session import new_path
from sparkeval.streaming import ingest


def test__running_and_following_match_a_plain_scan(spark):
    rnd = random.Random(5)
    rows = [(g, float(v), rnd.randint(0, 9)) for g in "ab" for v in rnd.sample(range(3000), 700)]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    got = {(r.g, r.v): (r.up, r.top, r.next.v if r.next else None) for r in following(running(running(df, ["g"], "v", {"up": F.col("w")}), ["g"], "v", {"top": F.col("w")}, descending=False, how="max"), ["g"], "v", ["v"]).collect()}
    for g in "ab":
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        total = 0
        for k, r in enumerate(mine):
            total += r[2]
            below = max(x[2] for x in mine[k:])
            assert got[g, r[1]] == (total, below, mine[k + 1][1] if k + 1 < len(mine) else None)


def test__quantiles_and_ranks_are_exact(spark):
    rnd = random.Random(6)
    values = [rnd.choice([1.0, 2.0, 5.0, rnd.random()]) for _ in range(501)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    qs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.9, 1.0]
    got = {r.fraction: r.quantile for r in exact_quantiles(df, [], "v", qs).collect()}
    for q in qs:
        assert got[q] == pytest.approx(np.quantile(values, q))
    ranks = {r.v: r.rk for r in average_ranks(df, [], "v", "rk").collect()}
    order = sorted(values)
    for v in set(values):
        assert ranks[v] == np.mean([i + 1 for i, x in enumerate(order) if x == v])


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]


@pytest.mark.parametrize(
    "a,b,expected",
    [
        (SQUARE, SQUARE, 1.0), (SQUARE, [(2, 0), (6, 0), (6, 4), (2, 4)], 1 / 3), (SQUARE, [(5, 5), (6, 5), (6, 6)], 0.0),
        ([(0, 0), (4, 0), (0, 4)], SQUARE, 0.5), ([(0, 0), (4, 4), (4, 0), (0, 4)], [(0, 0), (4, 4), (4, 0), (0, 4)], 1.0),
    ],
)
def test__polygon_iou(a, b, expected):
    pa, pb = np.array(a, float), np.array(b, float)
    assert polygons.ring_iou(pa, pb) == pytest.approx(expected)
    assert polygons.small_ring_ious(pa[None], pb[None])[0] == pytest.approx(expected)


def test__polygon_paths_agree():
    rnd = np.random.default_rng(0)
    a, b = rnd.uniform(0, 10, (40, 5, 2)), rnd.uniform(0, 10, (40, 6, 2))
    assert polygons.small_ring_ious(a, b) == pytest.approx([polygons.ring_iou(x, y) for x, y in zip(a, b)])


def test__best_assignment_is_optimal():
    rnd = np.random.default_rng(1)
    for rows, cols in [(3, 3), (2, 5), (5, 2), (7, 7), (6, 8), (8, 7)]:
        for _ in range(5):
            w = rnd.integers(0, 20, (rows, cols)).astype(float)
            got = intervals.best_assignment(w)
            small, big = min(rows, cols), max(rows, cols)
            m = w if rows <= cols else w.T
            best = max(sum(m[i, p[i]] for i in range(small)) for p in permutations(range(big), small))
            assert len(got) == small and len({j for _, j in got}) == small and len({i for i, _ in got}) == small
            assert sum(w[i, j] for i, j in got) == best


def seg(spark, rows):
    return spark.createDataFrame([(1, *r) for r in rows], "recording int, speaker string, s double, e double")


def test__diarization_example(spark):
    ref = seg(spark, [("A", 0.0, 10.0), ("B", 13.0, 21.0), ("A", 24.0, 32.0), ("C", 32.0, 40.0)])
    hyp = seg(spark, [("A", 2.0, 14.0), ("C", 14.0, 15.0), ("B", 15.0, 20.0), ("C", 23.0, 36.0), ("D", 36.0, 40.0)])
    m = intervals.diarization_metrics(ref, hyp, "recording", "speaker").first()
    # False alarm 4 s and missed 3 s; by name 14 s are confused. A->A, B->B, C->C is not the best mapping here.
    assert m.identification_error_rate == pytest.approx((4 + 3 + 14) / 34)
    assert m.diarization_error_rate <= m.identification_error_rate
    assert m.detection_precision == pytest.approx(31 / 35) and m.detection_recall == pytest.approx(31 / 34)
    gone = [(r.s, r.e) for r in intervals.missed(ref, hyp, ["recording"]).orderBy("s").collect()]
    assert gone == [(0.0, 2.0), (20.0, 21.0)]


def test__merged_joins_touching_and_nested(spark):
    df = seg(spark, [("A", 0.0, 2.0), ("B", 2.0, 3.0), ("A", 5.0, 9.0), ("A", 6.0, 7.0), ("C", 20.0, 21.0)])
    assert [(r.s, r.e) for r in intervals.merged(df, ["recording"]).orderBy("s").collect()] == [(0.0, 3.0), (5.0, 9.0), (20.0, 21.0)]


def edits(a, b):
    """(cost, hits) of the best alignment by the textbook table."""
    t = [[(j, 0) for j in range(len(b) + 1)]]
    for i, x in enumerate(a):
        row = [(i + 1, 0)]
        for j, y in enumerate(b):
            c, h = t[i][j]
            diag = (c, h - 1) if x == y else (c + 1, h)
            row.append(min(diag, (t[i][j + 1][0] + 1, t[i][j + 1][1]), (row[j][0] + 1, row[j][1])))
        t.append(row)
    return t[-1][-1][0], -t[-1][-1][1]


def lcs(a, b):
    t = [[0] * (len(b) + 1)]
    for i, x in enumerate(a):
        row = [0]
        for j, y in enumerate(b):
            row.append(max(t[i][j + 1], row[j], t[i][j] + (x == y)))
        t.append(row)
    return t[-1][-1]


def test__word_alignment_against_brute_force(spark):
    rnd = random.Random(8)
    pairs = [("k i t t e n", "s i t t i n g"), ("a", ""), ("", "a b"), ("a b c", "a b c")]
    pairs += [(" ".join(rnd.choices("abcd", k=rnd.randint(0, 9))), " ".join(rnd.choices("abcd", k=rnd.randint(0, 9)))) for _ in range(60)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id int, ref string, cand string")
    for r in text.rouge_l(text.edit_counts(df, "ref", "cand"), "ref", "cand").collect():
        a, b = r.ref.split(), r.cand.split()
        assert (r.cost, r.hits) == edits(a, b)
        assert r.substitutions + r.deletions + r.insertions == r.cost and min(r.substitutions, r.deletions, r.insertions) >= 0
        n = lcs(a, b)
        assert r.rouge_l == pytest.approx(2 * n / (len(a) + len(b)) if n else 0.0)


def test__pairs_of_any_length_advance_together():
    rnd = random.Random(3)
    sizes = [0, 0, 1, 2, 3, 5, 8, 40, 41, 300, 7, 6, 5, 4]
    ref, cand = ([[rnd.choice("abcde") for _ in range(n)] for n in rnd.sample(sizes, len(sizes))] for _ in range(2))
    ref[3], cand[5] = None, None
    least, n, m = text.in_step(pd.Series(ref), pd.Series(cand), text._edits)
    common = text.in_step(pd.Series(ref), pd.Series(cand), text._common)[0]
    for i, (a, b) in enumerate(zip(ref, cand)):
        a, b = a or [], b or []
        cost = -(-int(least[i]) // text._EDIT)
        assert (cost, cost * text._EDIT - int(least[i])) == edits(a, b) and common[i] == lcs(a, b) and (n[i], m[i]) == (len(a), len(b))
    long = [str(rnd.randrange(300)) for _ in range(6000)]
    least, _, _ = text.in_step(pd.Series([long, ["x"]]), pd.Series([long[:2000] + ["new"] + long[2001:], ["x"]]), text._edits)
    assert least.tolist() == [text._EDIT - 5999, -1]


def test__meteor_and_bleu_examples(spark):
    df = spark.createDataFrame([(1, "the president then spoke to the audience", "the president spoke to the audience")], "id int, ref string, cand string")
    p, r = 1.0, 6 / 7
    assert text.meteor(df, ["id"], "ref", "cand").first().meteor == pytest.approx(10 * p * r / (r + 9 * p) * (1 - 0.5 * 2 / 6))
    same = df.withColumn("cand", F.col("ref"))
    assert text.bleu(same, ["id"], "ref", "cand").first().bleu == pytest.approx(1.0)
    assert df.select(text.normalized(F.lit("The  cat, an Owl!")).alias("n")).first().n == "cat owl"


def test__span_outcomes(spark):
    schema = "doc_id int, idx int, label string, start int, end int"
    g = spark.createDataFrame([(1, 0, "PER", 0, 5), (1, 1, "LOC", 10, 15), (1, 2, "ORG", 20, 25), (1, 3, "ORG", 40, 45)], schema)
    p = spark.createDataFrame([(1, 0, "PER", 0, 5), (1, 1, "ORG", 10, 15), (1, 2, "ORG", 21, 25), (1, 3, "PER", 19, 22), (1, 4, "LOC", 50, 55)], schema)
    got = sorted((r.outcome, r.idx) for r in intervals.span_outcomes(g, p).collect())
    assert got == [("CLS_ERROR", 1), ("CLS_LOC_ERROR", 3), ("FN", 1), ("FN", 2), ("FN", 3), ("LOC_ERROR", 2), ("OVR_GEN", 4), ("TP", 0)]


def test__box_pair_sums_are_independent_of_block_size(spark):
    rnd = random.Random(4)
    rows = [(im, k, x, y, x + 3.0, y + 3.0) for im in range(3) for k in range(20) for x, y in [(rnd.uniform(0, 9), rnd.uniform(0, 9))]]
    df = spark.createDataFrame(rows, "image_id int, idx int, x1 double, y1 double, x2 double, y2 double").selectExpr("image_id", "idx", "struct(x1, y1, x2, y2) AS geom")
    get = lambda n: {r.image_id: (r.n, round(r.dist, 6), round(r.iou, 6)) for r in blocks.box_pair_sums(df, n).collect()}
    assert get(1024) == get(6) and get(6)[0][0] == 190


def test__carry_forward(spark):
    rows = [("p", i, i not in (2, 4), 0.5 + i / 100 if i in (2, 4) else 0.0) for i in range(6)] + [("q", i, True, 0.0) for i in range(20)]
    df = spark.createDataFrame(rows, "ped string, frame long, failed_to_infer boolean, score double")
    got = {(r.ped, r.frame): (r.confidence, r.observation, r.failed) for r in vision.carry_forward(df, ["ped"], "frame").collect()}
    assert [got["p", i][0] for i in range(6)] == [0.0, 0.0, 0.52, 0.52, 0.54, 0.54]
    assert got["p", 0][1] and not got["p", 2][1] and not got["p", 5][2]
    assert got["q", 16][1:] == (True, False) and got["q", 17][1:] == (False, True)


def test__filters(spark):
    df = spark.createDataFrame([(1, "abc", [1, 2]), (2, None, None), (3, "XYZ", [3])], "id int, s string, a array<int>")
    ids = lambda f, c: [r.id for r in df.where(f.predicate(F.col(c))).orderBy("id").collect()]
    ff = filters.FieldFilter
    assert ids(ff(value_in=["abc"]), "s") == [1] and ids(ff(value_in=["abc"], inverse=True), "s") == [2, 3]
    assert ids(ff(contains="x", regex_match=True, regex_flags="i"), "s") == [3] and ids(ff(null_value=True), "s") == [2]
    assert ids(ff(array_contains=[2, 9]), "a") == [1] and ids(ff(number_range=filters.Range(min=2)), "id") == [2, 3]
    for bad in (lambda: ff(), lambda: ff(value_in=["a"], contains="b"), lambda: filters.Range(2, 1), lambda: filters.ResultFilter("m", None, {"x": ff(contains="a")}, True)):
        with pytest.raises(ValueError):
            bad()
    assert filters.spark_expression("@datapoint.a ^ 2 == array_size(xs)") == "pow(datapoint.a, 2) = size(xs)"


def test__checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    with pytest.raises(ValueError, match="duplicate"):
        checks.check_keys(df, ["id"])
    with pytest.raises(ValueError):
        checks.check_keys(df.limit(0), ["id"])
    with pytest.raises(ValueError):
        checks.check_results(["id", "bev"], ["id"], ["bev"], [None], [])
    assert checks.infer_id_fields(["a", "x_id", "id_y"]) == ["x_id", "id_y"] and checks.infer_id_fields(["locator", "text"]) == ["locator"]
    with pytest.raises(ValueError):
        checks.infer_id_fields(["a"])


@pytest.mark.parametrize(
    "cell,kind",
    [("", "null"), ("NaN", "null"), ("null", "null"), ("TRUE", "boolean"), ("12", "number"), ("-1.50", "number"), ("3e2", "text"), ("12e5abc", "text"), ("[1,2]", "json"), ('{"a": 1}', "json"), ("{a", "text"), ("abc", "text"), ("1d", "text")],
)
def test__cell_kind(spark, cell, kind):
    assert spark.createDataFrame([(cell,)], "c string").select(files.cell_kind(F.col("c")).alias("k")).first().k == kind


def test__dataset_versions_and_results(spark):
    store = Datasets(spark, new_path(spark, "test"))
    rows = [(1, None), (2, float("inf")), (3, float("nan")), (4, 42.0)]
    store.upload("d", spark.createDataFrame(rows, "id int, a double"))
    back = {r.id: r.a for r in store.download("d").collect()}
    assert back[1] is None and back[2] == float("inf") and back[3] != back[3] and back[4] == 42.0
    store.upload("d", spark.createDataFrame([(4, 1.0, "x"), (5, 2.0, "y")], "id int, a double, b string"), append_only=True)
    assert store.download("d").count() == 5 and store.download("d", 1).count() == 4
    assert [(r.n_added, r.n_removed) for r in store.history("d").collect()] == [(4, 0), (2, 1)]
    with pytest.raises(ValueError):
        store.download("d", 9)
    res = spark.createDataFrame([(i, i / 10) for i in range(3, 20)], "id int, score double")
    assert store.upload_results("d", "m", res, tags=["t"]) == (3, 0)
    assert store.upload_results("d", "m", res.where("id < 5"), tags=["t"]) == (0, 2)
    out = store.download_results_by_tag("d", "t")[None]
    assert {r.id: r.score for r in out.collect()} == {1: None, 2: None, 3: 0.3, 4: 0.4, 5: 0.5}
    with pytest.raises(LookupError):
        store.download_results_by_tag("d", "none")


def test__stream_equals_batch_for_one_and_many_batches(spark):
    df = spark.range(60).selectExpr("timestamp_seconds(id * 4000) AS ts", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS stratum", "id % 3 AS tp", "id % 2 AS fp", "id % 5 AS fn")
    path = new_path(spark, "stream-test")
    df.repartition(5).write.parquet(path)
    day = F.window("ts", "1 day")["start"].alias("window_start")
    batch = ingest.live_rates(df.groupBy(day, "stratum").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], F.count("*").alias("n")))
    want = sorted(tuple(r) for r in batch.collect())
    for files_per_trigger in (None, 1):
        s = ingest.live_counts(ingest.stream_of(spark, path, df.schema, files_per_trigger), "ts", ["stratum"], new_path(spark, "live"))
        got = ingest.live_rates(s)
        assert sorted(tuple(r) for r in got.select(*batch.columns).collect()) == want


def test__late_calls_count_and_the_earliest_wins(spark):
    path = new_path(spark, "late-calls")
    rows = [[(1, 900, "x"), (2, 901, "y")], [(1, 5, "late but first"), (3, 6, "very late")], [(2, 901, "y"), (2, 990, "z")]]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, "id int, s long, v string").selectExpr("id", "timestamp_seconds(s * 86400) AS start", "v").coalesce(1).write.parquet(f"{path}/{k}")
    schema = spark.read.parquet(f"{path}/0").schema
    calls = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)
    assert sorted((r.id, r.v) for r in ingest.first_calls(calls, ["id"], new_path(spark, "first")).collect()) == [(1, "late but first"), (2, "y"), (3, "very late")]


@pytest.mark.parametrize("scores", [[i / 37 % 1.0 for i in range(300)], [-0.5, 0.35, 0.72], [None, 0.5, float("nan"), 0.505, 0.5], [], [-0.004, 0.004, 12.5, -3.0, 0.11, 0.1]])
def test__thin_thresholds(spark, scores):
    df = spark.createDataFrame([(x,) for x in scores], "score double")
    want = [0.0]
    for t in sorted({i / 10 for i in range(11)} | {x for x in scores if x is not None and x == x}):
        if abs(t - want[-1]) >= 0.01:
            want.append(t)
    assert classification.thin_thresholds(df) == want


def test__suite_edits_and_copy(spark):
    e = spark.createDataFrame([("c", 1, "add", 1), ("c", 1, "remove", 2), ("c", 2, "add", 3), ("c", 2, "add", 4)], "case string, sample int, action string, n int")
    assert [r.sample for r in suites.after_edits(e, ["case", "sample"], "n").collect()] == [2]
    s = spark.createDataFrame([("a", "g", "x"), ("b", "g", "y")], "dataset string, part string, name string")
    assert sorted(tuple(r) for r in suites.copy_standard(s, "a", "b", ["g"]).collect()) == [("a", "g", "x"), ("b", "g", "x")]
    with pytest.raises(ValueError):
        suites.copy_standard(s, "a", "a", ["g"])


def test__keypoint_case_reports_every_keypoint(spark):
    from sparkeval.operators import vision

    rows = [("a", [float(i) for i in range(7)]), ("a", [float(i + 2) for i in range(7)]), (None, [1.0] * 6), ("c", None)]
    table = spark.createDataFrame([(c, d, 0.1, 0.1, "success" if d else "failure_to_detect") for c, d in rows], "case string, dist array<double>, mse double, nmse double, outcome string")
    got = {r["case"]: r.avg_dist for r in vision.keypoint_case(table, ["case"]).collect()}
    assert got == {"a": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0], None: [1.0] * 6, "c": None}
