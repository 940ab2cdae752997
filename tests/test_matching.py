import random

import pytest
from pyspark.sql import functions as F

from sparkeval.operators import curves, detection, matching
from sparkeval.operators.matching import match, match_multiclass, overlapping

GT = "image_id long, gt_idx long, label string, x1 double, y1 double, x2 double, y2 double, is_ignored boolean"
INF = "image_id long, inf_idx long, label string, x1 double, y1 double, x2 double, y2 double, score double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    inter = w * h
    return inter / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter)


def greedy(gts, infs, t):
    """Inferences by falling score take their best ground truth, if free; ignored ones swallow them."""
    order = [g for g in gts if not g["ign"]] + [g for g in gts if g["ign"]]
    taken, out, left = {}, [], []
    for i in sorted(infs, key=lambda x: -x["s"]):
        best = None
        for g in order:
            v = iou(g["b"], i["b"])
            if v >= t and (best is None or v > iou(best["b"], i["b"])):
                best = g
        if best is not None and best["ign"]:
            continue
        if best is None or id(best) in taken:
            left.append(i)
        else:
            taken[id(best)] = i
            out.append((best, i))
    return out, [g for g in gts if not g["ign"] and id(g) not in taken], left


def scene(seed, images=25, crowd=12, labels="AB", size=30):
    rnd = random.Random(seed)
    box = lambda: (lambda x, y: (x, y, x + rnd.randint(1, 12), y + rnd.randint(1, 12)))(rnd.randint(0, size), rnd.randint(0, size))
    gts, infs = [], []
    for im in range(images):
        bs = [tuple(float(v) for v in box()) for _ in range(crowd)]
        bs += bs[:3]  # copies
        for k, b in enumerate(bs):
            gts.append(dict(im=im, k=k, l=rnd.choice(labels), b=b, ign=rnd.random() < 0.2))
        for k in range(crowd + 4):
            b = rnd.choice(bs)
            d = rnd.choice([0, 0, 1, 2])
            infs.append(dict(im=im, k=k, l=rnd.choice(labels), b=(b[0] + d, b[1], b[2] + d, b[3]), s=rnd.choice([0.1, 0.3, 0.5, 0.7, 0.9])))
    return gts, infs


def frames(spark, gts, infs):
    g = spark.createDataFrame([(x["im"], x["k"], x["l"], *x["b"], x["ign"]) for x in gts], GT)
    i = spark.createDataFrame([(x["im"], x["k"], x["l"], *x["b"], x["s"]) for x in infs], INF)
    return detection.with_boxes(g), detection.with_boxes(i)


def rows(m):
    out = {"matched": set(), "unmatched_gt": set(), "unmatched_inf": set(), "confused": set()}
    for r in m.where("kind <> 'ignored'").select("image_id", "kind", "gt.gt_idx", "inf.inf_idx").collect():
        out[r.kind].add((r.image_id, r.gt_idx, r.inf_idx))
    return out


@pytest.mark.parametrize("seed,threshold", [(1, 0.5), (2, 0.3), (3, 0.7)])
def test__match_equals_sequential(spark, seed, threshold):
    gts, infs = scene(seed)
    expected = {"matched": set(), "unmatched_gt": set(), "unmatched_inf": set()}
    for im in range(25):
        hit, miss, extra = greedy([g for g in gts if g["im"] == im], [i for i in infs if i["im"] == im], threshold)
        expected["matched"] |= {(im, g["k"], i["k"]) for g, i in hit}
        expected["unmatched_gt"] |= {(im, g["k"], None) for g in miss}
        expected["unmatched_inf"] |= {(im, None, i["k"]) for i in extra}
    got = rows(match(*frames(spark, gts, infs), threshold))
    for kind, want in expected.items():
        assert got[kind] == want, kind


def test__match_multiclass_equals_sequential(spark):
    gts, infs = scene(7, images=20, labels="ABC")
    matched, confused, fn, fp = set(), set(), set(), set()
    for im in range(20):
        left_g, left_i = [], []
        for label in "ABC":
            hit, miss, extra = greedy([g for g in gts if g["im"] == im and g["l"] == label], [i for i in infs if i["im"] == im and i["l"] == label], 0.5)
            matched |= {(im, g["k"], i["k"]) for g, i in hit}
            left_g += miss
            left_i += extra
        fp |= {(im, None, i["k"]) for i in left_i}
        hit, _, _ = greedy(left_g + [g for g in gts if g["im"] == im and g["ign"]], left_i, 0.5)
        crossed = [(g, i) for g, i in hit if g["l"] != i["l"]]
        confused |= {(im, g["k"], i["k"]) for g, i in crossed}
        gone = {id(g) for g, _ in crossed}
        fn |= {(im, g["k"], None) for g in left_g if id(g) not in gone}
    got = rows(match_multiclass(*frames(spark, gts, infs), 0.5))
    assert (got["matched"], got["confused"], got["unmatched_gt"], got["unmatched_inf"]) == (matched, confused, fn, fp)


def test__zero_threshold_takes_boxes_without_overlap(spark):
    gts = [dict(im=0, k=0, l="A", b=(0.0, 0.0, 1.0, 1.0), ign=False)]
    infs = [dict(im=0, k=0, l="A", b=(50.0, 50.0, 51.0, 51.0), s=0.5)]
    assert rows(match(*frames(spark, gts, infs), 0.0))["matched"] == {(0, 0, 0)}
    assert rows(match(*frames(spark, gts, infs), 0.5))["matched"] == set()


def test__images_without_either_side(spark):
    gts = [dict(im=0, k=0, l="A", b=(0.0, 0.0, 1.0, 1.0), ign=False)]
    infs = [dict(im=1, k=0, l="A", b=(0.0, 0.0, 1.0, 1.0), s=0.5)]
    got = rows(match(*frames(spark, gts, infs), 0.5))
    assert got["unmatched_gt"] == {(0, 0, None)} and got["unmatched_inf"] == {(1, None, 0)}


def test__overlapping_reports_each_pair_once_for_mixed_sizes(spark):
    rnd = random.Random(3)
    bs = [(x, y, x + s, y + s) for x, y, s in ((rnd.uniform(-50, 50), rnd.uniform(-50, 50), rnd.choice([0.5, 3, 40])) for _ in range(120))]
    df = spark.createDataFrame([(0, k, *b) for k, b in enumerate(bs)], "image_id int, k int, x1 double, y1 double, x2 double, y2 double")
    df = detection.with_boxes(df)
    got = sorted((r.a, r.b) for r in overlapping(df, df, ["image_id"]).selectExpr("a.k AS a", "b.k AS b").collect())
    assert got == sorted((i, j) for i, a in enumerate(bs) for j, b in enumerate(bs) if iou(a, b) > 0)


def test__thresholds_and_curves(spark):
    scores = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.6), (0, 0.5), (1, -1.0)]
    counts = curves.score_counts(spark.createDataFrame(scores, "y int, s double"), [], F.col("y") == 1, F.col("s"))
    assert curves.optimal_f1(counts).first().threshold == 0.6
    points = {r.threshold: (r.precision, r.recall) for r in curves.threshold_points(counts).collect()}
    assert points[0.6] == pytest.approx((0.75, 0.75)) and points[0.5] == pytest.approx((0.6, 0.75))
    assert curves.average_precision(counts).first().ap == pytest.approx(0.25 + 0.25 + 0.25 * 0.75)
    pr = {(round(r.recall, 6), round(r.precision, 6)) for r in curves.pr_curve(counts).collect()}
    assert pr == {(0.0, 1.0), (0.25, 1.0), (0.5, 1.0), (0.75, 0.75)}
    none = curves.score_counts(spark.createDataFrame([(0, 0.9)], "y int, s double"), [], F.col("y") == 1, F.col("s"))
    assert curves.optimal_f1(none).first().threshold == 0.0 and curves.average_precision(none).first().ap == 0.0


@pytest.mark.parametrize(
    "points,expected",
    [([(1.0, 0.5), (0.5, 1.0)], 0.75), ([(1.0, 0.2), (0.2, 0.4), (0.6, 0.6)], 0.2 + 0.4 * 0.6), ([(1.0, 1.0)], 1.0), ([(0.0, 0.0)], 0.0)],
)
def test__average_precision_of_points(spark, points, expected):
    df = spark.createDataFrame([(1, p, r) for p, r in points], "g int, precision double, recall double")
    assert curves.average_precision_of(df, ["g"]).first().ap == pytest.approx(expected)


def test__roc_drops_collinear_points(spark):
    data = [(1, 0.9), (1, 0.8), (0, 0.7), (0, 0.6), (1, 0.5), (0, 0.4)]
    counts = curves.score_counts(spark.createDataFrame(data, "y int, s double"), [], F.col("y") == 1, F.col("s"))
    got = sorted((round(r.fpr, 4), round(r.tpr, 4)) for r in curves.roc_curve(counts).collect())
    assert got == [(0.0, 0.0), (0.0, 0.6667), (0.6667, 0.6667), (0.6667, 1.0), (1.0, 1.0)]
    assert curves.auc_roc(counts).first().auc == pytest.approx(7 / 9)


def test__group_of_and_filter(spark):
    g = spark.createDataFrame([(0, 0, "A", 0.0, 0.0, 10.0, 10.0, True)], GT.replace("is_ignored", "is_group"))
    i = spark.createDataFrame([(0, k, "A", 0.0, 0.0, 10.0 - k, 10.0, 0.9 - k / 10) for k in range(3)] + [(0, 9, "B", 0.0, 0.0, 1.0, 1.0, 0.9)], INF)
    m = detection.group_of_match(detection.with_boxes(g), detection.with_boxes(i))
    assert sorted(r.kind for r in m.select("kind").collect()) == ["ignored", "ignored", "matched"]
    assert detection.filter_inferences(i, 0).count() == 4 and detection.filter_inferences(i, 0.85, ["A"]).count() == 1


def test__giant_and_tiny_objects_do_not_crowd_a_tile(spark):
    """Tiny boxes meet in tiles of their own size, whatever else the table holds, and no overlap is lost."""
    from pyspark.sql import functions as F

    from sparkeval.operators import matching

    tiny = [("crowd", k, float(k % 40), float(k // 40), 0.9) for k in range(1600)]
    giant = [("other", k, 10.0 * k, 5.0, 1000.0) for k in range(50)] + [("crowd", 9000, -5.0, -5.0, 300.0)]
    box = F.struct(F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("s")).alias("x2"), (F.col("y") + F.col("s")).alias("y2"))
    rows = spark.createDataFrame(tiny + giant, "image_id string, k int, x double, y double, s double").withColumn("geom", box)
    shifted = rows.withColumn("x", F.col("x") + 0.5).withColumn("geom", box)
    got = matching.overlapping(rows, shifted, ["image_id"]).select("image_id", "a.k", F.col("b.k").alias("j")).collect()
    objects = tiny + giant
    want = sorted(
        (i, k, j) for i, k, x, y, s in objects for h, j, u, v, t in objects
        if i == h and max(x, u + 0.5) < min(x + s, u + 0.5 + t) and max(y, v) < min(y + s, v + t)
    )
    assert sorted(map(tuple, got)) == want
    sized = matching._sized(rows, False)
    own = matching._tiled(sized, F.array(F.struct(F.col("_class").alias("grid"), F.lit(True).alias("of_a"))))
    assert own.where("image_id = 'crowd'").groupBy("_role", "_tx", "_ty").count().agg(F.max("count")).first()[0] <= 16


@pytest.mark.parametrize("kw", [{}, {"within": ["label"]}, {"tie": ["label"]}, {"iou_threshold": 0.0}, {"strict": True, "within": ["label"]}])
def test__listed_and_tiled_images_match_alike(spark, monkeypatch, kw):
    rng = random.Random(5)
    box = lambda: (x := rng.randint(0, 12), y := rng.randint(0, 12), x + rng.randint(1, 8), y + rng.randint(1, 8))
    label = lambda: rng.choice(["a", "b", None])
    gts = [(i, j, label(), rng.random() < 0.2, *map(float, box())) for i in range(12) for j in range(rng.randint(0, 9))]
    infs = [(i, j, label(), rng.randint(0, 3) / 4, *map(float, box())) for i in range(12) for j in range(rng.randint(0, 9))]
    corners = "x1 double, y1 double, x2 double, y2 double"
    g = detection.with_boxes(spark.createDataFrame(gts, f"image_id long, gt_idx long, label string, is_ignored boolean, {corners}"))
    i = detection.with_boxes(spark.createDataFrame(infs, f"image_id long, inf_idx long, label string, score double, {corners}"))
    rows = []
    for crowd in (512, 8, 0):  # all images listed, some, none
        monkeypatch.setattr(matching, "CROWD", crowd)
        m = matching.match(g, i, **{"iou_threshold": 0.3, **kw})
        rows.append(sorted(map(repr, m.select("image_id", "kind", "gt", "inf", F.round("iou", 9).alias("iou")).collect())))
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 50


def test__small_images_take_one_exchange(spark):
    corners = "x1 double, y1 double, x2 double, y2 double"
    g = detection.with_boxes(spark.createDataFrame([(1, 1, "a", False, 0.0, 0.0, 4.0, 4.0)], f"image_id long, gt_idx long, label string, is_ignored boolean, {corners}"))
    i = detection.with_boxes(spark.createDataFrame([(1, 1, "a", 0.5, 0.0, 0.0, 4.0, 4.0)], f"image_id long, inf_idx long, label string, score double, {corners}"))
    plan = matching.match(g, i, 0.5, ["label"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test__tasks_of_listed_images_follow_the_rows(spark, monkeypatch):
    g, i = frames(spark, *scene(5, images=40))
    tasks = lambda m: m.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.count("*"), F.max("n")).first()
    few = matching.match(g, i, 0.5, ["label"])
    monkeypatch.setattr(matching, "TASK_ROWS", 60)
    many = matching.match(g, i, 0.5, ["label"])
    assert tasks(many)[0] > 4 and tasks(many)[1] < 60 * 5 < tasks(few)[1]
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))


def test__convex_overlaps_equal_slabs():
    import numpy as np

    from sparkeval.operators import polygons

    r = np.random.default_rng(3)
    n = 4000
    x, y, w, h = (r.integers(0, 9, n), r.integers(0, 9, n), r.integers(1, 9, n), r.integers(1, 9, n))
    box = np.stack([np.stack(p, 1) for p in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))], 1).astype(float)
    diamond = np.stack([np.stack(p, 1) for p in ((x, y - h), (x + w, y), (x, y + h), (x - w, y))], 1) / 2
    free = r.random((n, 4, 2))  # crossed and dented rings stay with the slabs, as edges that nearly lie on each other do
    shifted = diamond + 0.1
    for a, b in ((box, box[::-1]), (diamond, diamond[::-1]), (box[:, ::-1], diamond[::-1]), (diamond, shifted), (free, free[::-1])):
        want = polygons.small_ring_ious(a, b)
        got, sure = polygons.convex_ring_ious(a, b)
        assert np.abs(got - want)[sure].max() < 1e-12
        assert sure.all() or a is free or b is shifted


RING = "array<struct<x: double, y: double>>"


def rings(spark, seed, images, most):
    """Ground truths and inferences as rings of 3 to 6 points, some dented, crossed, missing or equal."""
    r = random.Random(seed)

    def ring():
        if r.random() < 0.05:
            return None
        x, y = r.randint(0, 12), r.randint(0, 12)
        return [(float(x + r.randint(0, 8)), float(y + r.randint(0, 8))) for _ in range(r.randint(3, 6))]

    gts, infs = [], []
    for image in range(images):
        drawn = [ring() for _ in range(r.randint(1, most))]
        gts += [(image, i, r.choice("ab"), r.random() < 0.2, r.choice(drawn)) for i in range(r.randint(0, most))]
        infs += [(image, i, r.choice("ab"), round(r.random(), 1), r.choice(drawn) if r.random() < 0.5 else ring()) for i in range(r.randint(0, most))]
    return (
        spark.createDataFrame(gts, f"image_id long, gt_idx long, label string, is_ignored boolean, geom {RING}"),
        spark.createDataFrame(infs, f"image_id long, inf_idx long, label string, score double, geom {RING}"),
    )


@pytest.mark.parametrize("threshold,strict,tie", [(0.3, False, []), (0.5, True, ["label"]), (0.0, False, [])])
def test__grouped_polygons_equal_tiles(spark, threshold, strict, tie):
    from sparkeval.operators import polygons

    g, i = rings(spark, 8, 40, 9)
    within = [] if tie else ["label"]
    kw = dict(strict=strict, tie=tie)
    found = [matching.match(g, i, threshold, within, overlaps=o, **kw) for o in (polygons.polygon_overlaps, lambda a, b: polygons.polygon_overlaps(a, b))]
    rows = [sorted(repr((r.image_id, r.kind, r.gt, r.inf, None if r.iou is None else round(r.iou, 9) + 0.0)) for r in m.collect()) for m in found]
    assert rows[0] == rows[1] and len(rows[0]) > 200


@pytest.mark.parametrize("threshold", [0.3, 0.0])
def test__polygons_without_index_or_image_match_nothing(spark, threshold):
    from sparkeval.operators import polygons

    g, i = rings(spark, 4, 20, 6)
    g = g.withColumn("gt_idx", F.expr("nullif(gt_idx, image_id % 7)")).withColumn("image_id", F.expr("if(image_id IN (5, 8, 11), NULL, image_id)"))
    i = i.withColumn("inf_idx", F.expr("nullif(inf_idx, image_id % 5)")).withColumn("image_id", F.expr("if(image_id IN (5, 8, 11), NULL, image_id)"))
    found = [matching.match(g, i, threshold, ["label"], overlaps=o) for o in (polygons.polygon_overlaps, lambda a, b: polygons.polygon_overlaps(a, b))]
    rows = [sorted(repr((r.image_id, r.kind, r.gt, r.inf, None if r.iou is None else round(r.iou, 9) + 0.0)) for r in m.collect()) for m in found]
    assert rows[0] == rows[1] and any("None, 'unmatched_gt'" in r for r in rows[0])


def test__small_images_of_polygons_take_one_exchange(spark, monkeypatch):
    from sparkeval.operators import polygons

    g, i = rings(spark, 2, 30, 6)
    few = matching.match(g, i, 0.5, ["label"], overlaps=polygons.polygon_overlaps)
    assert few._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(matching, "CROWD", 30)  # images with more points go through the tiles
    some = matching.match(g, i, 0.5, ["label"], overlaps=polygons.polygon_overlaps)
    assert some._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") > 1
    assert sorted(map(repr, few.select("image_id", "kind", "inf", F.round("iou", 9)).collect())) == sorted(map(repr, some.select("image_id", "kind", "inf", F.round("iou", 9)).collect()))


def test__written_tables_replace_their_shuffle_files(spark):
    import time

    from sparkeval.session import materialize

    def shuffle_files():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))

    before = shuffle_files()
    assert materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*")), "counts").count() == 7
    until = time.time() + 20
    while shuffle_files() > before + 2 and time.time() < until:  # the count above made an exchange of its own: a file and its index
        time.sleep(0.2)
    assert shuffle_files() <= before + 2
