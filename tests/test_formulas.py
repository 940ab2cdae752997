import math

import pytest
from pyspark.sql import functions as F

from sparkeval.functions import boxes, ratios
from sparkeval.functions.search import cuts_below
from sparkeval.operators import standard, strata


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("tp,fp,expected", [(0, 0, 0.0), (10, 0, 1.0), (0, 10, 0.0), (5, 5, 0.5), (math.nan, 10, 0.0), (10, math.nan, 0.0)])
def test__precision(spark, tp, fp, expected):
    assert one(spark, v=ratios.precision(F.lit(float(tp)), F.lit(float(fp)))).v == expected


def test__formulas(spark):
    tp, fp, fn, tn = (F.lit(x) for x in (6, 2, 3, 9))
    r = one(spark, f1=ratios.f1_score(tp, fp, fn), acc=ratios.accuracy(tp, fp, fn, tn), fpr=ratios.false_positive_rate(fp, tn), sp=ratios.specificity(fp, tn), f2=ratios.f_beta(tp, fp, fn, 2))
    assert r.f1 == pytest.approx(12 / 17) and r.acc == 0.75 and r.fpr == pytest.approx(2 / 11) and r.sp == pytest.approx(9 / 11)
    assert r.f2 == pytest.approx(5 * 0.75 * (2 / 3) / (4 * 0.75 + 2 / 3))


@pytest.mark.parametrize(
    "a,b,expected",
    [
        ((0, 0, 10, 10), (0, 0, 10, 10), 1.0), ((0, 0, 10, 10), (10, 0, 20, 10), 0.0), ((0, 0, 10, 10), (5, 0, 15, 10), 1 / 3),
        ((0, 0, 10, 10), (20, 20, 30, 30), 0.0), ((0, 0, 0, 0), (0, 0, 0, 0), 0.0), ((0, 0, 4, 4), (1, 1, 3, 3), 0.25),
    ],
)
def test__box_iou(spark, a, b, expected):
    box = lambda v: F.struct(*[F.lit(float(x)).alias(n) for x, n in zip(v, ("x1", "y1", "x2", "y2"))])
    assert one(spark, v=boxes.box_iou(box(a), box(b))).v == pytest.approx(expected)


def test__aspect_ratio_of_flat_box(spark):
    b = boxes.box(F.lit(0), F.lit(1), F.lit(5), F.lit(1))
    assert one(spark, v=boxes.aspect_ratio(b)).v == 0.0


def test__margin_of_error(spark):
    r = one(spark, a=standard.margin_of_error(F.lit(100)), b=standard.margin_of_error(F.lit(0)), c=standard.margin_of_error(F.lit(1000), 0.99))
    assert r.a == pytest.approx(9.7998, abs=1e-3) and r.b == 0.0 and r.c == pytest.approx(4.0729, abs=1e-3)


@pytest.mark.parametrize("a,b,limit,expected", [(0.6, 0.5, 0.9, 10.0), (60.0, 50.0, 90.0, 10.0), (1500.0, 1000.0, 2000.0, 25.0), (0.0, 0.0, 0.0, 0.0), (2.0, 1.0, -1.0, 50.0)])
def test__delta_percentage(spark, a, b, limit, expected):
    assert one(spark, v=standard.delta_percentage(F.lit(a), F.lit(b), F.lit(limit))).v == pytest.approx(expected)


def test__ordinals(spark):
    got = [r.o for r in spark.createDataFrame([(n,) for n in (1, 2, 3, 4, 11, 12, 13, 21, 111, 122)], "n int").select(strata.ordinal(F.col("n")).alias("o")).collect()]
    assert got == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "111th", "122nd"]


def test__bins(spark):
    df = spark.createDataFrame([(v,) for v in (-0.1, 0.0, 0.1, 0.5, 0.75, 1.0, 1.1, None)], "v double")
    rows = df.select("v", strata.bin_by_edges("v", [0, 0.5, 1]).alias("b"), strata.bin_even(F.col("v"), F.lit(0.0), F.lit(1.0), 10).alias("e")).collect()
    assert [r.b for r in rows] == [None, 0, 0, 1, 1, 1, None, None]
    assert [r.e for r in rows] == [None, 0, 1, 5, 7, 9, None, None]
    single = df.select(strata.bin_by_edges("v", [0.5, 0.5]).alias("b")).collect()
    assert [r.b for r in single] == [None, None, None, 0, None, None, None, None]
    with pytest.raises(ValueError):
        strata.check_edges([0, 2, 1])


@pytest.mark.parametrize("values,expected", [([], None), ([-0.1, 0.5], None), ([0.5, 1.1], None), ([0.0, 1.0], (0.0, 1.0, 50)), ([0.41, 0.43], (0.4, 0.44, 2)), ([0.3], (0.3, 0.32, 1))])
def test__score_range(spark, values, expected):
    row = strata.score_range(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    assert (row is None) == (expected is None)
    if row:
        assert (row.lo, row.hi) == pytest.approx(expected[:2]) and row.bins == expected[2]


def test__cuts_below(spark):
    cuts = [0.1 * i for i in range(13)]
    df = spark.createDataFrame([(0.05 * i,) for i in range(-2, 30)], "v double")
    rows = df.select("v", cuts_below("v", cuts).alias("le"), cuts_below("v", cuts, False).alias("lt")).collect()
    for r in rows:
        assert r.le == sum(c <= r.v for c in cuts) and r.lt == sum(c < r.v for c in cuts)


def test__rounding_matches_sql(spark):
    import duckdb

    ties = [(57 / 1600, 5), (0.035625, 5), (1 / 64, 5), (0.0000125, 6), (0.1234565, 6), (-0.1234565, 6), (2.5, 0), (1.0000005, 6), (123456.7890625, 6)]
    want = [duckdb.connect().execute(f"SELECT round({x!r}::DOUBLE, {n})").fetchone()[0] for x, n in ties]
    got = one(spark, **{f"v{i}": ratios.rounded(F.lit(x), n) for i, (x, n) in enumerate(ties)})
    assert [got[f"v{i}"] for i in range(len(ties))] == want
