"""The sweep against sums over elementary intervals, with one recording cut into many parts and slices."""

import random

import pytest

from sparkeval.operators import intervals
from sparkeval.operators.sweep import Sweep

SCHEMA = "recording string, speaker string, s double, e double"


def segments(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        s = rng.randint(0, 600) / 7
        rows.append((rng.choice(["long", "long", "long", "short", None]), rng.choice("ABC"), s, s + rng.choice([0, 1, 2, 5, 20]) / 7))
    return rows


def elementary(ref, hyp, recording):
    times = sorted({t for r, _, s, e in ref + hyp if r == recording for t in (s, e)})
    for s, e in zip(times, times[1:]):
        yield s, e, *[[k for r, k, x, y in side if r == recording and x <= s and e <= y] for side in (ref, hyp)]


def brute_runs(ref, hyp, recording, holds):
    out = []
    for s, e, a, b in elementary(ref, hyp, recording):
        if holds(len(a), len(b)):
            if out and out[-1][1] == s:
                out[-1] = (out[-1][0], e)
            else:
                out.append((s, e))
    return out


@pytest.fixture
def cut(spark):
    """Settings under which a few hundred rows make many parts."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("cells", [1 << 22, 12])
def test__totals_and_runs_equal_elementary_intervals(spark, cut, cells):
    ref, hyp = segments(1, 220), segments(2, 200)
    r, h = spark.createDataFrame(ref, SCHEMA), spark.createDataFrame(hyp, SCHEMA)
    lanes = Sweep(r, h, ["recording"], "speaker", cells=cells)
    assert lanes.changes.where("recording = 'long'").select("part").distinct().count() > 3
    got = {(x.recording, x.kind, x.ref, x.hyp): x.x for x in lanes.totals().collect()}
    want = {}
    for recording in ("long", "short", None):
        for s, e, a, b in elementary(ref, hyp, recording):
            for x in "ABC":
                for key, n in ((("length", x, None), x in a), (("length", None, x), x in b)):
                    want[recording, *key] = want.get((recording, *key), 0) + (e - s) * n
                for y in "ABC":
                    for kind, n in (("both", (x in a) * (y in b)), ("pairs", a.count(x) * b.count(y))):
                        want[recording, kind, x, y] = want.get((recording, kind, x, y), 0) + (e - s) * n
            n, m = len(set(a)), len(set(b))
            plain = {"ref_s": n, "hyp_s": m, "miss": max(n - m, 0), "false_alarm": max(m - n, 0), "shared": min(n, m)}
            plain |= {"speech_tp": bool(n and m), "speech_fp": bool(m and not n), "speech_fn": bool(n and not m), "speech_tn": not n and not m}
            for kind, x in plain.items():
                want[recording, kind, None, None] = want.get((recording, kind, None, None), 0) + (e - s) * x
    assert {k: pytest.approx(v) for k, v in want.items() if v} == {k: v for k, v in got.items() if v}
    found = Sweep(r, h, ["recording"], cells=cells).runs(open=lambda a, b: a + b > 0, missed=lambda a, b: (a > 0) & (b == 0)).collect()
    for recording in ("long", "short", None):
        for name, holds in (("open", lambda a, b: a + b > 0), ("missed", lambda a, b: a > 0 and b == 0)):
            assert sorted((x.s, x.e) for x in found if x.recording == recording and x.condition == name) == brute_runs(ref, hyp, recording, holds)


def test__sweep_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    point = spark.createDataFrame([("x", "A", 2.0, 2.0)], SCHEMA)
    assert intervals.merged(empty, ["recording"]).count() == 0 and intervals.merged(point, ["recording"]).count() == 0
    assert intervals.diarization_metrics(empty, empty, "recording", "speaker").count() == 0
    one = spark.createDataFrame([("x", "A", 2.0, 4.0)], SCHEMA)
    row = intervals.diarization_metrics(one, empty, "recording", "speaker").first()
    assert row.diarization_error_rate == 1 and row.jaccard_error_rate == 1 and row.detection_recall == 0
    assert [(r.s, r.e) for r in intervals.missed(one, empty, ["recording"]).collect()] == [(2.0, 4.0)]
