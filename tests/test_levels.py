"""Matching by difficulty level against one ground truth after the other."""

import random

from sparkeval.operators import levels

FIELDS = "image_id long, {0}_idx long, cls string, geom struct<x1:double,y1:double,x2:double,y2:double,z1:double,z2:double>, states array<int>"


def iou(a, b):
    inter = 1.0
    for k in range(3):
        low, high = (0, 1, 4)[k], (2, 3, 5)[k]
        inter *= max(0.0, min(a[high], b[high]) - max(a[low], b[low]))
    size = lambda x: (x[2] - x[0]) * (x[3] - x[1]) * (x[5] - x[4])
    return inter / (size(a) + size(b) - inter) if inter else 0.0


def one_by_one(gts, infs, level, least):
    taken, out = set(), []
    for image, g, cls, box, states in sorted(gts):
        if states[level] is None:
            continue
        best, best_iou, ignored = None, 0.0, None
        for im, i, c, other, s in sorted(infs):
            if im != image or c != cls or s[level] is None or (im, c, i) in taken or iou(box, other) <= least[cls]:
                continue
            if s[level] == levels.VALID and iou(box, other) > best_iou:
                best, best_iou = i, iou(box, other)
            elif s[level] == levels.IGNORED and ignored is None:
                ignored = i
        pick = best if best is not None else ignored
        if pick is None:
            out += [("missed", image, cls, g, None)] if states[level] == levels.VALID else []
            continue
        taken.add((image, cls, pick))
        out.append(("matched" if best is not None and states[level] == levels.VALID else "absorbed", image, cls, g, pick))
    return out + [("false", im, c, None, i) for im, i, c, _, s in infs if s[level] == levels.VALID and (im, c, i) not in taken]


def test__levels_equal_one_ground_truth_after_the_other(spark):
    rng = random.Random(4)

    def objects(n):
        rows = []
        for k in range(n):
            x, y = rng.choice([0, 1, 2, 30]), rng.choice([0, 1, 2])
            box = (float(x), float(y), x + rng.choice([8.0, 9.0]), y + rng.choice([8.0, 9.0]), 0.0, rng.choice([2.0, 2.5]))
            rows.append((rng.randrange(6), k, rng.choice(["Car", "Cyclist", "Tram"]), box, [rng.choice([0, 0, 1, None]) for _ in range(3)]))
        return rows

    gts, infs = objects(70), objects(80)
    g, i = spark.createDataFrame(gts, FIELDS.format("gt")), spark.createDataFrame(infs, FIELDS.format("inf"))
    least = {"Car": 0.7, "Cyclist": 0.5}
    got = levels.match_levels(g, i, least).collect()
    for at, name in enumerate(levels.LEVELS):
        want = one_by_one([x for x in gts if x[2] in least], [x for x in infs if x[2] in least], at, least)
        assert sorted(((r.kind, r.image_id, r.cls, r.gt_idx, r.inf_idx) for r in got if r.level == name), key=str) == sorted(want, key=str)
    assert {r.kind for r in got} == {"matched", "absorbed", "missed", "false"}
    assert levels.match_levels(g.limit(0), i, least).where("kind <> 'false'").count() == 0 and levels.match_levels(g.limit(0), i.limit(0), least).count() == 0
