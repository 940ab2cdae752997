"""Matching at several difficulty levels at once, with objects that are neither to be found nor to be counted.

At each level a ground truth or inference is valid, ignored, or out of play. Ground truths choose in order: the free valid
inference of highest overlap above the class's threshold (ties: the first), else the first free ignored one. A choice between
valid objects is a match; any other takes the inference away without counting it. What is valid and left over counts as
missed or false. Pairs are formed once for all levels, in shared tiles, and only those above the threshold are kept; the
choices then depend on each other only within the pairs of one image and class, which are one row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.functions import boxes
from sparkeval.operators.matching import overlapping
from sparkeval.operators.vision import DIFFICULTY

VALID, IGNORED, OUT = 0, 1, -1
LEVELS = ("easy", "moderate", "hard")


def difficulty_states(height: Column, occlusion: Column, truncation: Column, dont_care: Column, levels: Sequence[str] = LEVELS) -> Column:
    """A ground truth's state per level: ignored if it is harder than the level, or of a kind that never counts."""

    def state(level: str) -> Column:
        h, o, t = DIFFICULTY[level]
        fits = (height >= h) & (occlusion <= o) & (truncation <= t) & ~dont_care
        return F.when(fits, VALID).otherwise(IGNORED)

    return F.array(*[state(level) for level in levels])


def inference_states(height: Column, levels: Sequence[str] = LEVELS, counted: Column | None = None) -> Column:
    """An inference's state per level: ignored if it is too small for the level, out of play where ``counted`` is not true."""
    states = [F.when(height < DIFFICULTY[level][0], IGNORED).otherwise(VALID) for level in levels]
    return F.array(*[s if counted is None else F.when(counted, s) for s in states])


def box3d_overlaps(gts: DataFrame, infs: DataFrame) -> DataFrame:
    """(image_id, cls, a, b, iou) for overlapping axis-aligned 3D boxes."""
    pairs = overlapping(gts, infs, ["image_id", "cls"])
    return pairs.withColumn("iou", boxes.box3d_iou(F.col("a.geom"), F.col("b.geom")))


_TAKEN = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("level", "pair", "counted")]))


def choose(pairs: Sequence[tuple[int, int, float, Sequence, Sequence]], levels: int) -> list[tuple[int, int, int]]:
    """(level, pair, counted) of every choice; a pair holds the places of its two objects, the overlap, and their states."""
    out = []
    for level in range(levels):
        offers: dict[int, list] = {}
        for at, (g, i, iou, gs, ins) in enumerate(pairs):
            if gs[level] != OUT and ins[level] != OUT:
                offers.setdefault(g, []).append((ins[level], -iou if ins[level] == VALID else 0.0, i, at, gs[level]))
        used: set[int] = set()
        for g in sorted(offers):
            free = [o for o in offers[g] if o[2] not in used]
            if free:
                state, _, i, at, wanted = min(free)
                used.add(i)
                out.append((level, at, int(state == VALID and wanted == VALID)))
    return out


def match_levels(
    gts: DataFrame,
    infs: DataFrame,
    min_overlap: Mapping[str, float],
    levels: Sequence[str] = LEVELS,
    overlaps: Callable[[DataFrame, DataFrame], DataFrame] = box3d_overlaps,
) -> DataFrame:
    """(image_id, cls, level, kind, gt_idx, inf_idx, iou): matched, absorbed, missed and false objects per level.

    ``gts`` hold image_id, gt_idx, cls, geom and states, ``infs`` image_id, inf_idx, cls, geom and states, where states is an
    array with VALID, IGNORED or null for each level; indexes are unique within an image and class and give the order.
    Overlap must lie above the class's threshold; classes without one are not evaluated.
    """
    threshold = F.lit(None).cast("double")
    for cls, least in min_overlap.items():
        threshold = F.when(F.col("cls") == cls, F.lit(float(least))).otherwise(threshold)
    gts, infs = (d.where(F.col("cls").isin(list(min_overlap))) for d in (gts, infs))
    pairs = overlaps(gts.select("image_id", "cls", "gt_idx", "geom", "states"), infs.select("image_id", "cls", "inf_idx", "geom", "states"))
    near = pairs.where(F.col("iou") > threshold)
    known = lambda c: F.transform(c, lambda x: F.coalesce(x, F.lit(OUT)))
    row = F.struct(F.col("a.gt_idx").alias("g"), F.col("b.inf_idx").alias("i"), "iou", known("a.states").alias("gs"), known("b.states").alias("ins"))
    grouped = near.groupBy("image_id", "cls").agg(F.array_sort(F.collect_list(row)).alias("pairs"))
    count = len(levels)

    @F.pandas_udf(_TAKEN)
    def chosen(column: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("level", "pair", "counted"), c)) for c in choose([(p["g"], p["i"], p["iou"], p["gs"], p["ins"]) for p in row], count)] for row in column])

    taken = grouped.withColumn("c", F.explode(chosen("pairs"))).withColumn("p", F.get("pairs", F.col("c.pair")))
    taken = taken.select(
        "image_id", "cls", F.col("c.level").alias("level"), F.when(F.col("c.counted") == 1, "matched").otherwise("absorbed").alias("kind"),
        F.col("p.g").alias("gt_idx"), F.col("p.i").alias("inf_idx"), F.col("p.iou").alias("iou"),
    )

    def left(objects: DataFrame, idx: str) -> DataFrame:
        """Valid objects per level."""
        return objects.select("image_id", "cls", idx, F.posexplode("states").alias("level", "state")).where(F.col("state") == VALID).drop("state")

    # Choices, and valid objects of both sides, meet by object; one without a choice is left over.
    by_gt = left(gts, "gt_idx").join(taken.select("image_id", "cls", "level", "gt_idx"), ["image_id", "cls", "level", "gt_idx"], "left_anti")
    by_inf = left(infs, "inf_idx").join(taken.select("image_id", "cls", "level", "inf_idx"), ["image_id", "cls", "level", "inf_idx"], "left_anti")
    parts = [taken, by_gt.withColumn("kind", F.lit("missed")), by_inf.withColumn("kind", F.lit("false"))]
    out = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return out.withColumn("level", F.get(F.array(*map(F.lit, levels)), F.col("level")))


def level_counts(matches: DataFrame, gts: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """(cls, level, valid, ignored, matched, absorbed, missed, false) over all images."""
    kinds = ("matched", "absorbed", "missed", "false")
    found = matches.groupBy("cls", "level").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    state = gts.select("cls", F.posexplode("states").alias("at", "state"))
    held = state.groupBy("cls", F.get(F.array(*map(F.lit, levels)), F.col("at")).alias("level")).agg(
        F.count_if(F.col("state") == VALID).alias("valid"), F.count_if(F.col("state") == IGNORED).alias("ignored")
    )
    return held.join(found, ["cls", "level"], "full").fillna(0, ["valid", "ignored", *kinds])
