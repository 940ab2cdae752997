"""Matching of inferences to ground truths within an image.

Inputs are one row per object: ground truths ``(image_id, gt_idx, geom, is_ignored, ...)`` and
inferences ``(image_id, inf_idx, geom, score, ...)``, where ``geom`` is a box struct or a ring of
points. An inference's candidate is the ground truth of highest overlap at or above the threshold,
taken or not, so there is no sequential dependence: two aggregates decide everything.

Boxes of an image with up to ``CROWD`` objects are dealt out once, by image, and matched with windows that need no further
exchange; polygons of an image with up to as many points likewise, a row for each of its groups. Crowded images, and shapes
without an entry in ``GROUPED``, go through the tiles of ``overlapping``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions import boxes
from sparkeval.session import materialize

SIZE_STEP = 8  # objects whose larger side lies between two powers of this are of one size class
TILE_SCALE = 2.0  # tile side of a class over its largest object side
CROWD = 512  # most objects (points, of shapes in ``GROUPED``) of an image whose ground truths are compared as one list
TASK_ROWS = 200_000  # objects (points) a task sorts in ``_dealt``, so that it needs no disk however large the table

#: Shapes compared in Python: the overlaps of each of a list of geometries with each of another, and for how many points one counts.
GROUPED: dict[Callable, tuple[Callable[[Column, Column], Column], Callable[[Column], Column]]] = {}


def _group(cols: Sequence[str]) -> Column:
    """Fields that must agree, packed so that nulls compare equal."""
    return F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(1).alias("all"))


def _sized(df: DataFrame, polygon: bool) -> DataFrame:
    """Add the extent and the size class of every object."""
    df = df.select("*", *[c.alias(f"_{n}") for n, c in boxes.extent(F.col("geom"), polygon).items()])
    side = F.greatest(F.abs(F.col("_x2") - F.col("_x1")), F.abs(F.col("_y2") - F.col("_y1")))
    return df.withColumn("_class", F.when(side > 0, F.ceil(F.log(side) / F.log(F.lit(float(SIZE_STEP))))).otherwise(0).cast("int"))


def _tiled(df: DataFrame, roles: Column) -> DataFrame:
    """One row per role and grid tile an object's extent touches; a role is a grid (of a class) and a side."""
    df = df.withColumn("_role", F.explode(roles)).withColumn("_side", TILE_SCALE * F.pow(F.lit(float(SIZE_STEP)), F.col("_role.grid")))
    for axis in "xy":
        lo, hi = (F.floor(F.col(f"_{axis}{i}") / F.col("_side")) for i in "12")
        df = df.withColumn(f"_t{axis}", F.explode(F.sequence(F.least(lo, hi), F.greatest(lo, hi))))
    return df


def overlapping(
    a: DataFrame, b: DataFrame, keys: Sequence[str], polygon: bool = False
) -> DataFrame:
    """Pairs of rows of ``a`` and ``b`` that agree on ``keys`` and whose extents overlap.

    Objects meet only inside a shared tile, and each pair is reported by the one tile that holds the corner of its common
    area, so a crowded image is spread over its tiles and no pair comes twice. Every size class has a grid of its own: a pair
    meets in the grid of its larger object (of ``a`` if both are of one class), so small objects never share a tile made for
    large ones with each other. The result has the columns of both sides as structs ``a`` and ``b``.
    """
    left, right = _sized(a, polygon), _sized(b, polygon)
    in_a, in_b = (side.agg(F.collect_set("_class")).scalar() for side in (left, right))  # a few classes

    def role(grid: Column, of_a: bool) -> Column:
        return F.struct(grid.alias("grid"), F.lit(of_a).alias("of_a"))

    def larger(classes: str, of_a: bool) -> Column:
        return F.transform(F.filter(F.col(classes), lambda c: c > F.col("_class")), lambda c: role(c, of_a))

    own = F.col("_class")
    left = left.withColumn("_all", in_b)
    right = right.withColumn("_all", in_a)
    # In grids of a: an object of a in its own, those of b in their own and in all larger ones; in grids of b, the others.
    left = _tiled(left, F.concat(F.array(role(own, True)), larger("_all", False))).drop("_all")
    meets_smaller = F.when(F.exists("_all", lambda c: c < own), F.array(role(own, True), role(own, False))).otherwise(F.array(role(own, True)))
    right = _tiled(right, F.concat(meets_smaller, larger("_all", True))).drop("_all")
    on = [*keys, "_role", "_tx", "_ty"]
    packed = ["_x1", "_y1", "_x2", "_y2"]
    left = left.select(*on, "_side", F.struct(*a.columns).alias("a"), F.struct(*packed).alias("ea"))
    right = right.select(*on, F.struct(*b.columns).alias("b"), F.struct(*packed).alias("eb"))
    pairs = left.join(right, on)
    for axis in "xy":
        start = F.greatest(F.col(f"ea._{axis}1"), F.col(f"eb._{axis}1"))
        end = F.least(F.col(f"ea._{axis}2"), F.col(f"eb._{axis}2"))
        pairs = pairs.where((start < end) & (F.floor(start / F.col("_side")) == F.col(f"_t{axis}")))
    return pairs.select(*keys, "a", "b")


def box_overlaps(gts: DataFrame, infs: DataFrame) -> DataFrame:
    """(image_id, grp, a, b, iou) for distinct overlapping boxes."""
    pairs = overlapping(gts, infs, ["image_id", "grp"])
    return pairs.withColumn("iou", boxes.box_iou(F.col("a.geom"), F.col("b.geom")))


def match(
    gts: DataFrame,
    infs: DataFrame,
    iou_threshold: float = 0.5,
    within: Sequence[str] = (),
    strict: bool = False,
    tie: Sequence[str] = (),
    overlaps: Callable[[DataFrame, DataFrame], DataFrame] = box_overlaps,
) -> DataFrame:
    """Long table of ``kind`` in matched / unmatched_gt / unmatched_inf / ignored with the objects as structs.

    ``within`` are fields equal on both sides (labels, required fields); ``tie`` orders objects before
    their index; ``strict`` asks for overlap above, not at, the threshold. Ground truths of one geometry
    are collapsed before pairs are formed (only the first of them can ever be a candidate), so copies
    on both sides cost one pair per inference.
    """
    gts = gts.withColumn("grp", _group(within))
    infs = infs.withColumn("grp", _group(within))
    if overlaps is not box_overlaps and overlaps not in GROUPED:
        return _match_tiled(gts, infs, iou_threshold, strict, tie, overlaps)
    ious, points = GROUPED.get(overlaps, (None, lambda _: F.lit(1)))

    def weighed(df: DataFrame, index: str) -> DataFrame:
        odd = F.col(index).isNull() if ious else F.lit(False)  # the joins of the tiles let a missing index match nothing
        return df.select("image_id", points(F.col("geom")).alias("n"), odd.alias("odd"))

    sizes = weighed(gts, "gt_idx").unionAll(weighed(infs, "inf_idx")).groupBy("image_id").agg(F.sum("n").alias("n"), F.max("odd").alias("odd"))
    apart = F.col("odd") | (F.col("n") > CROWD)
    rows, any_apart = sizes.agg(F.sum("n"), F.max(apart)).first()
    tasks = -(-(rows or 0) // TASK_ROWS)

    def together(gts: DataFrame, infs: DataFrame) -> DataFrame:
        rows = _dealt(gts, infs, within, tie, tasks)
        return _match_grouped(rows, iou_threshold, strict, tie, ious) if ious else _match_listed(rows, iou_threshold, strict, tie)

    if not any_apart:
        return together(gts, infs)
    crowded = materialize(sizes.where(apart).select("image_id"), "crowded-images")
    few = (df.join(crowded, "image_id", "left_anti") for df in (gts, infs))
    many = (df.join(crowded, "image_id", "left_semi") for df in (gts, infs))
    return together(*few).unionByName(_match_tiled(*many, iou_threshold, strict, tie, overlaps))


def _dealt(gts: DataFrame, infs: DataFrame, within: Sequence[str], tie: Sequence[str], tasks: int) -> DataFrame:
    """(image_id, gt, inf, grp, rank) of every object, dealt out by image into at least ``tasks``; ``rank`` orders ground truths."""
    gt, inf = (F.struct(*[F.col(c) for c in df.columns if c != "grp"]) for df in (gts, infs))
    rows = gts.select("image_id", gt.alias("gt")).unionByName(infs.select("image_id", inf.alias("inf")), allowMissingColumns=True)
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Everything else of a row follows from the object. A number is given beyond one task only: Spark does not merge these parts.
    rows = rows.repartition(max(tasks, least), "image_id") if tasks > 1 else rows.repartition("image_id")
    own = lambda c: F.when(F.col("gt").isNotNull(), F.col(f"gt.{c}")).otherwise(F.col(f"inf.{c}")).alias(c)
    grp = F.struct(*[own(c) for c in within]) if within else _group(())
    rank = F.struct(F.col("gt.is_ignored").alias("late"), *[F.col(f"gt.{c}") for c in tie], F.col("gt.gt_idx"))
    return rows.select("*", grp.alias("grp"), F.when(F.col("gt").isNotNull(), rank).alias("rank"))


def _match_listed(rows: DataFrame, iou_threshold: float, strict: bool, tie: Sequence[str]) -> DataFrame:
    """``match`` of the dealt boxes of images with few objects: every inference beside the list of its ground truths."""
    listed = F.when(F.col("gt").isNotNull(), F.struct("rank", "gt"))
    rows = rows.withColumn("near_by", F.collect_list(listed).over(W.partitionBy("image_id", "grp")))
    a, b = (lambda g: g["gt"]["geom"]), F.col("inf.geom")

    def meets(g: Column) -> Column:
        return (F.greatest(a(g)["x1"], b["x1"]) < F.least(a(g)["x2"], b["x2"])) & (F.greatest(a(g)["y1"], b["y1"]) < F.least(a(g)["y2"], b["y2"]))

    overlap = F.transform("near_by", lambda g, i: F.struct((-F.when(meets(g), boxes.box_iou(a(g), b))).alias("neg"), g["rank"].alias("rank"), i.alias("i")))
    rows = rows.withColumn("overlaps", F.when(F.col("inf").isNotNull(), F.filter(overlap, lambda o: o["neg"].isNotNull())))
    passed = (lambda o: -o["neg"] > iou_threshold) if strict else (lambda o: -o["neg"] >= iou_threshold)
    best = F.array_min(F.filter("overlaps", passed))
    if iou_threshold < 0 or (iou_threshold == 0 and not strict):
        # Without a positive threshold an object of no overlap is a candidate too: the first of the group.
        every = F.transform("near_by", lambda g, i: F.struct(F.lit(0.0).alias("neg"), g["rank"].alias("rank"), i.alias("i")))
        best = F.coalesce(best, F.when(F.col("inf").isNotNull(), F.array_min(every)))
    near = F.array_max(F.transform(F.filter("overlaps", lambda o: ~o["rank"]["late"]), lambda o: -o["neg"]))
    rows = rows.select("image_id", "grp", "rank", "gt", "inf", best.alias("best"), F.coalesce(near, F.lit(0.0)).alias("near"), F.get("near_by", best["i"])["gt"].alias("candidate"))
    order = F.struct((-F.col("inf.score")).alias("neg"), *[F.col(f"inf.{c}").alias(f"_{c}") for c in tie], F.col("inf.inf_idx").alias("inf_idx"))
    rows = rows.select("*", F.coalesce("rank", "best.rank").alias("spot"), F.when(F.col("best").isNotNull() & ~F.col("best.rank.late"), order).alias("claim"))
    winner = F.min("claim").over(W.partitionBy("image_id", "grp", "spot"))  # ground truths without claim, and inferences without candidate, have none
    rows = rows.withColumn("winner", winner)
    taken, late = F.col("claim").isNotNull() & (F.col("claim") == F.col("winner")), F.coalesce(F.col("best.rank.late"), F.lit(False))
    kind = F.when(F.col("inf").isNull(), "unmatched_gt").when(taken, "matched").when(late, "ignored").otherwise("unmatched_inf")
    iou = F.when(F.col("inf").isNotNull(), F.when(taken | late, -F.col("best.neg")).otherwise(F.col("near")))
    shown = F.when(F.col("inf").isNull(), F.col("gt")).when(taken, F.col("candidate"))
    kept = rows.where("inf IS NOT NULL OR (NOT rank.late AND winner IS NULL)")
    return kept.select("image_id", kind.alias("kind"), shown.alias("gt"), "inf", iou.alias("iou"))


def _match_grouped(rows: DataFrame, iou_threshold: float, strict: bool, tie: Sequence[str], ious: Callable[[Column, Column], Column]) -> DataFrame:
    """``match`` of dealt objects of images with few points: a group of an image is one row, since what Python returns is no longer dealt by image."""
    known = F.col("image_id").isNotNull()  # objects without an image meet none
    listed = F.collect_list(F.when(F.col("gt").isNotNull(), F.struct("rank", "gt")))
    groups = rows.groupBy("image_id", "grp").agg(listed.alias("gts"), F.collect_list("inf").alias("infs"))
    groups = groups.withColumn("ious", ious(F.transform("gts", lambda g: g["gt"]["geom"]), F.transform("infs", lambda x: x["geom"])))

    def overlaps(j: Column) -> Column:
        at = lambda i: F.get("ious", j * F.size("gts") + i)
        every = F.transform("gts", lambda g, i: F.struct((-F.when(at(i) >= 0, at(i))).alias("neg"), g["rank"].alias("rank"), i.alias("i")))
        return F.when(known, F.filter(every, lambda o: o["neg"].isNotNull()))

    def candidate(x: Column) -> Column:
        best = F.array_min(F.filter(x["overlaps"], (lambda o: -o["neg"] > iou_threshold) if strict else (lambda o: -o["neg"] >= iou_threshold)))
        if iou_threshold < 0 or (iou_threshold == 0 and not strict):
            # Without a positive threshold an object of no overlap is a candidate too: the first of the group.
            best = F.coalesce(best, F.when(known, F.array_min(F.transform("gts", lambda g, i: F.struct(F.lit(0.0).alias("neg"), g["rank"].alias("rank"), i.alias("i"))))))
        near = F.array_max(F.transform(F.filter(x["overlaps"], lambda o: ~o["rank"]["late"]), lambda o: -o["neg"]))
        return F.struct(x["inf"].alias("inf"), best.alias("best"), F.coalesce(near, F.lit(0.0)).alias("near"))

    def claim(x: Column) -> Column:
        order = F.struct((-x["inf"]["score"]).alias("neg"), *[x["inf"][c].alias(f"_{c}") for c in tie], x["inf"]["inf_idx"].alias("inf_idx"))
        return F.struct(x["inf"].alias("inf"), x["best"].alias("best"), x["near"].alias("near"), F.when(x["best"].isNotNull() & ~x["best"]["rank"]["late"], order).alias("claim"))

    def winner(g: Column) -> Column:
        return F.array_min(F.transform(F.filter("found", lambda x: x["best"]["rank"].eqNullSafe(g["rank"])), lambda x: x["claim"]))

    def shown(x: Column) -> Column:
        spot = F.get("won", x["best"]["i"])
        taken, late = x["claim"].isNotNull() & (x["claim"] == spot["winner"]), F.coalesce(x["best"]["rank"]["late"], F.lit(False))
        kind = F.when(taken, "matched").when(late, "ignored").otherwise("unmatched_inf")
        return F.struct(kind.alias("kind"), F.when(taken, spot["gt"]).alias("gt"), x["inf"].alias("inf"), F.when(taken | late, -x["best"]["neg"]).otherwise(x["near"]).alias("iou"))

    groups = groups.select("image_id", "gts", F.transform("infs", lambda x, j: F.struct(x.alias("inf"), overlaps(j).alias("overlaps"))).alias("found"))
    groups = groups.select("image_id", "gts", F.transform(F.transform("found", candidate), claim).alias("found"))
    groups = groups.select("image_id", "found", F.transform("gts", lambda g: F.struct(g["rank"].alias("rank"), g["gt"].alias("gt"), winner(g).alias("winner"))).alias("won"))
    no_inf = F.lit(None).cast(groups.schema["found"].dataType.elementType["inf"].dataType)
    missed = F.filter("won", lambda g: ~g["rank"]["late"] & g["winner"].isNull())
    missed = F.transform(missed, lambda g: F.struct(F.lit("unmatched_gt").alias("kind"), g["gt"].alias("gt"), no_inf.alias("inf"), F.lit(None).cast("double").alias("iou")))
    return groups.select("image_id", F.explode(F.concat(F.transform("found", shown), missed)).alias("row")).select("image_id", "row.*")


def _match_tiled(gts: DataFrame, infs: DataFrame, iou_threshold: float, strict: bool, tie: Sequence[str], overlaps: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
    """``match`` of any images: pairs from tiles, and joins on the objects' indexes."""
    gt_order = F.struct(F.col("is_ignored").alias("late"), *[F.col(c) for c in tie], F.col("gt_idx"))
    gt_geoms = gts.groupBy("image_id", "grp", "geom").agg(
        F.min(gt_order).alias("first"), F.bool_or(~F.col("is_ignored")).alias("real")
    )
    on_inf = ["image_id", *[f"_inf_{c}" for c in tie], "inf_idx"]
    infs = infs.select("*", *[_group([c]).alias(f"_inf_{c}") for c in tie])
    pairs = overlaps(gt_geoms, infs.select("grp", "geom", *on_inf))
    passed = (F.col("iou") > iou_threshold) if strict else (F.col("iou") >= iou_threshold)
    best = pairs.groupBy("image_id", *[F.col(f"b.{c}").alias(c) for c in on_inf[1:]]).agg(
        F.min(F.when(passed, F.struct((-F.col("iou")).alias("neg_iou"), F.col("a.first").alias("first")))).alias("best"),
        F.max(F.when(F.col("a.real"), F.col("iou"))).alias("near"),
    )
    # One row per inference with an overlap, read by both halves below: written, so pairs are formed once.
    best = materialize(best, "best-overlaps")
    kept = [c for c in infs.columns if c != "grp" and not c.startswith("_inf_")]
    cand = infs.join(best, on_inf, "left").select(
        *on_inf, "grp", "score", F.struct(*kept).alias("inf"),
        F.col("best.first").alias("first"), (-F.col("best.neg_iou")).alias("best_iou"),
        F.coalesce("near", F.lit(0.0)).alias("near"),
    )
    if iou_threshold < 0 or (iou_threshold == 0 and not strict):
        # Without a positive threshold an object of no overlap is a candidate too: the first of the group.
        first = gts.groupBy("image_id", "grp").agg(F.min(gt_order).alias("any_first"))
        cand = cand.join(first, ["image_id", "grp"], "left").withColumn("first", F.coalesce("first", "any_first"))
        cand = cand.withColumn("best_iou", F.coalesce("best_iou", F.lit(0.0))).drop("any_first")
    takes = cand.where("first IS NOT NULL AND NOT first.late").withColumn("gt_idx", F.col("first.gt_idx"))
    on_gt = ["image_id", *[f"_gt_{c}" for c in tie], "gt_idx"]
    takes = takes.select("*", *[_group([f"first.{c}"]).alias(f"_gt_{c}") for c in tie])
    order = F.struct((-F.col("score")).alias("neg"), *[f"_inf_{c}" for c in tie], "inf_idx")
    winners = takes.groupBy(*on_gt).agg(F.min(order).alias("w")).select(
        *on_gt, *[F.col(f"w._inf_{c}").alias(f"_inf_{c}") for c in tie], F.col("w.inf_idx").alias("inf_idx")
    )
    real = gts.where("NOT is_ignored").select(
        "image_id", "gt_idx", *[_group([c]).alias(f"_gt_{c}") for c in tie],
        F.struct(*[c for c in gts.columns if c != "grp"]).alias("gt"),
    )
    won = real.join(winners, on_gt, "left").select("image_id", "gt", *[c for c in on_inf if c != "image_id"])
    rows = cand.join(won.where("inf_idx IS NOT NULL"), on_inf, "left")
    taken, late = F.col("gt").isNotNull(), F.coalesce(F.col("first.late"), F.lit(False))
    kind = F.when(taken, "matched").when(late, "ignored").otherwise("unmatched_inf")
    iou = F.when(taken | late, F.col("best_iou")).otherwise(F.col("near"))
    rows = rows.select("image_id", kind.alias("kind"), "gt", "inf", iou.alias("iou"))
    missed = won.where("inf_idx IS NULL").select("image_id", F.lit("unmatched_gt").alias("kind"), "gt")
    return rows.unionByName(missed, allowMissingColumns=True)


def match_multiclass(gts: DataFrame, infs: DataFrame, iou_threshold: float = 0.5, required: Sequence[str] = (), **kw) -> DataFrame:
    """Match within each label, then pair the leftovers across labels as ``confused``.

    A confused row is an unmatched ground truth with the inference of another label that covers it;
    that inference also stays an unmatched inference.
    """
    first = materialize(match(gts, infs, iou_threshold, ["label", *required], **kw), "label-matches")
    left_gt = first.where("kind = 'unmatched_gt'").select("gt.*").unionByName(gts.where("is_ignored"))
    left_inf = first.where("kind = 'unmatched_inf'").select("inf.*")
    second = match(left_gt, left_inf, iou_threshold, list(required), tie=["label"], **kw)
    second = materialize(second, "leftover-matches")
    crossed = second.where("kind = 'matched' AND gt.label <> inf.label").select(
        "image_id", F.lit("confused").alias("kind"), "gt", "inf", "iou"
    )
    taken = crossed.select(F.col("image_id").alias("_image"), F.col("gt.gt_idx").alias("_idx"), F.col("gt.label").alias("_label"))
    unmatched = first.where("kind = 'unmatched_gt'").join(
        taken, F.expr("image_id = _image AND gt.gt_idx = _idx AND gt.label <=> _label"), "left_anti"
    )
    return first.where("kind <> 'unmatched_gt'").unionByName(unmatched).unionByName(crossed)


def is_multiclass(gts: DataFrame, infs: DataFrame) -> DataFrame:
    """One row: whether the objects carry at least two labels and none lacks one."""
    labels = gts.select("label").unionAll(infs.select("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n")).agg(
        (F.coalesce(F.bool_and(F.col("label").isNotNull()), F.lit(False)) & (F.count("label") >= 2)).alias("is_multiclass"),
        F.count("label").alias("n_labels"),
    )
