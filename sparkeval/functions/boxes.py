"""Box geometry as column expressions over ``struct<x1,y1,x2,y2>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    parts = zip((x1, y1, x2, y2), ("x1", "y1", "x2", "y2"))
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).cast("double").alias(n) for c, n in parts])


def width(b: Column) -> Column:
    return F.abs(b["x2"] - b["x1"])


def height(b: Column) -> Column:
    return F.abs(b["y2"] - b["y1"])


def area(b: Column) -> Column:
    return width(b) * height(b)


def aspect_ratio(b: Column) -> Column:
    return F.when(height(b) > 0, F.try_divide(width(b), height(b))).otherwise(0.0)


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the boxes only touch or the union is empty."""
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    inter = w * h
    union = (a["x2"] - a["x1"]) * (a["y2"] - a["y1"]) + (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) - inter
    return F.when((w > 0) & (h > 0) & (union > 0), F.try_divide(inter, union)).otherwise(0.0)


def box3d_iou(a: Column, b: Column) -> Column:
    """Axis-aligned 3D overlap of ``struct<x1,y1,z1,x2,y2,z2>``."""
    sides = [F.least(a[f"{c}2"], b[f"{c}2"]) - F.greatest(a[f"{c}1"], b[f"{c}1"]) for c in "xyz"]
    inter = sides[0] * sides[1] * sides[2]
    union = volume3d(a) + volume3d(b) - inter
    open_ = (sides[0] > 0) & (sides[1] > 0) & (sides[2] > 0)
    return F.when(open_ & (union > 0), F.try_divide(inter, union)).otherwise(0.0)


def volume3d(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"]) * (b["z2"] - b["z1"])


def extent(geom: Column, polygon: bool) -> dict[str, Column]:
    """Bounding extent of a box struct or of an array of points."""
    if not polygon:
        return {n: geom[n] for n in ("x1", "y1", "x2", "y2")}
    xs, ys = F.transform(geom, lambda p: p["x"]), F.transform(geom, lambda p: p["y"])
    return {"x1": F.array_min(xs), "y1": F.array_min(ys), "x2": F.array_max(xs), "y2": F.array_max(ys)}


def box_ring(b: Column) -> Column:
    """A box as a ring of four corners."""
    corners = [("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2")]
    return F.array(*[F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in corners])
