"""Overlap of simple polygons (even-odd rule), pair by pair inside tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.operators.matching import GROUPED, overlapping

_CHUNK = 512


def _edges(ring: np.ndarray) -> np.ndarray:
    return np.concatenate([ring, np.roll(ring, -1, axis=-2)], axis=-1)


def _levels(e: np.ndarray) -> np.ndarray:
    """Heights at which the set of edges changes order: vertices and crossings."""
    found = [e[:, 1], e[:, 3]]
    d = e[:, 2:] - e[:, :2]
    for i in range(0, len(e), _CHUNK):
        a, da = e[i : i + _CHUNK, None, :2], d[i : i + _CHUNK, None, :]
        gap = e[None, :, :2] - a
        den = da[..., 0] * d[None, :, 1] - da[..., 1] * d[None, :, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            s = (gap[..., 0] * d[None, :, 1] - gap[..., 1] * d[None, :, 0]) / den
            t = (gap[..., 0] * da[..., 1] - gap[..., 1] * da[..., 0]) / den
            ok = (den != 0) & (s > 0) & (s < 1) & (t > 0) & (t < 1)
            found.append((a[..., 1] + s * da[..., 1])[ok])
    return np.unique(np.concatenate(found))


def ring_iou(a, b) -> float:
    """Exact by slabs: between two neighbouring levels no edges cross, so mid-width times height is the area."""
    ea, eb = _edges(a), _edges(b)
    e = np.vstack([ea, eb])
    of_a = np.arange(len(e)) < len(ea)
    ys = _levels(e)
    inter = union = 0.0
    lo, hi = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    slope = np.divide(e[:, 2] - e[:, 0], e[:, 3] - e[:, 1], out=np.zeros(len(e)), where=e[:, 3] != e[:, 1])
    for i in range(0, len(ys) - 1, _CHUNK):
        top, bottom = ys[i : i + _CHUNK + 1][:-1], ys[i : i + _CHUNK + 1][1:]
        mid = (top + bottom)[:, None] / 2
        crossed = (lo[None, :] < mid) & (mid < hi[None, :])
        x = np.where(crossed, e[None, :, 0] + (mid - e[None, :, 1]) * slope[None, :], np.inf)
        order = np.argsort(x, axis=1, kind="stable")
        x, live, in_a = np.take_along_axis(x, order, 1), np.take_along_axis(crossed, order, 1), of_a[order]
        odd_a = np.cumsum(live & in_a, axis=1) % 2 == 1
        odd_b = np.cumsum(live & ~in_a, axis=1) % 2 == 1
        with np.errstate(invalid="ignore"):
            width = np.diff(x, axis=1)
        width = np.where(live[:, 1:], width, 0.0) * (bottom - top)[:, None]
        inter += float(width[(odd_a & odd_b)[:, :-1]].sum())
        union += float(width[(odd_a | odd_b)[:, :-1]].sum())
    return inter / union if union > 0 else 0.0


def small_ring_ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``ring_iou`` of many pairs of equally small rings at once: arrays (pairs, points, 2)."""
    ea, eb = _edges(a), _edges(b)
    e = np.concatenate([ea, eb], axis=1)
    pairs, n = e.shape[:2]
    of_a = np.arange(n) < ea.shape[1]
    d = e[..., 2:] - e[..., :2]
    i, j = np.triu_indices(n, 1)  # each two edges once
    gap, di, dj = e[:, j, :2] - e[:, i, :2], d[:, i], d[:, j]
    with np.errstate(divide="ignore", invalid="ignore"):
        den = di[..., 0] * dj[..., 1] - di[..., 1] * dj[..., 0]
        s = (gap[..., 0] * dj[..., 1] - gap[..., 1] * dj[..., 0]) / den
        t = (gap[..., 0] * di[..., 1] - gap[..., 1] * di[..., 0]) / den
        ok = (den != 0) & (s > 0) & (s < 1) & (t > 0) & (t < 1)
        cross = np.where(ok, e[:, i, 1] + s * di[..., 1], e[:, :1, 1])  # no crossing: repeat a vertex
        slope = np.where(d[..., 1] != 0, d[..., 0] / d[..., 1], 0.0)
    ys = np.sort(np.concatenate([e[..., 1], cross], axis=1), axis=1)
    mid, high = (ys[:, 1:] + ys[:, :-1])[..., None] / 2, np.diff(ys, axis=1)
    lo, hi = np.minimum(e[..., 1], e[..., 3])[:, None], np.maximum(e[..., 1], e[..., 3])[:, None]
    crossed = (lo < mid) & (mid < hi)
    x = np.where(crossed, e[:, None, :, 0] + (mid - e[:, None, :, 1]) * slope[:, None], np.inf)
    order = np.argsort(x, axis=-1, kind="stable")
    x, live, in_a = np.take_along_axis(x, order, -1), np.take_along_axis(crossed, order, -1), of_a[order]
    odd_a = np.cumsum(live & in_a, axis=-1) % 2 == 1
    odd_b = np.cumsum(live & ~in_a, axis=-1) % 2 == 1
    with np.errstate(invalid="ignore"):
        width = np.where(live[..., 1:], np.diff(x, axis=-1), 0.0) * high[..., None]
    inter = np.where((odd_a & odd_b)[..., :-1], width, 0.0).sum((1, 2))
    union = np.where((odd_a | odd_b)[..., :-1], width, 0.0).sum((1, 2))
    return np.divide(inter, union, out=np.zeros(pairs), where=union > 0)


def _convex(e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges turned counter-clockwise (pairs, points, 4), and which rings turn one way at every corner, once around."""
    d = e[..., 2:] - e[..., :2]
    n = np.roll(d, -1, axis=1)
    turn = d[..., 0] * n[..., 1] - d[..., 1] * n[..., 0]
    once = np.abs(np.arctan2(turn, (d * n).sum(-1)).sum(1)) < 7  # a star turns one way too, but twice around
    back = (turn < 0).all(1)
    e = np.where(back[:, None, None], e[:, ::-1][..., [2, 3, 0, 1]], e)
    return e, once & ((turn > 0).all(1) | back)


def _inside(e: np.ndarray, of: np.ndarray, closed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Twice what the edges' parts inside convex rings add to an area, and which pairs have edges that nearly lie on each other."""
    d, h = e[..., 2:] - e[..., :2], of[..., 2:] - of[..., :2]
    gap = e[:, :, None, :2] - of[:, None, :, :2]
    num = h[:, None, :, 0] * gap[..., 1] - h[:, None, :, 1] * gap[..., 0]  # above 0: left of the other ring's edge
    den = h[:, None, :, 0] * d[:, :, None, 1] - h[:, None, :, 1] * d[:, :, None, 0]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = -num / den
    start = np.where(den > 0, t, 0.0).max(-1).clip(0)
    end = np.where(den < 0, t, 1.0).min(-1).clip(None, 1)
    along = h[:, None, :, 0] * d[:, :, None, 0] + h[:, None, :, 1] * d[:, :, None, 1] > 0  # on an edge of the other, rings on one side
    out = (den == 0) & ((num < 0) | ((num == 0) & ~(along & closed)))
    live = (end > start) & ~out.any(-1)
    p, q = (e[..., :2] - e[:, :1, :2] + d * x[..., None] for x in (start, end))
    shift = e[:, :1, :2] - of[:, :1, :2] if not closed else 0.0  # both rings' parts around one origin
    p, q = p + shift, q + shift
    size = np.abs(h).sum(-1)[:, None, :]
    near = (np.abs(den) <= 1e-9 * np.abs(d).sum(-1)[:, :, None] * size) & (np.abs(num) <= 1e-9 * size * (size + np.abs(gap).sum(-1))) & ((den != 0) | (num != 0))
    return np.where(live, p[..., 0] * q[..., 1] - p[..., 1] * q[..., 0], 0.0).sum(-1), near.any((1, 2))


def convex_ring_ious(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlaps of pairs of convex rings, and which pairs they hold for: the common area is bounded by each ring's edges inside the other."""
    (ea, sure_a), (eb, sure_b) = _convex(_edges(a)), _convex(_edges(b))
    of_a, close_a = _inside(ea, eb, True)
    of_b, close_b = _inside(eb, ea, False)  # an edge of both counts once
    area = [((x := e[..., :2] - e[:, :1, :2])[..., 0] * (y := e[..., 2:] - e[:, :1, :2])[..., 1] - x[..., 1] * y[..., 0]).sum(-1) for e in (ea, eb)]
    inter = np.maximum(of_a + of_b, 0.0)
    union = area[0] + area[1] - inter
    return np.divide(inter, union, out=np.zeros(len(inter)), where=union > 0), sure_a & sure_b & ~close_a & ~close_b & np.isfinite(inter)


_SMALL, _CELLS = 16, 1_000_000


def _pair_ious(pairs: int, na: np.ndarray, nb: np.ndarray, rings: Callable[[np.ndarray, int, int], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Overlaps of pairs of rings with ``na`` and ``nb`` points; ``rings`` gives the points of some pairs of equal sizes. Those run together, large ones one by one."""
    out = np.zeros(pairs)
    for (a, b), rows in pd.DataFrame({"a": na, "b": nb}).groupby(["a", "b"]).indices.items():
        n = a + b
        step = max(1, _CELLS // ((n + n * n // 2) * n)) if n <= _SMALL else 1
        for i in range(0, len(rows), step):
            p, q = rings(rows[i : i + step], a, b)
            if n > _SMALL:
                out[rows[i]] = ring_iou(p[0], q[0])
                continue
            found, sure = convex_ring_ious(p, q)
            if not sure.all():
                found[~sure] = small_ring_ious(p[~sure], q[~sure])
            out[rows[i : i + step]] = found
    return out


@F.pandas_udf(T.DoubleType())
def _ring_ious(ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series) -> pd.Series:
    ax, ay, bx, by = (c.to_numpy() for c in (ax, ay, bx, by))

    def rings(rows: np.ndarray, *_: int) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.stack([np.concatenate(c[rows]).reshape(len(rows), -1) for c in xy], axis=-1).astype(float) for xy in ((ax, ay), (bx, by)))

    return pd.Series(_pair_ious(len(ax), np.array([len(x) for x in ax], int), np.array([len(x) for x in bx], int), rings))


_ring_ious = _ring_ious.asNondeterministic()  # else a filter on the result is pushed below it and computes it twice


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _grouped_ious(ax: pd.Series, ay: pd.Series, an: pd.Series, bx: pd.Series, by: pd.Series, bn: pd.Series) -> pd.Series:
    """For each ring of the second list its overlaps with all of the first, -1 where extents do not meet; points lie one after the other, numbers beside."""
    flat = lambda c: np.concatenate([np.zeros(0), *c.to_numpy()]).astype(float)
    a, b, na, nb = np.stack([flat(ax), flat(ay)], -1), np.stack([flat(bx), flat(by)], -1), flat(an).astype(int), flat(bn).astype(int)
    rows_a, rows_b = an.map(len).to_numpy(), bn.map(len).to_numpy()
    pairs = rows_a * rows_b

    def extents(points: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full((2, len(n), 2), np.nan)
        some, starts = n > 0, (np.cumsum(n) - n)[n > 0]
        if len(starts):
            low[some], high[some] = np.fmin.reduceat(points, starts), np.fmax.reduceat(points, starts)
        return low, high

    row = np.repeat(np.arange(len(pairs)), pairs)
    at = np.arange(pairs.sum()) - (np.cumsum(pairs) - pairs)[row]
    i, j = (np.cumsum(rows_a) - rows_a)[row] + at % rows_a[row], (np.cumsum(rows_b) - rows_b)[row] + at // rows_a[row]
    (alow, ahigh), (blow, bhigh) = extents(a, na), extents(b, nb)
    meet = np.flatnonzero((np.maximum(alow[i], blow[j]) < np.minimum(ahigh[i], bhigh[j])).all(axis=1))
    i, j = i[meet], j[meet]
    starts_a, starts_b = (np.cumsum(na) - na)[i], (np.cumsum(nb) - nb)[j]

    def rings(of: np.ndarray, m: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        return a[starts_a[of][:, None] + np.arange(m)], b[starts_b[of][:, None] + np.arange(n)]

    out = np.full(len(row), -1.0)
    out[meet] = _pair_ious(len(meet), na[i], nb[j], rings)
    return pd.Series(np.split(out, np.cumsum(pairs)[:-1]), dtype=object)


_grouped_ious = _grouped_ious.asNondeterministic()


def _axes(geom: Column) -> tuple[Column, Column]:
    return F.transform(geom, lambda p: p["x"]), F.transform(geom, lambda p: p["y"])


def polygon_iou(a: Column, b: Column) -> Column:
    return _ring_ious(*_axes(a), *_axes(b))


def polygon_overlaps(gts: DataFrame, infs: DataFrame) -> DataFrame:
    """(image_id, grp, a, b, iou) for distinct rings whose extents overlap."""
    pairs = overlapping(gts, infs, ["image_id", "grp"], polygon=True)
    return pairs.withColumn("iou", polygon_iou(F.col("a.geom"), F.col("b.geom")))


def _polygon_groups(a: Column, b: Column) -> Column:
    none = F.array().cast("array<double>")
    axis = lambda g, name: F.coalesce(F.transform(g, lambda p: p[name].cast("double")), none)
    flat = lambda rings, name: F.flatten(F.transform(rings, lambda g: axis(g, name)))
    return _grouped_ious(*[x for rings in (a, b) for x in (flat(rings, "x"), flat(rings, "y"), F.transform(rings, lambda g: F.size(axis(g, "x"))))])


#: A ring counts as many points as it has, and at least those of a box.
GROUPED[polygon_overlaps] = (_polygon_groups, lambda geom: F.greatest(F.lit(4), F.coalesce(F.size(geom), F.lit(0))))
