"""One sweep over the ends of time segments, cut into ranges of (group, time).

Segments become +1/-1 changes at their ends, summed per time and lane (a side, and on it a speaker). The changes are dealt
out by range of (group, time) and written once, so a long recording lies in many parts. What is open where a part begins is
the sum of the changes of its group in earlier parts; that sum and the time at which the next part begins go to the part as
ordinary rows. Each part is then swept by itself, in time order, with all lanes side by side, and every measure comes from
the counts that hold between two neighbouring times. Runs that cross a border are put together from their ends.

One part's group needs lanes x 8 bytes for each of its times at once only in slices of SLICE cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.session import materialize

SLICE = 1 << 22
REF, HYP = 0, 1
#: Given (times, the next time after each, counts of each lane in between, sides and names of the lanes), the rows of one slice.
Reducer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list], pd.DataFrame]


class Sweep:
    """Changes of reference and other segments (by, s, e and, if named, a speaker column), ready to be swept any number of times."""

    def __init__(self, ref: DataFrame, hyp: DataFrame | None, by: Sequence[str], speaker: str | None = None, cells: int = SLICE):
        self.by, self.cells = list(by), cells
        sides = [self._changes(d, side, speaker) for side, d in ((REF, ref), (HYP, hyp)) if d is not None]
        both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        net = both.groupBy(*self.by, "t", "side", "lane").agg(F.sum("d").alias("d")).where("d <> 0")
        ranged = net.repartitionByRange(*self.by, "t").withColumn("part", F.spark_partition_id())
        self.changes = materialize(ranged, "changes")

    def _changes(self, segments: DataFrame, side: int, speaker: str | None) -> DataFrame:
        lane = F.col(speaker) if speaker else F.lit("")
        ends = F.explode(F.array(F.struct(F.col("s").cast("double").alias("t"), F.lit(1).alias("d")), F.struct(F.col("e").cast("double").alias("t"), F.lit(-1).alias("d")))).alias("v")
        return segments.where("s < e").select(*self.by, F.lit(side).alias("side"), lane.alias("lane"), ends).select(*self.by, "side", "lane", "v.t", "v.d")

    def _borders(self) -> DataFrame:
        """For groups in several parts: one row per part and lane that is open when the part begins, and one for where the next part begins."""
        by = self.by
        parts = self.changes.groupBy(*by, "part").agg(F.min("t").alias("first"))
        several = parts.groupBy(*by).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
        same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by]

        def semi(df: DataFrame) -> DataFrame:
            return df.alias("a").join(several.alias("b"), same("a", "b"), "left_semi")

        parts = semi(parts)
        nets = semi(self.changes).groupBy(*by, "part", "side", "lane").agg(F.sum("d").alias("d"))
        lanes = nets.select(*by, "side", "lane").distinct()
        grid = parts.alias("a").join(lanes.alias("b"), same("a", "b")).select("a.*", "b.side", "b.lane")
        on = [*same("a", "b"), F.col("a.part") == F.col("b.part"), F.col("a.side") == F.col("b.side"), F.col("a.lane").eqNullSafe(F.col("b.lane"))]
        filled = grid.alias("a").join(nets.alias("b"), on, "left").select("a.*", F.coalesce("b.d", F.lit(0)).alias("d"))
        order = W.partitionBy(*by, "side", "lane").orderBy("part")  # one row a part
        carried = filled.withColumn("n", F.sum("d").over(order.rowsBetween(W.unboundedPreceding, -1))).where("n <> 0")
        opened = carried.select(*by, "side", "lane", F.col("first").alias("t"), F.col("n").cast("long").alias("d"), "part")
        nexts = parts.withColumn("next", F.lead("first").over(W.partitionBy(*by).orderBy("part"))).where("next IS NOT NULL")
        return opened.unionByName(nexts.select(*by, F.lit(-1).alias("side"), F.lit(None).cast("string").alias("lane"), F.col("next").alias("t"), F.lit(0).cast("long").alias("d"), "part"))

    def run(self, reduce: Reducer, schema: str) -> DataFrame:
        """Rows (by, schema) that ``reduce`` makes of every slice of every part."""
        by, cells = self.by, self.cells
        rows = self.changes.withColumn("border", F.lit(False)).unionByName(self._borders().withColumn("border", F.lit(True)))
        rows = rows.withColumn("lane", F.col("lane").cast("string")).withColumn("gid", F.xxhash64(*by, "part"))
        dealt = rows.repartition("gid").sortWithinPartitions("gid", "t")

        def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = None
            for batch in batches:
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
                starts = np.flatnonzero(np.diff(held["gid"].to_numpy(), prepend=held["gid"].iloc[0])) if len(held) else []
                if len(starts):  # the last group may go on in the next batch
                    yield from _groups(held.iloc[: starts[-1]], by, reduce, cells)
                    held = held.iloc[starts[-1] :].reset_index(drop=True)
            if held is not None and len(held):
                yield from _groups(held, by, reduce, cells)

        kinds = dict(self.changes.dtypes)
        return dealt.mapInPandas(sweep, ", ".join([*[f"`{c}` {kinds[c]}" for c in by], schema]))

    def runs(self, **conditions: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
        """(by, condition, s, e): the longest runs of time in which a condition on the open segments (n_ref, n_hyp) holds."""

        def pieces(times: np.ndarray, stops: np.ndarray, counts: np.ndarray, sides: np.ndarray, names: list) -> pd.DataFrame:
            ref, hyp = counts[:, sides == REF].sum(axis=1), counts[:, sides == HYP].sum(axis=1)
            out = []
            for name, holds in conditions.items():
                edge = np.diff(holds(ref, hyp).astype(np.int8), prepend=0, append=0)
                s, e = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0) - 1
                # A run that touches the slice's first or last time may be a piece of a longer one.
                out.append(pd.DataFrame({"condition": name, "s": times[s], "e": stops[e], "whole": (s > 0) & (e < len(times) - 1)}))
            return pd.concat(out, ignore_index=True)

        found = self.run(pieces, "condition string, s double, e double, whole boolean")
        found = materialize(found, "runs")
        by = [*self.by, "condition"]
        cut = found.where("NOT whole")  # at most two a part, group and condition
        edges = F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(1).alias("d")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("d")))).alias("v")
        net = cut.select(*by, edges).groupBy(*by, "v.t").agg(F.sum("v.d").alias("d")).where("d <> 0")
        joined = net.withColumn("e", F.lead("t").over(W.partitionBy(*by).orderBy("t"))).where("d > 0").select(*by, F.col("t").alias("s"), "e")
        return found.where("whole").select(*by, "s", "e").unionByName(joined)

    def totals(self) -> DataFrame:
        """(by, kind, ref, hyp, x): sums of durations, added up over parts.

        ``length``: time with the lane open; ``both``: time with both lanes open; ``pairs``: seconds over all pairs of their
        segments; the other kinds have no lanes and count open lanes of each side (a, b): ``ref_s`` a, ``hyp_s`` b, ``miss``
        a over b, ``false_alarm`` b over a, ``shared`` the smaller, and ``speech_tp fp fn tn`` time with any lane open.
        """

        def sums(times: np.ndarray, stops: np.ndarray, counts: np.ndarray, sides: np.ndarray, names: list) -> pd.DataFrame:
            lasts = stops - times
            r, h = np.flatnonzero(sides == REF), np.flatnonzero(sides == HYP)
            many = counts.astype(float)
            up = (counts > 0).astype(float)
            a, b = up[:, r].sum(axis=1), up[:, h].sum(axis=1)
            plain = {
                "ref_s": a, "hyp_s": b, "miss": np.maximum(a - b, 0), "false_alarm": np.maximum(b - a, 0), "shared": np.minimum(a, b),
                "speech_tp": (a > 0) & (b > 0), "speech_fp": (a == 0) & (b > 0), "speech_fn": (a > 0) & (b == 0), "speech_tn": (a == 0) & (b == 0),
            }
            out = [(kind, None, None, float(lasts @ v)) for kind, v in plain.items()]
            out += [("length", names[i], None, x) for i, x in zip(r, lasts @ up[:, r])] + [("length", None, names[i], x) for i, x in zip(h, lasts @ up[:, h])]
            for kind, m in (("both", up), ("pairs", many)):
                cells = (m[:, r] * lasts[:, None]).T @ m[:, h]
                out += [(kind, names[r[i]], names[h[j]], float(cells[i, j])) for i, j in zip(*np.nonzero(cells))]
            return pd.DataFrame(out, columns=["kind", "ref", "hyp", "x"])

        rows = self.run(sums, "kind string, ref string, hyp string, x double")
        return rows.groupBy(*self.by, "kind", "ref", "hyp").agg(F.sum("x").alias("x"))


def _groups(rows: pd.DataFrame, by: list[str], reduce: Reducer, cells: int) -> Iterator[pd.DataFrame]:
    """Each group's slices, reduced; rows are sorted by group and time."""
    gid = rows["gid"].to_numpy()
    starts = np.flatnonzero(np.diff(gid, prepend=gid[0] + 1 if gid[0] < 0 else gid[0] - 1))
    values = {c: rows[c].to_numpy() for c in (*by, "side", "lane", "t", "d", "border")}
    out: list[pd.DataFrame] = []
    for start, end in zip(starts, np.append(starts[1:], len(rows))):
        key = {c: values[c][start] for c in by}
        for part in _slices({c: values[c][start:end] for c in ("side", "lane", "t", "d", "border")}, reduce, cells):
            out.append(part.assign(**key)[[*by, *part.columns]])
        if sum(map(len, out)) > 10_000:
            yield pd.concat(out, ignore_index=True)
            out = []
    if out:
        yield pd.concat(out, ignore_index=True)


def _slices(v: dict[str, np.ndarray], reduce: Reducer, cells: int) -> Iterator[pd.DataFrame]:
    """Counts between neighbouring times of one part of a group, a slice of times after the other."""
    border, side = v["border"].astype(bool), v["side"]
    ahead = v["t"][side < 0]
    real = side >= 0
    lanes, lane = np.unique(np.array([f"{s}{n}" if n is not None else f"{s}" for s, n in zip(side[real], v["lane"][real])]), return_inverse=True)
    first = np.full(len(lanes), -1)
    first[lane[::-1]] = np.flatnonzero(real)[::-1]
    sides, names = side[first].astype(int), [v["lane"][i] for i in first]
    open_ = np.zeros(len(lanes), np.int64)
    opened = border[real]
    np.add.at(open_, lane[opened], v["d"][real][opened])
    moving = ~opened
    times, at = np.unique(v["t"][real][moving], return_inverse=True)
    lane, d = lane[moving], v["d"][real][moving].astype(np.int64)
    stops = np.append(times[1:], ahead[0] if len(ahead) else times[-1] if len(times) else 0.0)
    rows = max(1, cells // max(1, len(lanes)))
    for begin in range(0, len(times), rows):
        end = min(begin + rows, len(times))
        inside = slice(np.searchsorted(at, begin), np.searchsorted(at, end)) if len(at) else slice(0)
        counts = np.zeros((end - begin, len(lanes)), np.int64)
        np.add.at(counts, (at[inside] - begin, lane[inside]), d[inside])
        counts[0] += open_
        counts = np.cumsum(counts, axis=0)
        open_ = counts[-1].copy()
        keep = stops[begin:end] > times[begin:end]  # all but the last time of a group
        if keep.any():
            yield reduce(times[begin:end][keep], stops[begin:end][keep], counts[keep], sides, names)
