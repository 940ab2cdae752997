"""Approximate nearest neighbours by largest inner product: shifted Hilbert orderings of projected vectors.

Every curve projects the vectors onto a few random orthogonal directions, spreads each direction evenly over a grid, shifts
the grid and orders the cells along a Hilbert curve. Spark range-partitions the rows by (curve, key); a query is compared
with the rows of a window around its key, and the best of all its windows are merged and ranked. Vectors of unequal length
get one more component that makes their lengths equal, so the largest inner product is the smallest angle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch
from sparkeval.llm.textbits import mix

PLACED = "curve int, key bigint, tie bigint, class bigint, asks boolean, v binary"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell (rows of small integers) on a Hilbert curve of ``bits`` bits per axis.

    Cells are turned into Gray-coded curve coordinates level by level: at each level, an axis whose bit is set reflects the
    lower bits of the first axis, an axis whose bit is not set swaps them with the first axis's.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(axes):
            set_ = (x[axis] >> level) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, axes):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = key << 1 | (x[axis] >> level) & 1
    return key


class Curves:
    """Random projections, fitted spreads and shifts of all curves."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int, bits: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        dim = sample.shape[1]
        self.bits = bits
        self.turns = [np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, : min(axes, dim)] for _ in range(curves)]
        # The even spread: sorted sample values of each direction; a value's grid place is its share of them.
        self.spread = [np.sort(sample @ t, axis=0) for t in self.turns]
        self.shift = [rng.uniform(0, 1, t.shape[1]) for t in self.turns]

    def keys(self, curve: int, v: np.ndarray) -> np.ndarray:
        y, spread, size = v @ self.turns[curve], self.spread[curve], 1 << self.bits
        share = np.stack([np.searchsorted(spread[:, i], y[:, i]) / len(spread) for i in range(y.shape[1])], axis=1)
        return hilbert_keys(np.minimum((share + self.shift[curve]) / 2 * size, size - 1).astype(np.int64), self.bits)


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): distinct rows whose vector can take part, all of the most frequent length."""
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND size(v) > 0")
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    rows = rows.where(finite).distinct()
    length = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return rows.where(F.size("v") == (length[0] if length else 0))


def nearest(vectors: DataFrame, k: int = 20, queries: str = "id % 20 = 0", curves: int = 24, window: int = 1000, axes: int = 8, bits: int = 4, sample: int = 2000, share: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each query row, nearest first, ties to the smaller id.

    Candidates are all rows but the query's own. Null, zero and non-finite vectors, vectors with such components, of another
    length than most, or without id take no part. Rows that repeat id and vector are one row. Equal vectors are searched
    once and are all candidates, so copies cost nothing and none is lost. Fewer rows than ``k`` give all of them; an empty
    table gives an empty one. Only the grid spread is fitted on ``sample`` vectors; every row is indexed on every curve. A
    query sees at least the 2 * ``window`` rows around it on each curve, or its whole partition if that is smaller. The window
    grows with the table: it is at least a ``share``-th of the rows, and a partition holds about four windows, so recall
    does not fall with size and the comparisons grow with the square of it.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = scratch.write(_usable(vectors, key, vector).withColumn("class", F.xxhash64("v")), "vectors")
    classes = rows.groupBy("class").agg(F.first("v").alias("v"), F.max(F.expr(queries)).alias("asks"))
    total, longest, dim = rows.agg(F.count("*"), F.max(F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")), F.max(F.size("v"))).first()
    picked = rows.select("v", "class").orderBy("class").limit(sample).select("v").collect()
    fitted = np.asarray([r[0] for r in picked], np.float64).reshape(-1, dim or 1)
    index = Curves(_level(fitted, longest or 1.0), curves, axes, bits)
    sent = spark.sparkContext.broadcast((index.turns, index.spread, index.shift))
    row_bytes = 8 * (dim or 1) + 64
    window = max(window, -(-(total or 0) // share))
    parts = max(1, int((total or 0) * 1.1 * curves // max((32 << 20) // row_bytes, 4 * window)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Curves.__new__(Curves)
        own.bits, (own.turns, own.spread, own.shift) = bits, sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                v = np.asarray(part.column("v").to_pylist(), np.float64)
                asks = np.asarray(part.column("asks").to_pylist(), bool)
                ids = part.column("class").to_numpy()
                toward = np.concatenate([v / np.linalg.norm(v, axis=1, keepdims=True) * np.sqrt(longest), np.zeros((len(v), 1))], axis=1)
                both = np.concatenate([_level(v, longest), toward[asks]])
                n, names = len(both), np.concatenate([ids, ids[asks]])
                kind = np.concatenate([np.zeros(len(v), bool), np.ones(int(asks.sum()), bool)])
                data = pa.array([x.tobytes() for x in v] + [x.tobytes() for x in v[asks]], pa.binary())
                for curve in range(curves):
                    tie = mix(names.view(np.uint64) ^ mix(np.asarray([curve + 1], np.uint64))).view(np.int64)
                    columns = [np.full(n, curve, np.int32), own.keys(curve, both), tie, names, kind]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), data], names=["curve", "key", "tie", "class", "asks", "v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        curve = table.column("curve").to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], curve[1:] != curve[:-1], [True]]))
        for a, b in zip(edges[:-1], edges[1:]):
            part = table.slice(a, b - a)
            asks = part.column("asks").to_numpy(zero_copy_only=False)
            ids = part.column("class").to_numpy()
            v = np.frombuffer(b"".join(part.column("v").to_pylist()), np.float64).reshape(len(ids), -1)
            data, asked = np.flatnonzero(~asks), np.flatnonzero(asks)
            if not len(data) or not len(asked):
                continue
            points, names = v[data], ids[data]
            place_ = np.searchsorted(data, asked)
            for at in range(0, len(asked), 64):
                group = slice(at, at + 64)
                low = max(0, min(int(place_[group].min()) - window, len(data) - 2 * window))
                high = min(len(data), max(int(place_[group].max()) + window, 2 * window))
                scores = v[asked[group]] @ points[low:high].T
                best = np.argpartition(-scores, min(k, scores.shape[1] - 1), axis=1)[:, : k + 1]
                top = np.take_along_axis(scores, best, 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[asked[group]], best.shape[1])), pa.array(names[low:high][best].ravel()), pa.array(top.ravel())], names=["asking", "class", "score"])

    ordered = classes.mapInArrow(place, PLACED).repartitionByRange(parts, "curve", "key", "tie").sortWithinPartitions("curve", "key", "tie")
    found = ordered.mapInArrow(search, "asking bigint, class bigint, score double").groupBy("asking", "class").agg(F.max("score").alias("score"))
    near = found.withColumn("r", F.row_number().over(Window.partitionBy("asking").orderBy(F.desc("score"), "class"))).where(f"r <= {k + 1}").drop("r")
    # The smallest ids of a class are enough: k + 1 of them hold k that are not the query's own.
    members = rows.select("class", "id").withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("id"))).where(f"r <= {k + 1}").drop("r")
    by_score = Window.partitionBy("asking").orderBy(F.desc("score"), "id")
    lists = near.join(members, "class").withColumn("r", F.row_number().over(by_score)).where(f"r <= {k + 1}").select("asking", "id", "score")
    asked = rows.where(F.expr(queries)).select(F.col("class").alias("asking"), F.col("id").alias("query_id"))
    pairs = asked.join(lists, "asking").where("id <> query_id")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(f"rank <= {k}")
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _level(v: np.ndarray, longest: float) -> np.ndarray:
    """``v`` with one more component that gives every row the squared length ``longest``."""
    return np.concatenate([v, np.sqrt(np.maximum(longest - (v * v).sum(1, keepdims=True), 0))], axis=1)
