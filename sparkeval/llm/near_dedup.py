"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

Equal sets meet in one aggregate and go on as one class. Classes that share a band are in a bucket; a bucket's candidates
are a star: its smallest class against the others. Candidates are confirmed on the full sets. A star can miss a link between
two leaves of different components. The classes of buckets that still hold several components are therefore grouped again,
by the rarest shingles of their sets, of which similar sets must share one; in groups of several components stars with the
next centres follow, in rounds of more and more centres and only between components, until every such pair has been
confirmed or refused. A group of copies is one component after the first star, so its pairs are never made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch
from sparkeval.llm.graph import components, merge
from sparkeval.llm.textbits import U, chunks, mix, shingle_hashes, word_hashes

BINS, ROWS = 128, 4  # 32 bands: a pair of similarity 0.8 shares none with a chance of 5e-8
BIN_BITS = BINS.bit_length() - 1
SLOT_BITS = 20
#: Donor bins of the densification: row a names, for each bin, the bin tried at attempt a.
DONORS = (mix(np.arange(1, 4096 * BINS + 1, dtype=U)) % U(BINS)).astype(np.int64).reshape(4096, BINS)
SIGNED = "n bigint, node bigint, bands array<bigint>"


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum of each bin (its top bits name it) for sorted non-empty sets; an empty bin borrows from its first non-empty donor."""
    out, full = np.zeros((len(sets), BINS), U), np.zeros((len(sets), BINS), bool)
    for row, values in enumerate(sets):
        bins = (values >> U(64 - BIN_BITS)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        out[row, bins[first]], full[row, bins[first]] = values[first], True
    rows, bins = np.nonzero(~full)
    for donors in DONORS:
        if not len(rows):
            return out
        donor = donors[bins]
        found = full[rows, donor]
        out[rows[found], bins[found]] = out[rows[found], donor[found]]
        rows, bins = rows[~found], bins[~found]
    for row, at in zip(rows, bins):  # never seen: 4,096 attempts without a hit
        out[row, at] = out[row, np.flatnonzero(full[row])[0]]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        salt = mix(np.arange(1, BINS + 1, dtype=U) * U(0x8CB92BA72F3D8DD7)) | U(1)
        return mix((mix(sketches) * salt).reshape(len(sketches), BINS // ROWS, ROWS).sum(2)).view(np.int64)


def set_node(values: np.ndarray) -> int:
    """64-bit name of a set, independent of any order."""
    with np.errstate(over="ignore"):
        return int(mix(np.asarray([mix(values ^ U(0x5851F42D4C957F2D)).sum() + U(len(values))], U)).view(np.int64)[0])


def _sets(part: pa.RecordBatch, width: int) -> list[np.ndarray]:
    found, ranges = shingle_hashes(*word_hashes(part.column("text")), width)
    return [np.unique(found[a:b]) for a, b in zip(ranges[:-1], ranges[1:])]


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, n, node, bands (and code, if there is one) of each row; no bands where only an equal set can be similar, no node for an empty set."""
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    more = [c for c in docs.columns if c == "code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            sets = _sets(part, width)
            large = [i for i, s in enumerate(sets) if len(s) >= least]
            bands: list[np.ndarray | None] = [None] * len(sets)
            for i, keys in zip(large, band_keys(sketch([sets[i] for i in large])) if large else []):
                bands[i] = keys
            nodes = [set_node(s) if len(s) else None for s in sets]
            columns = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), *(part.column(c) for c in more)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "node", "bands", *more])

    return docs.mapInArrow(run, "doc_id bigint, " + SIGNED + "".join(f", {c} bigint" for c in more))


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of the wanted (doc_id, node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            sets = _sets(part, width)
            same = [i for i, (s, node) in enumerate(zip(sets, part.column("node").to_pylist())) if len(s) and set_node(s) == node]
            yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(same, pa.int64())), pa.array([sets[i].tobytes() for i in same], pa.binary())], names=["node", "shingles"])

    return docs.join(wanted, "doc_id").select("node", "text").mapInArrow(run, "node bigint, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                shared = int((y[at] == x).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "x"}), "a").join(sets.withColumnsRenamed({"node": "b", "shingles": "y"}), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id", codes: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links) and kept (doc_id is component_id).

    A document's set: distinct runs of ``width`` words (runs outside space and 0x09-0x0D, A-Z lower-cased), or all words as
    one run if there are fewer. Null, empty and wordless texts have an empty set, link with nothing and stay. A row without
    doc_id has no component and stays. Rows that repeat a doc_id keep their rows: each is linked by its own text. An empty
    table gives an empty one. Sets are held as 64-bit hashes of their runs. Extra columns are ignored. ``codes`` adds a column
    ``code``, the xxhash64 of the row's text, which tells apart the rows of a repeated doc_id.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    more = ["code"] if codes else []
    texts = texts.withColumn("code", F.xxhash64("text")) if codes else texts
    signed = scratch.write(signatures(texts, width, percent), "signatures")
    named = signed.where("doc_id IS NOT NULL AND node IS NOT NULL")
    classes = scratch.write(named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    roots = _link(scratch, texts, classes, width, percent)
    rooted = classes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = scratch.write(rooted.join(least, "root").select("node", "component_id"), "components")
    out = signed.select("doc_id", "n", "node", *more).join(component, "node", "left")
    alone = F.col("doc_id").isNull() | F.col("node").isNull()
    component_id = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    result = out.select("doc_id", F.col("n").alias("n_shingles"), component_id.alias("component_id"), (alone | (F.col("doc_id") == F.col("component_id"))).alias("kept"), *more)
    scratch.drop(classes)
    return result


def rarity(sets: DataFrame) -> np.ndarray:
    """How often each of 2^20 hash slots occurs in the sets, as a power of two: a table of fixed size (1 MB)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for x in batch.column("shingles"):
                np.add.at(counts, (np.frombuffer(x.as_py(), U) >> U(64 - SLOT_BITS)).astype(np.int64), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "count"])

    def pack(rows: pa.Table) -> pa.Table:
        """The levels of 4,096 neighbouring slots, one byte each."""
        slots = rows.column("slot").to_numpy()
        levels = np.zeros(1 << 12, np.uint8)
        levels[slots & 0xFFF] = np.log2(rows.column("count").to_numpy())
        return pa.table({"part": pa.array([int(slots[0]) >> 12], pa.int64()), "levels": pa.array([levels.tobytes()], pa.binary())})

    counts = sets.select("shingles").mapInArrow(run, "slot bigint, count bigint").groupBy("slot").agg(F.sum("count").alias("count"))
    packed = counts.groupBy(F.shiftright("slot", 12).alias("part")).applyInArrow(pack, "part bigint, levels binary")
    levels = np.zeros((1 << SLOT_BITS - 12, 1 << 12), np.uint8)
    for part, own in packed.collect():
        levels[part] = np.frombuffer(own, np.uint8)
    return levels.ravel()


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, n, place, short): the rarest shingles of each set, of which two similar sets always share one.

    The order (slot level, hash) is one order for all sets; the first n - ceil(percent / 100 * n) + 1 shingles are enough.
    ``short`` marks the places at which the first shared shingle of the smaller set of a pair can be.
    """
    levels = sets.sparkSession.sparkContext.broadcast(rarity(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, found = [], [], []
            for node, x in zip(batch.column("node").to_pylist(), batch.column("shingles")):
                x = np.frombuffer(x.as_py(), U)
                level = levels.value[(x >> U(64 - SLOT_BITS)).astype(np.int64)]
                found.append(x[np.lexsort((x, level))[: len(x) - -(-percent * len(x) // 100) + 1]])
                nodes.append(node)
                sizes.append(len(x))
            if nodes:
                many = [len(x) for x in found]
                n, place = np.repeat(sizes, many), np.concatenate([np.arange(m) for m in many])
                short = place <= n - -(-2 * percent * n // (100 + percent))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.repeat(nodes, many)), pa.array(n), pa.array(place), pa.array(short)], names=["bucket", "node", "n", "place", "short"])

    return sets.mapInArrow(run, "bucket bigint, node bigint, n bigint, place bigint, short boolean")


def _link(scratch: Scratch, texts: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    rows = classes.where("bands IS NOT NULL").select(F.explode("bands").alias("bucket"), "node", "n")
    centres = rows.groupBy("bucket").agg(F.min("node").alias("centre"), F.min_by("n", "node").alias("cn"), F.count("*").alias("size")).where("size > 1")
    buckets = scratch.write(rows.join(centres, "bucket").select("bucket", "node", "n", "centre", "cn"), "buckets")
    wanted = buckets.select("node").distinct().join(classes.select("node", "doc_id"), "node")
    sets = scratch.write(full_sets(texts, wanted, width), "sets")
    alike = 100 * F.least("n", "cn") >= percent * F.greatest("n", "cn")
    pairs = buckets.where((F.col("node") != F.col("centre")) & alike).select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = scratch.write(confirm(pairs, sets, percent), "links")
    roots = components(links, scratch)

    def mixed(table: DataFrame, short: str, more: int) -> DataFrame:
        """Rows of the buckets that hold several components and more than so many possible centres, with the row's component."""
        placed = table.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.expr(f"count_if({short})").alias("centres"))
        return placed.join(several.where(f"lo <> hi AND centres > {more}").select("bucket"), "bucket")

    rest = mixed(buckets, "true", 0).select("node").distinct()
    groups = scratch.write(mixed(prefixes(sets.join(rest, "node"), percent), "short", 0), "prefixes")
    scratch.drop(buckets, links)
    # In what follows a star's centre is the smaller set; only few sets of a group of frequent shingles can be one.
    shared = F.least(F.col("cn") - F.col("cplace"), F.col("n") - F.col("place"))
    fits = (F.struct("n", "node") > F.struct("cn", "centre")) & (100 * F.col("cn") >= percent * F.col("n")) & (shared * (100 + percent) >= percent * (F.col("n") + F.col("cn")))
    done, stars = 0, 1
    while not groups.isEmpty():
        centres = groups.where("short").withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy("node"))).where(f"rank <= {done + stars}")
        centres = centres.where(f"rank > {done}").select("bucket", F.col("node").alias("centre"), F.col("n").alias("cn"), F.col("place").alias("cplace"), F.col("root").alias("croot"))
        pairs = groups.join(centres, "bucket").where("root <> croot").where(fits).select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
        new = scratch.write(confirm(pairs, sets, percent), "links")
        done, stars = done + stars, stars * 4
        if not new.isEmpty():
            roots = merge(roots, new, scratch)
        left = scratch.write(mixed(groups, "short", done), "prefixes")
        scratch.drop(groups, new)
        groups = left
    scratch.drop(groups, sets)
    return roots
