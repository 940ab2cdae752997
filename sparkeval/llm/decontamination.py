"""Benchmark decontamination: MinHash containment search, partitioned by size, verified by exact shingle containment.

A document's sketch is a one-permutation MinHash whose number of bins grows with the document: the size class of n distinct
shingles has 2^j >= 8n bins, so a shingle that a short test item shares with a long document is the minimum of its bin with
a chance of at least 0.94, whatever the lengths. The items have one sketch for each size class of documents. One equal
minimum makes a candidate; an item of 10 shingles is missed with a chance below 1e-11. Items of fewer than 10 shingles are
looked up with all their shingles, so nothing of theirs is missed. Candidates are counted on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkeval.llm.textbits import chunks, shingle_hashes, word_hashes

#: Item shingles that one broadcast block may hold (8 bytes each, and a sketch of at most as many for each size class).
BLOCK_SHINGLES = 200_000
SMALL = 10
HITS = "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint, containment double"


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    found, ranges = shingle_hashes(*word_hashes(texts), width)
    return [np.unique(found[a:b]) for a, b in zip(ranges[:-1], ranges[1:])]


def minima(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The smallest hash of each of 2^bits bins that is not empty; the top bits name the bin."""
    bins = shingles >> np.uint64(64 - bits)
    return shingles[np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))] if len(shingles) else shingles


class ItemIndex:
    """The items of one block: their sets, and for each size class which items have which minimum."""

    def __init__(self, ids: list, sets: list[np.ndarray], threshold: float):
        self.ids, self.sets, self.threshold = ids, sets, threshold
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.small = self._table([(i, s) for i, s in enumerate(sets) if len(s) < SMALL])

    def _table(self, owned: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        values = np.concatenate([s for _, s in owned]) if owned else np.zeros(0, np.uint64)
        owners = np.repeat([i for i, _ in owned], [len(s) for _, s in owned]).astype(np.int64) if owned else np.zeros(0, np.int64)
        order = np.argsort(values, kind="stable")
        return values[order], owners[order]

    def _met(self, table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> set[int]:
        values, owners = table
        if not len(values):
            return set()
        at = np.searchsorted(values, hashes)
        hit = values[np.minimum(at, len(values) - 1)] == hashes
        if not hit.any():
            return set()
        ends = np.searchsorted(values, hashes[hit], side="right")
        return {int(o) for a, b in zip(at[hit], ends) for o in owners[a:b]}

    def search(self, shingles: np.ndarray) -> Iterator[tuple[int, int]]:
        """Items contained in a document's set to the threshold or more, and how many shingles they share."""
        if not len(shingles):
            return
        bits = min(40, (8 * len(shingles) - 1).bit_length())
        if bits not in self.classes:
            self.classes[bits] = self._table([(i, minima(s, bits)) for i, s in enumerate(self.sets) if len(s) >= SMALL])
        for i in sorted(self._met(self.classes[bits], minima(shingles, bits)) | self._met(self.small, shingles)):
            own = self.sets[i]
            at = np.minimum(np.searchsorted(shingles, own), len(shingles) - 1)
            shared = int((shingles[at] == own).sum())
            if shared >= self.threshold * len(own) - 1e-9:
                yield i, shared


def item_blocks(items: DataFrame, width: int, limit: int = BLOCK_SHINGLES) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(ids, sets) of the items in blocks of about ``limit`` shingles, one block on the driver at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            sets = shingle_sets(part.column("text"), width)
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["item_id", "shingles"])

    sets = items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(run, "item_id bigint, shingles binary").where("length(shingles) > 0")
    total = sets.agg(F.sum(F.length("shingles")) / 8).first()[0] or 0
    blocks = int(total // limit) + 1
    for block in range(blocks if total else 0):
        rows = sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == block).orderBy("item_id").collect()
        if rows:
            yield [r[0] for r in rows], [np.frombuffer(r[1], np.uint64) for r in rows]


def find_leaks(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_item (the item's shingles), n_shared and containment, one row for each item found in a document.

    Words are runs outside space and 0x09-0x0D with A-Z lower-cased; a text of fewer than ``width`` words is one shingle.
    Null and empty texts have no shingle and are in no row; a null id stays null; repeated rows are found as often as they
    occur; an empty table on either side gives none. Documents are read once for each block of items and never move.
    """
    spark, found = docs.sparkSession, None
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    for ids, sets in item_blocks(items, width):
        block = spark.sparkContext.broadcast((ids, sets))

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*block.value, threshold)
            for part in chunks(batches, "text"):
                keys, rows = part.column("doc_id").to_pylist(), []
                for key, shingles in zip(keys, shingle_sets(part.column("text"), width)):
                    rows += [(key, index.ids[i], len(index.sets[i]), n, n / len(index.sets[i])) for i, n in index.search(shingles)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["doc_id", "item_id", "n_item", "n_shared", "containment"])

        hits = texts.mapInArrow(run, HITS)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else spark.createDataFrame([], HITS)


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that contain no item; nulls and empty texts stay."""
    spark = docs.sparkSession
    for ids, sets in item_blocks(items, width):
        block = spark.sparkContext.broadcast((ids, sets))

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(*block.value, threshold)
            for part in chunks(batches, text):
                clean = [next(index.search(s), None) is None for s in shingle_sets(part.column(text), width)]
                yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


