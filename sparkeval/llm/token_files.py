"""Token-id files: the ids of consecutive documents end to end, with Elias-Fano document boundaries and keys.

One file, little-endian: magic, the id array (16 bits an id when the vocabulary allows it, else 32), the boundaries (number
of ids before each document, and in all) and the doc_ids, both as Elias-Fano sequences with select samples, then a fixed
footer. Files are numbered in ascending order of doc_id; the manifest table holds each file's path and counts.
"""

from __future__ import annotations

import gc
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkeval.llm.bpe import split_words
from sparkeval.llm.common import file_bytes, materialize
from sparkeval.llm.elias_fano import EliasFano
from sparkeval.llm.textbits import chunks

MAGIC = b"EFTOKEN1"
FOOTER = "<QQqQIIQQ8s"  # documents, ids, smallest doc_id, null doc_ids, id bytes, end id, boundaries at, doc_ids at, magic
MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"


class LibraryEncoder:
    """Ids by the tokenizers library; words that recur are looked up (see ``split_words`` for why words may be encoded apart)."""

    def __init__(self, spec: bytes, memo: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(spec.decode())
        self.model.encode_special_tokens = True  # their strings in a text are ordinary text
        self.kind = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        self.words: dict[str, bytes] = {}
        self.limit = memo

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(found), self.kind).tobytes()
        ends = (np.cumsum([len(x) for x in found], dtype=np.int64) * self.kind.itemsize).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [split_words(t) for t in texts]
        if len(self.words) >= self.limit:
            self.words.clear()
        new = list(set().union(*(text[1:] for text in words)).difference(self.words))
        self.words.update(zip(new, self._ids([" " + w for w in new])))
        heads = self._ids([text[0] for text in words])
        out = [head + b"".join(map(self.words.__getitem__, text[1:])) for head, text in zip(heads, words)]
        for w in new:
            if len(w) > 64:
                del self.words[w]
        return out


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, text: str = "text", key: str = "doc_id", memo: int = 1 << 20, shard_bytes: int = 16 << 20) -> DataFrame:
    """Writes the files and returns the manifest: shard, path, n_docs, n_ids and ``start`` (ids in the files before).

    Documents go out in ascending ``key`` (null keys first, equal keys by text), each followed by ``end_id``. Whole texts;
    a null or empty text is its end id alone. Repeated rows are written as often as they occur. An empty table writes an
    empty manifest. A range of keys is one task and streams to its file; it is renamed when whole, so a task that runs
    again only replaces the same bytes. ``folder`` must be one that every executor reaches. Files hold about
    ``shard_bytes`` of text each.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(file_bytes(spark, vocabulary))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    ordered = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).repartitionByRange(int(total // shard_bytes) + 1, "key").sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        shard, coder = TaskContext.get().partitionId(), None
        keys, sizes, nulls, out = [], [], 0, None
        for part in chunks(batches, "text", 4 << 20):
            if out is None:
                coder = LibraryEncoder(spec.value, memo)
                fs, base = _open(folder)
                fs.create_dir(base, recursive=True)
                draft, final = f"{base}/.{shard:06d}-{uuid.uuid4().hex}", f"{base}/{shard:06d}.eft"
                out = fs.open_output_stream(draft)
                out.write(MAGIC)
                end = np.asarray([end_id], coder.kind).tobytes()
            ids = [x + end for x in coder.encode([t or "" for t in part.column("text").to_pylist()])]
            out.write(b"".join(ids))
            sizes.append(np.asarray([len(x) // coder.kind.itemsize for x in ids], np.int64))
            nulls += part.column("key").null_count
            keys.append(part.column("key").drop_null().to_numpy())
        if out is None:
            return
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        named = np.concatenate(keys)
        least = int(named[0]) if len(named) else 0
        parts = [EliasFano.of(bounds).to_bytes(), EliasFano.of(named - least).to_bytes()]
        at = len(MAGIC) + int(bounds[-1]) * coder.kind.itemsize
        out.write(b"".join(parts) + struct.pack(FOOTER, len(bounds) - 1, int(bounds[-1]), least, nulls, coder.kind.itemsize, end_id, at, at + len(parts[0]), MAGIC))
        out.close()
        fs.move(draft, final)
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([f"{folder}/{shard:06d}.eft"]), pa.array([len(bounds) - 1], pa.int64()), pa.array([int(bounds[-1])], pa.int64())], names=["shard", "path", "n_docs", "n_ids"])

    written = materialize(ordered.mapInArrow(run, MANIFEST), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


class TokenFile:
    """Random access to one file: offsets come from select on the boundaries, ids from one range read."""

    def __init__(self, path: str):
        fs, at = _open(path)
        self.file = fs.open_input_file(at)
        size = self.file.size()
        self.n_docs, self.n_ids, self.least, self.nulls, width, self.end_id, bounds_at, keys_at, magic = struct.unpack(FOOTER, self.file.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER)))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        tail = self.file.read_at(size - struct.calcsize(FOOTER) - bounds_at, bounds_at)
        self.bounds, _ = EliasFano.from_bytes(tail)
        self.keys, _ = EliasFano.from_bytes(tail[keys_at - bounds_at :])

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        named = self.keys[np.arange(max(first - self.nulls, 0), max(last - self.nulls, 0))] + self.least
        return [None] * (min(last, self.nulls) - min(first, self.nulls)) + named.tolist()

    def ids(self, first: int, last: int) -> list[np.ndarray]:
        """The ids of the documents from ``first`` up to ``last``, end ids included, as uint32."""
        bounds = self.bounds[np.arange(first, last + 1)]
        width = self.kind.itemsize
        data = self.file.read_at(int(bounds[-1] - bounds[0]) * width, len(MAGIC) + int(bounds[0]) * width)
        return np.split(np.frombuffer(data, self.kind).astype("<u4"), bounds[1:-1] - bounds[0])


def read_tokens(manifest: DataFrame, documents: int = 1024, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked, ids, of every document in the files."""
    columns = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n, start in zip(*(batch.column(c).to_pylist() for c in ("path", "n_docs", "start"))):
                file = TokenFile(path)
                for a in range(0, n, documents):
                    b = min(n, a + documents)
                    bounds, rows = file.bounds[np.arange(a, b + 1)], file.ids(a, b)
                    out = [pa.array(file.doc_ids(a, b), pa.int64()), pa.array(bounds[:-1] + start), pa.array(np.diff(bounds)), pa.array([zlib.crc32(x.tobytes()) for x in rows], pa.int64())]
                    if ids:
                        out.append(pa.array([x.tobytes() for x in rows], pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(out)])

    files = manifest.select("path", "n_docs", "start")
    return files.repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism)).mapInArrow(run, columns)


