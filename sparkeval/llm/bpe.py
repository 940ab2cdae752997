"""Byte-level BPE: encoding by rank order with a segment tree over byte positions, and decoding."""

from __future__ import annotations

import base64
import gc
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.llm.common import file_bytes, fresh
from sparkeval.llm.textbits import chunks

NONE = 1 << 60


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a tiktoken file: base64 of the bytes and the id, one pair per line."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class MergeTree:
    """Encoder of one vocabulary.

    The leaves of a segment tree are the byte positions of a piece. A leaf holds the rank of the pair that begins there
    (a live token and its right neighbour) times the piece's size plus the position, so an inner node's minimum is the
    leftmost minimum rank. A merge reads the root, joins the two tokens and updates three leaves: the joined token's, its
    left neighbour's and the dead one's, each with log2(size) steps.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def piece(self, data: bytes) -> list[int]:
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        size = 1 << (n - 1).bit_length()
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                tree[size + i] = rank * size + i
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after = list(range(1, n + 1))  # start of the token to the right; n ends the piece
        before = list(range(-1, n - 1))

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                best = a if a < b else b
                if tree[i] == best:
                    return
                tree[i] = best
                i >>= 1

        def pair(i: int) -> int:
            right = after[i]
            if right >= n:
                return NONE
            rank = ranks.get(data[i : after[right]])
            return NONE if rank is None else rank * size + i

        while tree[1] < NONE:
            i = tree[1] % size
            gone = after[i]
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            put(gone, NONE)
            put(i, pair(i))
            if before[i] >= 0:
                put(before[i], pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return out


class MergeForest:
    """The same trees for many short pieces at once: row r of the arrays is the tree of piece r, and every step merges one pair in each."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte = np.asarray([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.asarray(sorted(pairs), np.int64)
        self.joined = np.asarray([pairs[k] for k in self.keys.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], NONE)

    def pieces(self, data: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of pieces of one size class: at most ``size`` bytes each, a power of two."""
        n, size = len(data), 1 << max(1, (max(map(len, data)) - 1).bit_length())
        lens = np.asarray([len(x) for x in data])
        token = self.byte[np.frombuffer(b"".join(x.ljust(size, b"\0") for x in data), np.uint8).reshape(n, size)]
        place = np.arange(size)
        after = np.broadcast_to(place + 1, (n, size)).copy()
        before = np.broadcast_to(place - 1, (n, size)).copy()
        tree = np.full((n, 2 * size), NONE, np.int64)
        ranks = self.rank(token[:, :-1], token[:, 1:])
        fits = (ranks < NONE) & (place[1:] < lens[:, None])
        tree[:, size : 2 * size - 1] = np.where(fits, ranks * size + place[:-1], NONE)
        at = size
        while at > 1:
            tree[:, at // 2 : at] = np.minimum(tree[:, at : 2 * at : 2], tree[:, at + 1 : 2 * at : 2])
            at //= 2
        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            best = tree[row, 1]
            i = best % size
            gone = after[row, i]
            right = after[row, gone]
            left = before[row, i]
            token[row, i] = best // size
            after[row, i] = right
            token[row, gone] = -1
            has_right, has_left = right < lens[row], left >= 0
            before[row[has_right], right[has_right]] = i[has_right]
            new = np.full(len(row), NONE, np.int64)
            found = self.rank(token[row[has_right], i[has_right]], token[row[has_right], right[has_right]])
            new[has_right] = np.where(found < NONE, found * size + i[has_right], NONE)
            tree[row, size + i] = new
            tree[row, size + gone] = NONE
            found = self.rank(token[row[has_left], left[has_left]], token[row[has_left], i[has_left]])
            tree[row[has_left], size + left[has_left]] = np.where(found < NONE, found * size + left[has_left], NONE)
            rows = np.concatenate([row, row, row[has_left]])
            at = np.concatenate([i, gone, left[has_left]]) + size
            while at[0] > 1:
                at >>= 1
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
            row = row[tree[row, 1] < NONE]
        live = (token >= 0) & (place < lens[:, None])
        flat = token[live].astype("<u4").tobytes()
        ends = (np.cumsum(live.sum(1)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Ids of whole texts. Each match of ``pattern`` is encoded separately; a bounded memo keeps what recurs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = 1 << 20, short: int = 64):
        self.tree, self.forest, self.split = MergeTree(ranks), MergeForest(ranks), regex.compile(pattern)
        self.limit, self.short = memo, short
        self.words: dict[str, bytes] = {}
        self.token = {v: k for k, v in ranks.items()}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [split_words(t) for t in texts]
        if len(self.words) >= self.limit:
            self.words.clear()
        known = self.words
        new = set().union(*(text[1:] for text in words)).difference(known)
        known.update(zip(new, self._encode([" " + w for w in new])))
        heads = self._encode([text[0] for text in words])
        out = [head + b"".join(map(known.__getitem__, text[1:])) for head, text in zip(heads, words)]
        for w in new:
            if len(w) > self.short:
                del known[w]
        return out

    def _encode(self, words: list[str]) -> Iterable[bytes]:
        cuts = [[p.encode() for p in self.split.findall(w)] for w in words]
        ids: dict[bytes, bytes] = {}
        classes: dict[int, list[bytes]] = {}
        for piece in {p for cut in cuts for p in cut}:
            if piece in self.tree.ranks:
                ids[piece] = self.tree.ranks[piece].to_bytes(4, "little")
            elif len(piece) > self.short:
                ids[piece] = np.asarray(self.tree.piece(piece), "<u4").tobytes()
            else:
                classes.setdefault((len(piece) - 1).bit_length(), []).append(piece)
        for pieces in classes.values():
            for at in range(0, len(pieces), 8192):
                part = pieces[at : at + 8192]
                ids.update(zip(part, self.forest.pieces(part)))
        return (b"".join(map(ids.__getitem__, cut)) for cut in cuts)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids; an id outside the vocabulary raises KeyError."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


ODD_SPACE = re.compile(r" \s|\s ")
INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def split_words(text: str) -> list[str]:
    """The text cut at every space between two other non-space characters; each part but the first stands for a space and itself.

    No match of the usual patterns crosses such a cut: a match takes at most one leading space, and runs of white space end
    before the last space that a word follows.
    """
    return INNER_SPACE.split(text) if ODD_SPACE.search(text) or text[:1] == " " or text[-1:] == " " else text.split(" ")


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", memo: int = 1 << 20) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (little-endian uint32 bytes), ``n_tokens`` and ``decoded`` (the bytes of the ids).

    Whole texts, however long; a null text is empty: no ids, no bytes. Rows neither move nor meet, so repeated rows, null
    keys and hot sources need no care. A new column that would clash gets underscores before its name. An empty table
    gives an empty table. Runs of characters that no split pattern cuts are merged in n log n.
    """
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(file_bytes(spark, ranks_path))
    names = []
    for name in ("ids", "n_tokens", "decoded"):
        names.append(fresh([*docs.columns, *names], name))
    columns = list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the memo has no cycles, and collections would walk it again and again
        coder = Encoder(load_ranks(data.value), pattern, memo)
        for part in chunks(batches, text, 4 << 20):
            ids = coder.encode([t or "" for t in part.column(columns.index(text)).to_pylist()])
            new = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(coder.decode, ids), pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*columns, *names])

    added = T.StructType.fromDDL(f"`{names[0]}` binary, `{names[1]}` bigint, `{names[2]}` binary")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded bytes, in lowercase hex."""
    coded = encode_documents(docs.select("doc_id", "text"), ranks_path, pattern)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


