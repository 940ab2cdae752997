"""Fill-in-the-middle rewriting: whole texts cut at two token ranks found with an indexable skip list.

The bottom lane links the tokens of a text, every express lane above it about every fourth node of the lane below; each
link carries how many tokens and how many code points it spans. A rank is reached from the top lane by following links
while their tokens fit, then going down; the widths passed add up to the code-point place of the cut. The lists of all
texts of a batch are stored in one array per lane and searched together, one step of all searches at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.llm.common import fresh
from sparkeval.llm.textbits import U, chunks, mix, text_bytes

#: A node rises to the next lane with chance 1 / 2^RISE_BITS.
RISE_BITS = 2
MARKS = ("<P>", "<S>", "<M>")


def token_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte places where tokens ``[A-Za-z]+|[^A-Za-z]`` of UTF-8 texts start, each text's range of tokens, and its range of code points.

    The third array gives, for every byte, the number of code points that start before it.
    """
    lower = data | 0x20
    letter = (lower >= 97) & (lower <= 122) & (data < 128)
    head = (data & 0xC0) != 0x80
    starts = head.copy()
    starts[1:] &= ~(letter[1:] & letter[:-1])
    firsts = offsets[:-1][np.diff(offsets) > 0]
    starts[firsts] = True
    points = np.concatenate([[0], np.cumsum(head)])
    places = np.flatnonzero(starts)
    return places, np.searchsorted(places, offsets), points


class SkipLists:
    """One indexable skip list for each text of a batch, given the token ranges and each token's code-point width."""

    def __init__(self, tokens: np.ndarray, widths: np.ndarray):
        # Node k > 0 of a text stands at the end of its k-th token; node 0 is the head, which is in every lane.
        n = np.diff(tokens)
        first = tokens[:-1] + np.arange(len(n))
        self.heads = [first]
        rank = np.arange(tokens[-1] + len(n)) - np.repeat(first, n + 1)
        place = np.zeros(len(rank), np.int64)
        place[rank > 0] = widths
        place = np.cumsum(place) if len(place) else place
        with np.errstate(over="ignore"):
            chance = mix(rank.astype(U) + U(0x9E3779B97F4A7C15))
        nodes = np.arange(len(rank))
        self.units: list[np.ndarray] = []
        self.points: list[np.ndarray] = []
        self.down: list[np.ndarray] = []
        lane = 0
        while True:
            # Link i leads from node i of the lane to the next one of the same text; the last node of a text has none.
            ends = np.append(rank[nodes][1:] == 0, True) if len(nodes) else np.zeros(0, bool)
            units = np.append(np.diff(rank[nodes]), 0)[: len(nodes)]
            points = np.append(np.diff(place[nodes]), 0)[: len(nodes)]
            units[ends] = np.iinfo(np.int64).max
            self.units.append(units)
            self.points.append(points)
            lane += 1
            up = (rank[nodes] == 0) | ((chance[nodes] & U((1 << (RISE_BITS * lane)) - 1)) == 0)
            if up.sum() == len(n):  # nothing but heads would rise
                return
            self.down.append(np.flatnonzero(up))
            self.heads.append(np.searchsorted(self.down[-1], self.heads[-1]))
            nodes = nodes[up]

    def seek(self, texts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Code points before the cut after ``ranks`` tokens (none beyond the text's tokens) of each text asked for."""
        at = self.heads[-1][texts]
        left = ranks.astype(np.int64).copy()
        passed = np.zeros(len(at), np.int64)
        for lane in range(len(self.units) - 1, -1, -1):
            units, points = self.units[lane], self.points[lane]
            moving = np.flatnonzero(units[at] <= left) if len(at) else at
            while len(moving):
                here = at[moving]
                left[moving] -= units[here]
                passed[moving] += points[here]
                at[moving] = here + 1
                moving = moving[units[at[moving]] <= left[moving]]
            if lane:
                at = self.down[lane - 1][at]
        return passed


def random_words(seed: Column, count: int = 4) -> list[Column]:
    """The first 8-digit groups of the hex SHA-256 of the seed as unsigned integers."""
    digest = F.sha2(seed, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(count)]


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", plain_percent: int = 10, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """All columns of ``docs`` and ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A text of n tokens is cut after the smaller and the larger of h1 % (n + 1) and h2 % (n + 1) tokens; h1 to h4 come from
    the SHA-256 of ``seed:key``, so a row gets the same result wherever and however often it is computed. Form is plain (the
    text as it is, lengths null) for ``plain_percent`` of the rows and for texts that are empty or hold one of the marks;
    else spm for ``spm_percent`` of them and psm. Null texts are empty; a null key counts as an empty one; repeated rows get
    equal results; names that clash get underscores; an empty table gives an empty one. Nothing is shuffled.
    """
    names: list[str] = []
    for name in ("n", "form", "prefix_chars", "middle_chars", "output"):
        names.append(fresh([*docs.columns, *names], name))
    hashes: list[str] = []
    for i in range(4):
        hashes.append(fresh([*docs.columns, *names, *hashes], f"h{i + 1}"))
    columns = list(docs.columns)
    seeded = docs.select("*", *[h.alias(c) for h, c in zip(random_words(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), hashes)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text, 4 << 20):
            h = [part.column(len(columns) + i).to_numpy() for i in range(4)]
            new = _rewrite(part.column(columns.index(text)), h, plain_percent, spm_percent)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], *new], names=[*columns, *names])

    kinds = ("bigint", "string", "bigint", "bigint", "string")
    added = T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
    return seeded.mapInArrow(run, T.StructType([*docs.schema.fields, *added.fields]))


def _rewrite(texts: pa.Array, h: list[np.ndarray], plain_percent: int, spm_percent: int) -> list[pa.Array]:
    data, offsets = text_bytes(texts)
    places, tokens, points = token_starts(data, offsets)
    ends = np.append(places[1:], len(data))[: len(places)]
    lists = SkipLists(tokens, points[ends] - points[places])
    n = np.diff(tokens)
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    each = np.arange(len(n))
    low = lists.seek(each, np.minimum(a, b))
    high = lists.seek(each, np.maximum(a, b))
    out, forms = [], []
    raw = data.tobytes()
    for i in range(len(n)):
        start, end = int(offsets[i]), int(offsets[i + 1])
        value = raw[start:end].decode()
        if not value or any(m in value for m in MARKS) or h[2][i] % 100 >= 100 - plain_percent:
            forms.append("plain")
            out.append(value)
            continue
        prefix, middle, suffix = value[: low[i]], value[low[i] : high[i]], value[high[i] :]
        if h[3][i] % 100 < spm_percent:
            forms.append("spm")
            out.append(f"{MARKS[1]}{suffix}{MARKS[0]}{prefix}{MARKS[2]}{middle}")
        else:
            forms.append("psm")
            out.append(f"{MARKS[0]}{prefix}{MARKS[1]}{suffix}{MARKS[2]}{middle}")
    plain = np.array([f == "plain" for f in forms], bool)
    lengths = [pa.array(x, pa.int64(), mask=plain) for x in (low, high - low)]
    return [pa.array(n, pa.int64()), pa.array(forms, pa.string()), *lengths, pa.array(out, pa.string())]


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` rewrote, from its output and form alone. No mark is in a rewritten text, so the first ones count."""

    def pieces(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        at = F.position(F.lit(second), output)
        end = F.position(F.lit(third), output)
        begin = F.lit(len(first) + 1)
        one = F.substring(output, begin, at - begin)
        two = F.substring(output, at + len(second), end - at - len(second))
        return one, two, F.substring(output, end + len(third), F.length(output))

    p, s, m = MARKS
    prefix, suffix, middle = pieces(p, s, m)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = pieces(s, p, m)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and SHA-256 of the output and of the text rebuilt from it."""
    out = fill_in_middle(docs.select("doc_id", "text"))
    hashes = [F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)
