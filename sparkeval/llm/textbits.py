"""Words and word shingles of whole Arrow text columns as 64-bit hashes, a few numpy passes over the bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text (one whole text at least), so that memory does not depend on the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end and each text's offsets; a null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte of every run of bytes outside space and 0x09-0x0D, and the number of such words before each text."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = solid[heads]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, A-Z lower-cased, and the range of each text's words."""
    data, offsets = text_bytes(texts)
    starts, words = spans(data, offsets)
    if not len(starts):
        return np.zeros(0, U), words
    codes = mix(np.arange(1, 257, dtype=U) * U(_ODD)) | U(1)
    codes[65:91] = codes[97:123]
    codes[[9, 10, 11, 12, 13, 32]] = 0
    # The weight of byte i is P^i; dividing a word's sum by P^start makes it independent of where the word stands.
    with np.errstate(over="ignore"):
        step, back = U(0xD1342543DE82EF95), U(pow(0xD1342543DE82EF95, -1, 1 << 64))
        sums = np.add.reduceat(codes[data] * _powers(step, len(data)), starts)
        return mix(sums * _powers(back, len(data))[starts]), words


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def shingle_hashes(hashes: np.ndarray, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words in text order and each text's range; a shorter text is one shingle."""
    count = np.diff(words)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    ranges = np.concatenate([[0], np.cumsum(made)])
    with np.errstate(over="ignore"):
        salt = mix(np.arange(1, width + 1, dtype=U) * U(0xA24BAED4963EE407)) | U(1)
        total = hashes * salt[0]
        ends = np.repeat(words[1:], count)
        for j in range(1, width):
            inside = np.arange(len(hashes) - j) + j < ends[: len(hashes) - j] if j < len(hashes) else np.zeros(0, bool)
            if len(inside):
                total[: len(inside)] += np.where(inside, hashes[j:] * salt[j], U(0))
        at = np.arange(ranges[-1]) + np.repeat(words[:-1] - ranges[:-1], made)
        return mix(total[at]), ranges
