"""Elias-Fano sequences: non-decreasing integers in about 2 + log2(range / count) bits each, with sampled select."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 512


class EliasFano:
    """``values[i]`` is its low bits, packed, and a one at bit ``(values[i] >> width) + i`` of the high part.

    The select structure holds the word of every 512th one (32 bits each); from there a query counts the ones of a few words.
    """

    def __init__(self, count: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.width, self.low, self.high, self.samples = count, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if n and (np.diff(values.view(np.int64)) < 0).any():
            raise ValueError("values must not decrease")
        width = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = np.arange(width, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> bits) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) // 64 + 1 if n else 0), np.uint64)
        np.bitwise_or.at(high, ones // 64, np.uint64(1) << (ones % 64).astype(np.uint64))
        return cls(n, width, low, high, (ones[::SAMPLE] // 64).astype(np.uint32))

    def select(self, at: np.ndarray) -> np.ndarray:
        """Bit positions of the ones numbered ``at``."""
        at = np.asarray(at, np.int64)
        word = self.samples[at // SAMPLE].astype(np.int64)
        # Ones in the sampled word before the sampled one, so that counting starts at the word's first bit.
        left = at % SAMPLE + self._before()[at // SAMPLE]
        open_ = np.arange(len(at))
        while len(open_):
            ones = np.bitwise_count(self.high[word[open_]]).astype(np.int64)
            open_, ones = open_[left[open_] >= ones], ones[left[open_] >= ones]
            left[open_] -= ones
            word[open_] += 1
        bits, position = self.high[word], np.zeros(len(at), np.int64)
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= ones
            left = np.where(up, left - ones, left)
            bits = np.where(up, bits >> np.uint64(half), bits)
            position += np.where(up, half, 0)
        return word * 64 + position

    def _before(self) -> np.ndarray:
        if not hasattr(self, "_rank"):
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high), dtype=np.int64)])
            self._rank = np.arange(len(self.samples)) * SAMPLE - ranks[self.samples.astype(np.int64)]
        return self._rank

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        """The values numbered ``at``, as int64."""
        at = np.asarray(at, np.int64)
        high = self.select(at) - at
        place = at[:, None] * self.width + np.arange(self.width)
        bits = (self.low[place // 8] >> (place % 8).astype(np.uint8)) & 1 if self.width else np.zeros((len(at), 0), np.uint8)
        return (high << self.width) + (bits.astype(np.int64) << np.arange(self.width)).sum(1)

    def to_bytes(self) -> bytes:
        head = struct.pack("<QIIII", self.count, self.width, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.astype("<u8").tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[EliasFano, int]:
        """The sequence at the start of ``data``, and its size in bytes."""
        count, width, low, high, samples = struct.unpack_from("<QIIII", data)
        a = 24
        b, c = a + low, a + low + 8 * high
        end = c + 4 * samples
        return cls(count, width, np.frombuffer(data[a:b], np.uint8), np.frombuffer(data[b:c], "<u8"), np.frombuffer(data[c:end], "<u4")), end
