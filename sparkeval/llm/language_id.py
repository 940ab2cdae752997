"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters: the product of their vectors, each rolled
by its place. A document's vector bundles (adds) the vectors of its n-grams, a language's prototype those of its documents,
each scaled to one length. The prediction is the prototype of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.llm.common import fresh
from sparkeval.llm.textbits import chunks, mix

DIM, GRAM, CODES = 512, 3, 64


def letter_table() -> np.ndarray:
    """Code of every UTF-16 unit: 0 for no letter, 1 to 26 for a-z, 27 to 63 for other letters by a hash of the lower-cased one.

    Units of pairs beyond the first plane count as letters of their own.
    """
    table = np.zeros(1 << 16, np.uint8)
    for unit in range(1 << 16):
        if 0xD800 <= unit < 0xE000:
            low = unit
        elif chr(unit).isalpha():
            low = ord(chr(unit).lower()[0])
        else:
            continue
        table[unit] = low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % (CODES - 27)
    return table


def grams(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram codes of all texts end to end, each text's range, and which texts have a letter.

    A run of other characters is one gap (code 0), and a gap stands before and after each text.
    """
    units = [np.frombuffer(f" {t or ''} ".encode("utf-16-le", "surrogatepass"), np.uint16) for t in texts]
    codes = table[np.concatenate(units)] if units else np.zeros(0, np.uint8)
    ends = np.cumsum([len(u) for u in units])
    owner = np.repeat(np.arange(len(units)), [len(u) for u in units])
    letter = (codes > 0) & ((np.concatenate(units) & 0xF800) != 0xD800) if units else codes > 0
    lettered = np.bincount(owner[letter], minlength=len(units)) > 0
    for i in np.unique(owner[(codes > 0) & ~letter]):  # letters beyond the first plane
        lettered[i] = lettered[i] or any(map(str.isalpha, texts[i]))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep].astype(np.int64), owner[keep]
    if len(codes) < GRAM:
        return np.zeros(0, np.int64), np.zeros(len(units) + 1, np.int64), lettered
    found = (codes[:-2] * CODES + codes[1:-1]) * CODES + codes[2:]
    inside = (owner[:-2] == owner[2:]) & (codes[1:-1] + codes[:-2] > 0)
    return found[inside], np.concatenate([[0], np.cumsum(np.bincount(owner[:-2][inside], minlength=len(units)))]), lettered


class Space:
    """The random letter vectors, and the vectors of the n-grams seen so far."""

    def __init__(self, seed: int = 5):
        letters = np.random.default_rng(seed).choice(np.asarray([-1, 1], np.int8), (CODES, DIM))
        self.rolled = [np.roll(letters, GRAM - 1 - k, axis=1) for k in range(GRAM)]

    def vectors(self, gram: np.ndarray) -> np.ndarray:
        a, b, c = self.rolled
        return (a[gram // CODES**2] * b[gram // CODES % CODES] * c[gram % CODES]).astype(np.float32)

    def bundle(self, gram: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-gram vectors, in slices of bounded size."""
        total = np.zeros(DIM)
        for at in range(0, len(gram), 4096):
            total += counts[at : at + 4096].astype(np.float32) @ self.vectors(gram[at : at + 4096])
        return total


def train(docs: DataFrame, label: str = "lang", text: str = "text") -> dict[str, np.ndarray]:
    """Prototype of each language, from all rows of ``docs`` with a label and a text that has a letter.

    Tasks add up scaled n-gram counts by language; what reaches the driver is a vector for each language.
    """
    known = docs.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).where("label IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, space, sums = letter_table(), Space(), {}
        for part in chunks(batches, "text"):
            found, ranges, _ = grams(part.column("text").to_pylist(), table)
            for label_, a, b in zip(part.column("label").to_pylist(), ranges[:-1], ranges[1:]):
                if b > a:
                    sums.setdefault(label_, np.zeros(CODES**GRAM, np.float32))
                    np.add.at(sums[label_], found[a:b], np.float32(1 / (b - a)))
            if len(sums) > 16:
                yield from out(sums, space)
                sums = {}
        yield from out(sums, space)

    def out(sums: dict[str, np.ndarray], space: Space) -> Iterator[pa.RecordBatch]:
        for label_, counts in sums.items():
            gram = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label_]), pa.array([space.bundle(gram, counts[gram]).tolist()], pa.list_(pa.float64()))], names=["label", "v"])

    rows = known.mapInArrow(run, "label string, v array<double>").select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.sum("x").alias("x"))
    vectors: dict[str, np.ndarray] = {}
    for label_, i, x in rows.orderBy("label", "i").toLocalIterator():
        vectors.setdefault(label_, np.zeros(DIM))[i] = x
    return {k: v / np.linalg.norm(v) for k, v in vectors.items() if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs``, the predicted language of each whole text, and (1 + cosine) / 2 of its prototype.

    A null text, or one without a letter, is ``und`` with score 0, and so is all text if nothing was learned. Equal cosines go
    to the first language in the alphabet. Clashing columns get underscores. Texts are read in slices, never cut.
    """
    first = fresh(docs.columns, names[0])
    second = fresh([*docs.columns, first], names[1])
    labels = sorted(prototypes)
    sent = docs.sparkSession.sparkContext.broadcast(np.stack([prototypes[x] for x in labels]) if labels else np.zeros((0, DIM)))
    columns = list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, space = letter_table(), Space()
        for part in chunks(batches, text):
            found, ranges, lettered = grams(part.column(columns.index(text)).to_pylist(), table)
            langs, scores = [], []
            for a, b, some in zip(ranges[:-1], ranges[1:], lettered):
                if not some or not labels:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                gram, counts = np.unique(found[a:b], return_counts=True)
                own = space.bundle(gram, counts)
                cosine = sent.value @ own / max(np.linalg.norm(own), 1e-12)
                best = int(cosine.argmax())
                langs.append(labels[best])
                scores.append(float(np.clip((1 + cosine[best]) / 2, 0, 1)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*columns, first, second])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(first, T.StringType()), T.StructField(second, T.DoubleType())]))
