"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A passage is a run of words; its encoding counts byte kinds, word shapes, repeats and hashed words. A gated attention network
learns from document labels how much each passage counts: z = sum of a_k h_k with h_k = tanh(W x_k) and a the softmax over the
passages of w . (tanh(V h_k) * sigmoid(U h_k)); the score is sigmoid(c . z + b).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.llm.common import fresh
from sparkeval.llm.textbits import U, chunks, mix, spans, text_bytes, word_hashes

PASSAGE = 64  # words
HASHED = 64  # slots of hashed words
#: Byte kinds: 0 white space, 1 a-z, 2 A-Z, 3 digits, 4 .,;:  5 other ASCII marks, 6 line ends, 7 bytes of other letters, 8 the rest.
KINDS = 9
WIDTH = KINDS + 7 + HASHED


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, 5)
    kinds[[32, 9, 11, 12]], kinds[[10, 13]] = 0, 6
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 1, 2, 3, 7
    kinds[[44, 46, 58, 59]] = 4
    kinds[:9], kinds[14:32], kinds[127] = 8, 8, 8
    return kinds


def encode_passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Encodings of the passages of all texts, and the range of each text's passages; a text without words is one zero passage."""
    data, offsets = text_bytes(texts)
    starts, words = spans(data, offsets)
    hashes, _ = word_hashes(texts)
    count = np.diff(words)
    made = np.maximum(-(-count // PASSAGE), 1)
    ranges = np.concatenate([[0], np.cumsum(made)])
    total = int(ranges[-1])
    passage_of_word = np.repeat(ranges[:-1], count) + (np.arange(len(starts)) - np.repeat(words[:-1], count)) // PASSAGE
    out = np.zeros((total, WIDTH), np.float32)
    if not len(starts):
        return out, ranges
    # Bytes before a word belong to its passage, those after the last word to the last one.
    owner = np.repeat(passage_of_word, np.diff(np.concatenate([starts, [len(data)]])))
    kinds = np.bincount(owner * KINDS + byte_kinds()[data[starts[0] :]], minlength=total * KINDS).reshape(total, KINDS)
    out[:, :KINDS] = kinds / np.maximum(kinds.sum(1, keepdims=True), 1)
    words_in = np.bincount(passage_of_word, minlength=total)
    some = np.maximum(words_in, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return np.bincount(passage_of_word[mask], minlength=total) / some

    first = data[starts]
    after = np.concatenate([starts[1:], [len(data)]])
    upper = (first >= 65) & (first <= 90)
    second = data[np.minimum(starts + 1, len(data) - 1)]
    again = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (passage_of_word[1:] == passage_of_word[:-1])])
    last = data[np.maximum(after - 2, starts)]
    out[:, KINDS] = share(upper)
    out[:, KINDS + 1] = share(upper & (second >= 65) & (second <= 90))
    out[:, KINDS + 2] = share(again)
    out[:, KINDS + 3] = share((last < 48) & (last > 32))
    out[:, KINDS + 4] = share(after - starts <= 2)
    distinct = np.unique(passage_of_word.astype(U) << U(40) ^ (hashes >> U(24)))
    out[:, KINDS + 5] = np.bincount((distinct >> U(40)).astype(np.int64), minlength=total) / some if total < 1 << 24 else 0
    out[:, KINDS + 6] = np.log1p(words_in) / np.log1p(PASSAGE)
    slots = np.bincount(passage_of_word * HASHED + (mix(hashes) >> U(58)).astype(np.int64), minlength=total * HASHED)
    out[:, KINDS + 7 :] = np.sqrt(slots.reshape(total, HASHED) / some[:, None])
    return out, ranges


class AttentionMIL:
    """Gated attention pooling over the passages of each bag, trained with Adam on the logistic loss."""

    def __init__(self, width: int = WIDTH, hidden: int = 32, gate: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)

        def start(a: int, b: int) -> np.ndarray:
            return (rng.normal(size=(a, b)) / np.sqrt(a)).astype(np.float64)

        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.p = {"W": start(width, hidden), "Wb": np.zeros(hidden), "V": start(hidden, gate), "U": start(hidden, gate), "w": start(gate, 1), "c": start(hidden, 1), "b": np.zeros(1)}

    def state(self) -> dict[str, np.ndarray]:
        return {**self.p, "mean": self.mean, "scale": self.scale}

    @classmethod
    def of(cls, state: dict[str, np.ndarray]) -> AttentionMIL:
        model = cls()
        model.p = {k: v for k, v in state.items() if k not in ("mean", "scale")}
        model.mean, model.scale = state["mean"], state["scale"]
        return model

    def _forward(self, x: np.ndarray, heads: np.ndarray, bag: np.ndarray) -> dict:
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["Wb"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = ((t * g) @ p["w"])[:, 0]
        e = np.exp(e - np.maximum.reduceat(e, heads)[bag])
        a = e / np.add.reduceat(e, heads)[bag]
        z = np.add.reduceat(a[:, None] * h, heads)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)[:, 0]))}

    def score(self, x: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        bag = np.repeat(np.arange(len(ranges) - 1), np.diff(ranges))
        return self._forward(x.astype(np.float64), ranges[:-1], bag)["y"]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 3e-3, seed: int = 11) -> AttentionMIL:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 0.02
        rng, step = np.random.default_rng(seed), 0
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        # Both labels count alike, however rare one is.
        share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
        weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                sizes = np.asarray([len(bags[i]) for i in rows])
                heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                bag = np.repeat(np.arange(len(rows)), sizes)
                step += 1
                grads = self._gradient(np.concatenate([bags[i] for i in rows]), heads, bag, labels[rows], weights[rows] / len(rows))
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    v[k] = 0.999 * v[k] + 0.001 * grad**2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradient(self, x: np.ndarray, heads: np.ndarray, bag: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict:
        p, f = self.p, self._forward(x, heads, bag)
        dy = ((f["y"] - labels) * weights)[:, None]
        dz = (dy @ p["c"].T)[bag]
        da = (dz * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, heads)[bag])
        dtg = de[:, None] @ p["w"].T
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dx, "Wb": dx.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de[:, None], "c": f["z"].T @ dy, "b": dy.sum(0)}


def fold(key: str = "doc_id"):
    """crc32 of the id as text, modulo 4; a null id is in no fold. Fold 2 is held out."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, sample: int = 4000, label: str = "quality", seed: int = 7) -> AttentionMIL | None:
    """A model of at most ``sample`` labelled documents (the smallest hashes of doc_id) outside the held-out fold.

    ``sample`` is the documented bound of what the driver gathers: passage encodings of so many whole texts. Rows with a null
    id, label or text teach nothing; an id with several labels or texts counts with each. None if no row is left. With one
    label only, the model scores that label for everything.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)").where(fold("id") != 2)
    picked = known.orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), "text").where("text IS NOT NULL").join(picked, "id").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            x, ranges = encode_passages(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array([x[a:b].tobytes() for a, b in zip(ranges[:-1], ranges[1:])], pa.binary())], names=["label", "x"])

    rows = sorted((r[0], bytes(r[1])) for r in texts.mapInArrow(run, "label int, x binary").toLocalIterator())
    if not rows:
        return None
    model = AttentionMIL(seed=seed)
    bags = [np.frombuffer(x, np.float32).reshape(-1, WIDTH).astype(np.float64) for _, x in rows]
    y = np.asarray([r[0] for r in rows], np.float64)
    if y.min() == y.max():
        model.p["c"][:], model.p["b"][:] = 0, 30 if y[0] else -30
        return model
    return model.fit(bags, y)


def score(docs: DataFrame, model: AttentionMIL | None, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of each whole text; without a model 0.5.

    Null, empty and wordless texts are one zero passage and get its score; nothing else of a row is read. Repeated rows get
    equal scores. A clashing column name gets underscores. A text may be of any length: passages are scored in slices.
    """
    name = fresh(docs.columns, name)
    sent = docs.sparkSession.sparkContext.broadcast(None if model is None else model.state())
    columns = list(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None if sent.value is None else AttentionMIL.of(sent.value)
        for part in chunks(batches, text):
            if own is None:
                scores = np.full(part.num_rows, 0.5)
            else:
                scores = own.score(*encode_passages(part.column(columns.index(text))))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*columns, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))

