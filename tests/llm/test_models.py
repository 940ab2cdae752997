"""Classifiers by held-out accuracy, gradients by differences."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sparkeval.llm import language_id, quality

FOLDER = "/root/testdata/sf0.01"


def test__gradients_match_differences():
    rng = np.random.default_rng(0)
    model = quality.AttentionMIL(width=6, hidden=5, gate=4)
    x, sizes = rng.normal(size=(11, 6)), np.asarray([3, 1, 5, 2])
    heads, bag = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(4), sizes)
    labels, weights = np.asarray([1.0, 0, 0, 1]), np.asarray([0.3, 0.2, 0.4, 0.1])

    def loss():
        y = model._forward(x, heads, bag)["y"]
        return -(weights * (labels * np.log(y) + (1 - labels) * np.log(1 - y))).sum()

    for name, grad in model._gradient(x, heads, bag, labels, weights).items():
        for at in list(np.ndindex(model.p[name].shape))[:6]:
            kept = model.p[name][at]
            model.p[name][at] = kept + 1e-6
            up = loss()
            model.p[name][at] = kept - 1e-6
            assert abs((up - loss()) / 2e-6 - grad[at]) < 1e-6, name
            model.p[name][at] = kept


def test__attention_finds_the_bad_passage():
    """One odd passage decides a bag, and gets the attention."""
    rng = np.random.default_rng(3)
    bags = [rng.normal(size=(rng.integers(2, 12), 8)) for _ in range(400)]
    labels = rng.integers(0, 2, 400).astype(float)
    for bag, label in zip(bags, labels):
        if not label:
            bag[rng.integers(len(bag))] += 4
    model = quality.AttentionMIL(width=8).fit(bags[:300], labels[:300])
    ranges = np.concatenate([[0], np.cumsum([len(b) for b in bags[300:]])])
    assert ((model.score(np.concatenate(bags[300:]), ranges) > 0.5) == labels[300:]).mean() > 0.9


def test__quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where(quality.fold() == 2)
    rows = scored.select("score", "quality").collect()
    assert len(rows) > 50 and np.mean([(r.score >= 0.7) == (r.quality == 1) for r in rows]) > 0.93
    assert spark.range(20).select(F.col("id"), quality.fold("id").alias("f")).where("id = 17").first().f == zlib.crc32(b"17") % 4


def test__quality_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "good words here"), (4, "good words here"), (None, "x " * 30000), (5, "!!!"), (6, "é" * 9000)]
    table = docs(rows, extra=("score",))
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (6, 1, 0), (1, 0, 1), (None, 1, 1), (9, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.train(table, labels)
    out = quality.score(table, model)
    assert out.columns == [*table.columns, "_score"]
    scores = [r["_score"] for r in out.collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores) and scores[3] == scores[4] and scores[0] == scores[1]
    assert quality.train(table, labels.limit(0)) is None and quality.train(docs([]), labels) is None
    assert {r["_score"] for r in quality.score(table, None).collect()} == {0.5}
    one = quality.train(table, labels.where("quality = 1"))
    assert min(r["_score"] for r in quality.score(table, one).collect()) > 0.99
    assert quality.score(docs([]), model).count() == 0


def test__passages_cover_whole_texts():
    x, ranges = quality.encode_passages(pa.array(["w " * 130, None, "a", ""]))
    assert np.diff(ranges).tolist() == [3, 1, 1, 1] and x.shape == (6, quality.WIDTH)
    alone, _ = quality.encode_passages(pa.array(["a"]))
    assert np.allclose(alone[0], x[4]) and not x[3].any()


def test__language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = language_id.predict(docs, language_id.train(docs.where(quality.fold() != 2))).where(quality.fold() == 2)
    rows = out.select("lang", "lang_pred", "score").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test__language_odd_rows(docs):
    rng = random.Random(4)
    english, other = (lambda n: " ".join(rng.choice(["the", "house", "with", "that"]) for _ in range(n))), (lambda n: " ".join(rng.choice(["дом", "что", "это", "она"]) for _ in range(n)))
    learn = docs([(i, (english if i % 2 else other)(30)) for i in range(40)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("ru"))
    known = language_id.train(learn.unionByName(docs([(99, None), (100, "12 34")])))
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "🙂🙂"), (5, english(5)), (6, other(5)), (7, "𝒜"), (8, "a"), (None, english(9000)), (5, "x")]
    out = language_id.predict(docs(rows, extra=("lang_pred", "score")), known)
    got = out.collect()
    pred = {r.doc_id: r["_lang_pred"] for r in got if r.text != "x"}
    assert [pred[i] for i in (1, 2, 3, 4, 5, 6, None)] == ["und"] * 4 + ["en", "ru", "en"]
    assert pred[7] != "und" and pred[8] != "und" and len(got) == len(rows) and all(0 <= r["_score"] <= 1 for r in got)
    assert language_id.train(docs([])) == {} and {r.lang_pred for r in language_id.predict(docs(rows), {}).collect()} == {"und"}
    assert language_id.predict(docs([]), known).count() == 0


def test__bundle_is_the_sum_of_bound_letters():
    space = language_id.Space()
    gram, ranges, _ = language_id.grams(["abca"], language_id.letter_table())
    assert ranges.tolist() == [0, len(gram)]
    total = space.bundle(*np.unique(gram, return_counts=True))
    assert np.allclose(total, space.vectors(gram).sum(0))
    a, b, c = (space.rolled[k][code].astype(int) for k, code in zip(range(3), (1, 2, 3)))
    assert (space.vectors(np.asarray([(1 * 64 + 2) * 64 + 3]))[0] == a * b * c).all()
