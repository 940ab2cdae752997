"""The pipeline's stages on a small table with planted cases, and the registered queries against their SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations"


def test__stages(spark, tmp_path):
    rng = random.Random(1)

    def prose(n):
        return " ".join(rng.choice(["the", "house", "with", "that", "road"]) + str(rng.randint(0, 999)) for _ in range(n))

    item, line = prose(30), prose(15)
    rows = [(i, prose(rng.randint(5, 150)) + rng.choice(["\n", " "]) + prose(15)) for i in range(80)]
    more = [(1000 + i, prose(rng.randint(5, 150)) + rng.choice(["\n", " "]) + prose(15)) for i in range(300)]
    labels = [(i, 1, 0) for i, _ in rows + more]
    rows[4] = (4, prose(40) + "\n" + line)
    rows += [(100 + i, " ".join(w + "***$$$" for w in prose(60).split())) for i in range(40)]
    labels += [(100 + i, 0, 0) for i in range(40)]
    rows += [(200, rows[3][1]), (201, f"{prose(50)} {item} {prose(40)}"), (202, prose(30) + "\n" + line), (203, None), (204, ""), (None, prose(40)), *more]
    folder = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE encoding and decoding"]
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        seen.append({r.doc_id: r.text for r in docs.select("doc_id", "text").collect()})
        assert k == 4 or docs.columns == columns
    clean = {*range(80), 202, 203, 204, None}
    assert set(seen[0]) >= clean | {200, 201} and len(set(seen[0]) & set(range(100, 140))) <= 2
    assert 200 not in seen[1] and seen[1][202] == rows[122][1].split("\n")[0] and set(seen[1]) >= clean | {201}
    assert set(seen[3]) >= clean and 201 not in seen[3] and set(seen[4]) == set(seen[3])
    final = docs.select("*", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("want")).collect()
    assert all(r.decoded_sha256 == r.want and r.n_chars == len(r.text or "") for r in final)


def test__near_duplicates_go_but_one(spark):
    rng = random.Random(2)
    base = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(200)).split()
    near = [*base[:100], "changed", *base[101:]]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (9, " ".join(base)), (9, " ".join(base)), (1, "else " * 9), (None, " ".join(base)), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted([3, 1, None, 7, 8], key=repr)


def test__near_duplicates_go_by_row(spark):
    rng = random.Random(3)
    base, clean = (" ".join(f"w{rng.randint(0, 9999)}" for _ in range(100)) for _ in range(2))
    rows = [(1, base), (2, base + " more"), (2, clean), (None, clean), (None, clean)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, code string")
    out = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([rows[0], *rows[2:]], key=repr)


def test__pipeline_runs(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert 0 < out.count() <= spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", ["op1_decontamination", "op2_near_dedup", "op10_line_dedup"])
def test__query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(columns).collect()))) == sorted(map(repr, cur.fetchall()))


def test__every_operator_has_a_query():
    assert [sum(n.startswith(f"op{k}_") for n in entry.queries()) for k in range(1, 11)] == [1] * 10
