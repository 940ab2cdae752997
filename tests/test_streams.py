"""Streams that stop, start again and replay a batch; commits that write only the buckets they touch."""

import os

import pytest
from pyspark.sql import functions as F

from sparkeval.session import new_path
from sparkeval.sources.datasets import Datasets, change_counts
from sparkeval.streaming import ingest

SCHEMA = "id long, start long, case string, tp long"


def add_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder):
    return ingest.stream_of(spark, folder, spark.read.parquet(folder).schema, files_per_trigger=1)


def forget_last_batch(folder):
    """As after a crash between a batch's output and its entry in the progress."""
    done = f"{folder.removeprefix('file://')}/progress/commits"
    last = max(int(n) for n in os.listdir(done) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{done}/{name}"):
            os.unlink(f"{done}/{name}")
    return last


def test__ingest_starts_again_and_replays_without_a_second_commit(spark):
    folder, store = new_path(spark, "in"), Datasets(spark, new_path(spark, "store"))
    add_file(spark, folder, [(1, 5, "a", 1), (2, 6, "b", 2)])
    add_file(spark, folder, [(2, 7, "b", 9), (3, 8, "a", 0)])
    ingest.ingest(source(spark, folder), store, "d", ["id"])
    first = store.history("d").count()
    add_file(spark, folder, [(4, 9, "a", 1)])
    ingest.ingest(source(spark, folder), store, "d", ["id"])
    assert store.history("d").count() == first + 1
    rows = sorted((r.id, r.tp) for r in store.download("d").collect())
    assert [i for i, _ in rows] == [1, 2, 3, 4]
    forget_last_batch(f"{store.root}/streams/d")
    ingest.ingest(source(spark, folder), store, "d", ["id"])
    assert store.history("d").count() == first + 1 and sorted((r.id, r.tp) for r in store.download("d").collect()) == rows
    assert store.history("d").select("batch").distinct().count() == first + 1
    again = Datasets(spark, store.root)  # another session's view of the same folder
    assert again.upload("d", spark.createDataFrame([(9, 1, "z", 1)], SCHEMA), ["id"], append_only=True, batch="stream:0") == 1
    assert again.download("d").count() == 4


def test__ingest_passes_over_files_without_rows(spark):
    folder, store = new_path(spark, "in"), Datasets(spark, new_path(spark, "store"))
    for rows in ([], [(1, 5, "a", 1)], [], [(2, 6, "b", 2)]):
        add_file(spark, folder, rows)
    ingest.ingest(source(spark, folder), store, "d", ["id"])
    assert sorted(r.id for r in store.download("d").collect()) == [1, 2] and store.history("d").count() == 2


def test__totals_and_first_calls_start_again_and_replay(spark):
    folder, totals, firsts = (new_path(spark, n) for n in ("in", "totals", "firsts"))
    sums = {"samples": F.count("*"), "tp": F.sum("tp")}

    def both():
        t = ingest.running_totals(source(spark, folder), ["case"], sums, totals)
        f = ingest.first_calls(source(spark, folder).select("id", "start", "case"), ["id"], firsts)
        return sorted(tuple(r) for r in t.collect()), sorted(tuple(r) for r in f.collect())

    add_file(spark, folder, [(1, 50, "a", 1), (2, 60, "b", 2), (1, 49, "c", 0)])
    assert both() == ([("a", 1, 1), ("b", 1, 2), ("c", 1, 0)], [(1, 49, "c"), (2, 60, "b")])
    add_file(spark, folder, [(2, 3, "a", 5), (1, 70, "a", 1), (5, 1, None, 7)])  # a late, earlier call of 2
    want = ([("a", 3, 7), ("b", 1, 2), ("c", 1, 0), (None, 1, 7)], [(1, 49, "c"), (2, 3, "a"), (5, 1, None)])
    key = lambda x: tuple((v is None, v if v is not None else 0) for v in x)

    def sorted_both():
        t = ingest.running_totals(source(spark, folder), ["case"], sums, totals)
        f = ingest.first_calls(source(spark, folder).select("id", "start", "case"), ["id"], firsts)
        return sorted(map(tuple, t.collect()), key=key), sorted(map(tuple, f.collect()), key=key)

    assert sorted_both() == want
    for name in (totals, firsts):
        forget_last_batch(name)
    assert sorted_both() == want
    assert spark.read.parquet(f"{firsts}/changed").count() == 5  # 1 and 2 at first, then 1, 2 and 5, once


def test__progress_reports_add_up_to_the_batch_answer(spark):
    folder, out = new_path(spark, "in"), new_path(spark, "out")
    for k in range(3):
        add_file(spark, folder, [(i, i, "ab"[i % 2] if i % 5 else None, i % 3) for i in range(k * 10, k * 10 + 7 + k)])
    cases, sums = ["a", "b", None], {"tp": "tp"}
    seen = ingest.with_progress(source(spark, folder), "case", cases, sums)
    query = ingest.run(seen, out, lambda df, b: df.write.mode("overwrite").parquet(f"{out}/rows/b={b}"))
    want = {r.case: {"samples": r.samples, "tp": r.tp} for r in spark.read.parquet(folder).groupBy("case").agg(F.count("*").alias("samples"), F.sum("tp").alias("tp")).collect()}
    assert ingest.progress_of(query, cases, sums) == want
    with pytest.raises(ValueError):
        ingest.with_progress(seen, "case", [str(i) for i in range(101)])


def test__an_upsert_writes_only_the_buckets_of_its_ids(spark):
    store = Datasets(spark, new_path(spark, "store"), buckets=8)
    rows = [(i, f"v{i}") for i in range(200)]
    store.upload("d", spark.createDataFrame(rows, "id long, a string"), ["id"])
    store.upload("d", spark.createDataFrame([(3, "new"), (1000, "more")], "id long, a string"), ["id"], append_only=True)
    written = {c: {r.bucket for r in store.written("d").where(f"commit = {c}").collect()} for c in (1, 2)}
    assert len(written[1]) == 8 and 1 <= len(written[2]) <= 2
    want = dict(rows) | {3: "new", 1000: "more"}
    assert {r.id: r.a for r in store.download("d").collect()} == want and {r.id: r.a for r in store.download("d", 1).collect()} == dict(rows)
    # A new column leaves the other buckets alone, a wider type does not; a replacement starts anew.
    store.upload("d", spark.createDataFrame([(5, "x", 1)], "id long, a string, n int"), ["id"], append_only=True)
    assert store.written("d").where("commit = 3").count() == 1 and store.download("d").where("n IS NULL").count() == 200
    store.upload("d", spark.createDataFrame([(5, "x", 2.5)], "id long, a string, n double"), ["id"], append_only=True)
    assert store.written("d").where("commit = 4").count() == 8 and store.download("d").where("n = 2.5").count() == 1
    store.upload("d", spark.createDataFrame([(7, "only")], "id long, a string"), ["id"])
    assert [(r.id, r.a) for r in store.download("d").collect()] == [(7, "only")] and store.download("d", 2).count() == 201
    assert [(r.n_added, r.n_removed) for r in store.history("d").collect()] == [(200, 0), (2, 1), (1, 1), (1, 1), (1, 201)]


def test__change_counts_tell_nulls_apart(spark):
    old = spark.createDataFrame([(1, None, "x"), (2, "y", None), (3, "z", "z"), (3, "z", "z")], "id int, a string, b string")
    new = spark.createDataFrame([(1, "x", None), (2, "y", None), (3, "z", "z")], "id int, a string, b string")
    assert tuple(change_counts(old, new, ["id"]).first()) == (1, 2)
    maps = spark.createDataFrame([(1, {"k": 1})], "id int, m map<string,int>")
    assert tuple(change_counts(maps, maps.withColumn("extra", F.lit(None).cast("int")), ["id"]).first()) == (0, 0)
    assert tuple(change_counts(maps, maps.withColumn("extra", F.lit(0)), ["id"]).first()) == (1, 1)
