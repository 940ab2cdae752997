"""Incremental ingestion, traced calls and live metrics on Structured Streaming.

Every query keeps its progress and, where it aggregates, its state below a folder that the caller names: started again on the
same folder it goes on where it stopped, and a batch that runs twice counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkeval.functions.ratios import f1_score, precision, recall
from sparkeval.sources.datasets import Datasets

MOST_CASES = 100  # test cases whose counts travel with a query's progress
FLUSH = "30 seconds"  # fixed interval between flushes of traced calls


def stream_of(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def run(stream: DataFrame, folder: str, batch: Callable[[DataFrame, int], None], mode: str = "append", available_now: bool = True):
    """Start, or start again, a query into a batch function; its progress and state are kept in ``folder``."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", f"{folder}/progress")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=FLUSH)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def ingest(stream: DataFrame, store: Datasets, dataset: str, ids: Sequence[str], available_now: bool = True):
    """Every batch is validated and upserted as one commit that remembers it; a batch that runs again makes no second one.

    A batch without rows, as of a file that a writer's empty partition left, commits nothing.
    """

    def upload(df: DataFrame, batch: int) -> None:
        if not df.isEmpty():
            store.upload(dataset, df, ids, append_only=True, batch=f"stream:{batch}")

    return run(stream, f"{store.root}/streams/{dataset}", upload, available_now=available_now)


def first_calls(calls: DataFrame, ids: Sequence[str], folder: str, time: str = "start") -> DataFrame:
    """The call of earliest start per id, over everything that has arrived; late calls count.

    The first call of each id is the query's state. A batch writes the state of the ids it touched, replacing what it wrote if
    it runs again; the earliest counts. Equal starts go to the smallest row.
    """
    rest = [c for c in calls.columns if c not in (*ids, time)]

    def first(df: DataFrame) -> DataFrame:
        return df.groupBy(*ids).agg(F.min(F.struct(time, *rest)).alias("_r"))

    run(first(calls), folder, lambda df, b: df.write.mode("overwrite").parquet(f"{folder}/changed/b={b}"), mode="update")
    changed = calls.sparkSession.read.parquet(f"{folder}/changed").drop("b")
    return changed.groupBy(*ids).agg(F.min("_r").alias("_r")).select(*ids, "_r.*")


def running_totals(results: DataFrame, by: Sequence[str], sums: dict, folder: str) -> DataFrame:
    """Aggregates per key over everything that has arrived, exact however late a row is; state and output are one row per key.

    Every batch writes all totals to its own folder and then points to it, so readers see one whole batch or the next.
    """
    totals = results.groupBy(*by).agg(*[e.alias(n) for n, e in sums.items()])
    spark = results.sparkSession

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/totals/b={batch}")
        spark.range(1).select(F.lit(batch).alias("b")).coalesce(1).write.mode("append").parquet(f"{folder}/done")

    run(totals, folder, write, mode="complete")
    last = spark.read.parquet(f"{folder}/done").agg(F.max("b")).first()[0]
    return spark.read.schema(totals.schema).parquet(f"{folder}/totals/b={last}")


def with_progress(results: DataFrame, case: str, cases: Sequence[str], sums: dict | None = None, name: str = "progress") -> DataFrame:
    """The same stream; each batch's progress report carries the rows, and given sums, of every listed test case.

    The metrics are counted while the rows pass, without another job. Their number is bounded: at most MOST_CASES cases.
    """
    if len(cases) > MOST_CASES:
        raise ValueError(f"{len(cases)} test cases, more than the {MOST_CASES} that a progress report may carry")
    metrics = [F.count("*").alias("samples")]
    for i, c in enumerate(cases):
        of = F.col(case).eqNullSafe(F.lit(c))
        metrics.append(F.count_if(of).alias(f"samples_{i}"))
        metrics += [F.sum(F.when(of, F.col(e))).alias(f"{n}_{i}") for n, e in (sums or {}).items()]
    return results.observe(name, *metrics)


def progress_of(query, cases: Sequence[str], sums: dict | None = None, name: str = "progress") -> dict[str, dict[str, float]]:
    """Totals per test case from the progress reports of a query's batches (those that Spark keeps, 100 by default)."""
    out = {c: dict.fromkeys(("samples", *(sums or {})), 0) for c in cases}
    for report in query.recentProgress:
        row = report.observedMetrics.get(name)
        if row is None:
            continue
        for i, c in enumerate(cases):
            for n in out[c]:
                out[c][n] += row[f"{n}_{i}"] or 0
    return out


def with_elapsed(calls: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    return calls.withColumn("elapsed_s", (F.unix_micros(end) - F.unix_micros(start)) / 1e6)


def trace(calls: DataFrame, path: str, ids: Sequence[str], inputs: Sequence[str], outputs: Sequence[str], available_now: bool = True):
    """Split a call log into datapoints and per-model results."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.select(*ids, *inputs).write.mode("overwrite").parquet(f"{path}/datapoints/batch={batch_id}")
        with_elapsed(df).select("model_name", *ids, *outputs, "elapsed_s").write.mode("overwrite").partitionBy("model_name").parquet(f"{path}/results/batch={batch_id}")

    return run(calls, path, write, available_now=available_now)


def live_counts(results: DataFrame, time: str, by: Sequence[str], folder: str, window: str = "1 day") -> DataFrame:
    """Sums of tp/fp/fn per time window and stratum; no watermark, so no late row is lost."""
    timed = results.withColumn("window_start", F.window(time, window)["start"])
    return running_totals(timed, ["window_start", *by], {**{c: F.sum(c) for c in ("tp", "fp", "fn")}, "n": F.count("*")}, folder)


def live_rates(counts: DataFrame) -> DataFrame:
    return counts.select("*", precision("tp", "fp").alias("precision"), recall("tp", "fn").alias("recall"), f1_score("tp", "fp", "fn").alias("f1"))
