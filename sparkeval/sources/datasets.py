"""Versioned datasets and model results as parquet below one root folder.

A dataset's rows lie in buckets by a hash of their ids. A commit is one folder with the buckets it wrote: all of them when it
replaces the dataset, only those of the new ids when it adds to it. The commit log and the list of written buckets are small
tables next to it; a version is read from the last written folder of each bucket. One writer per dataset is assumed.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.operators import checks

MAX_RECORDS_PER_FILE = 2_000_000
BUCKETS = 16


def row_hash(df: DataFrame, types: dict[str, T.DataType]) -> Column:
    """64-bit hash of a row's values in the given columns and types; a missing column counts as null, and nulls have their place."""
    parts = []
    for name, kind in sorted(types.items()):
        value = F.lit(None).cast(kind) if name not in df.columns else F.col(name) if df.schema[name].dataType == kind else F.col(name).cast(kind)
        parts += [F.to_json(value) if isinstance(kind, T.MapType) else value, value.isNull()]
    return F.xxhash64(*parts)


def change_counts(old: DataFrame, new: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """(n_added, n_removed): a changed row is one removal and one addition. Rows are compared by ids and a hash of all values."""
    types = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}
    row = lambda df, w: df.select(*ids, row_hash(df, types).alias("_h"), F.lit(w).alias("_w"))
    net = row(old, -1).unionAll(row(new, 1)).groupBy(*ids, "_h").agg(F.sum("_w").alias("w"))
    return net.agg(F.coalesce(F.sum(F.greatest("w", F.lit(0))), F.lit(0)).alias("n_added"), F.coalesce(F.sum(F.greatest(-F.col("w"), F.lit(0))), F.lit(0)).alias("n_removed"))


def diff(old: DataFrame, new: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(ids, change): added, removed, changed or unchanged, from one full join on the ids."""
    rest = [c for c in new.columns if c not in ids]
    a = old.select(*ids, F.struct(*rest).alias("_old"))
    b = new.select(*ids, F.struct(*rest).alias("_new"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    return a.join(b, list(ids), "full").select(*ids, change.alias("change"))


def upserted(old: DataFrame, new: DataFrame, ids: Sequence[str]) -> DataFrame:
    """New rows win over old rows of the same id; nothing is deleted."""
    return old.join(new.select(*ids), list(ids), "left_anti").unionByName(new, allowMissingColumns=True)


class Datasets:
    """Datasets, their commits and the results of models on them."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    # -- paths and small tables -------------------------------------------------
    def _exists(self, path: str) -> bool:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(jpath)

    def _buckets_in(self, path: str) -> list[int]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at)]
        return [int(n.removeprefix("_bucket=")) for n in names if n.startswith("_bucket=")]

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def _snapshot(self, dataset: str, commit: int) -> str:
        return f"{self.root}/datasets/{dataset}/commit={commit}"

    _LOG = "dataset string, commit int, timestamp double, n_added long, n_removed long, ids string, tags string, buckets int, whole boolean, schema string, batch string"
    _WRITTEN = "dataset string, commit int, bucket int"

    def _small(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        return self.spark.read.schema(schema).parquet(path) if self._exists(path) else self.spark.createDataFrame([], schema)

    def commits(self) -> DataFrame:
        return self._small("commits", self._LOG)

    def written(self, dataset: str) -> DataFrame:
        """(commit, bucket) of every bucket that a commit wrote."""
        return self._small("buckets", self._WRITTEN).where(F.col("dataset") == dataset).select("commit", "bucket")

    def _read(self, dataset: str, row, only: list[int] | None = None) -> DataFrame:
        """A version from the last folder of each bucket up to its commit."""
        log = self.commits().where((F.col("dataset") == dataset) & (F.col("commit") <= row.commit) & F.col("whole"))
        base = log.agg(F.max("commit")).first()[0]
        last = self.written(dataset).where(F.col("commit").between(base, row.commit)).groupBy("bucket").agg(F.max("commit").alias("commit")).collect()  # one row a bucket
        paths = [f"{self._snapshot(dataset, r.commit)}/_bucket={r.bucket}" for r in last if only is None or r.bucket in only]
        schema = T._parse_datatype_json_string(row.schema)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    # -- datasets ---------------------------------------------------------------
    def list_datasets(self) -> DataFrame:
        """(dataset, n_commits, n_datapoints) from the commit log."""
        size = F.sum(F.col("n_added") - F.col("n_removed"))
        return self.commits().groupBy("dataset").agg(F.count("*").alias("n_commits"), size.alias("n_datapoints"))

    def _latest(self, dataset: str):
        row = self.commits().where(F.col("dataset") == dataset).orderBy(F.col("commit").desc()).first()
        return row

    def upload(self, dataset: str, df: DataFrame, ids: Sequence[str] | None = None, append_only: bool = False, tags: Sequence[str] = (), batch: str | None = None) -> int:
        """Write a new version: replace everything, or add and overwrite by id. A ``batch`` that was committed before changes nothing."""
        if batch is not None:
            done = self.commits().where((F.col("dataset") == dataset) & (F.col("batch") == batch)).first()
            if done is not None:
                return done.commit
        ids = sorted(ids or checks.infer_id_fields(df.columns))
        checks.check_keys(df, ids)
        last = self._latest(dataset)
        if "data_type" not in df.columns:
            df = df.withColumn("data_type", checks.data_type(df))
        commit = 1 if last is None else last.commit + 1
        buckets = self.buckets if last is None else last.buckets
        whole = last is None or not append_only
        touched = None
        if last is not None and append_only:
            old = self._read(dataset, last)
            types = {f.name: f.dataType for f in upserted(old.limit(0), df.limit(0), ids).schema.fields}
            df = df.select(*[F.col(c).cast(types[c]).alias(c) for c in df.columns])
            whole = any(f.dataType != types[f.name] for f in old.schema.fields)  # a column's type grew: every file is written again
            if not whole:
                touched = [r[0] for r in df.select(self._bucket(df, ids, buckets)).distinct().collect()]
                old = self._read(dataset, last, touched)
            df = upserted(old, df, ids)
        else:
            old = None if last is None else self._read(dataset, last)
        path = self._snapshot(dataset, commit)
        placed = df.withColumn("_bucket", self._bucket(df, ids, buckets)).repartition("_bucket")
        placed.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("_bucket").parquet(path)
        held = [(dataset, commit, bucket) for bucket in self._buckets_in(path)]
        if held:
            self._append("buckets", held, self._WRITTEN)
        new = self.spark.read.schema(df.schema).parquet(*[f"{path}/_bucket={b}" for _, _, b in held]) if held else self.spark.createDataFrame([], df.schema)
        added, removed = (new.count(), 0) if old is None else change_counts(old, new, ids).first()
        self._append("commits", [(dataset, commit, time.time(), added, removed, ",".join(ids), ",".join(tags), buckets, whole, df.schema.json(), batch)], self._LOG)
        return commit

    @staticmethod
    def _bucket(df: DataFrame, ids: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*ids), F.lit(buckets)).cast("int").alias("_bucket")

    def download(self, dataset: str, commit: int | None = None, properties: DataFrame | None = None) -> DataFrame:
        """Datapoints at the latest or a given commit, optionally with extracted property columns."""
        row = self._latest(dataset) if commit is None else self.commits().where((F.col("dataset") == dataset) & (F.col("commit") == commit)).first()
        if row is None:
            raise ValueError(f"no dataset {dataset}" if commit is None else f"no commit {commit} of {dataset}")
        df = self._read(dataset, row)
        return df if properties is None else df.join(properties, self.ids(dataset), "left")

    def ids(self, dataset: str) -> list[str]:
        return self._latest(dataset).ids.split(",")

    def history(self, dataset: str, descending: bool = False, limit: int | None = None, offset: int = 0) -> DataFrame:
        key = F.col("commit").desc() if descending else F.col("commit").asc()
        rows = self.commits().where(F.col("dataset") == dataset).orderBy(key)
        rows = rows.offset(offset) if offset else rows
        return rows.limit(limit) if limit is not None else rows

    # -- results ----------------------------------------------------------------
    _RESULT_KEYS = ("model", "eval_config")

    def _results_path(self, dataset: str) -> str:
        return f"{self.root}/results/{dataset}"

    _RUNS = "dataset string, model string, eval_config string, tags array<string>, version int, n_inserted long, n_updated long"

    def _runs(self) -> DataFrame:
        return self._small("runs", self._RUNS)

    def uploads(self, dataset: str) -> DataFrame:
        """(model, eval_config, version, n_inserted, n_updated) of every upload of results."""
        return self._runs().where(F.col("dataset") == dataset).select("model", "eval_config", "version", "n_inserted", "n_updated")

    def _current_runs(self, dataset: str) -> DataFrame:
        runs = self._runs().where(F.col("dataset") == dataset)
        return runs.groupBy("model", "eval_config").agg(F.max("version").alias("version"), F.max_by("tags", "version").alias("tags"))

    def upload_results(
        self, dataset: str, model: str, results: DataFrame, eval_config: str | None = None, thresholded: Sequence[str] = (), tags: Sequence[str] = ()
    ) -> tuple[int, int]:
        """Upsert one run's results by id; rows whose id is not in the dataset are dropped. Returns inserted, updated."""
        ids = self.ids(dataset)
        checks.check_results(results.columns, ids, thresholded, [eval_config], tags)
        checks.check_keys(results, ids)
        known = results.join(self.download(dataset).select(*ids), ids, "left_semi")
        runs = self._current_runs(dataset).where((F.col("model") == model) & F.col("eval_config").eqNullSafe(F.lit(eval_config)))
        last = runs.first()
        version = 1 if last is None else last.version + 1
        updated = 0
        if last is not None:
            old = self.spark.read.parquet(self._run_path(dataset, model, eval_config, last.version))
            updated = known.join(old.select(*ids), ids, "left_semi").count()
            known = upserted(old, known, ids)
        path = self._run_path(dataset, model, eval_config, version)
        known.write.mode("overwrite").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
        total = self.spark.read.parquet(path).count()
        before = 0 if last is None else old.count()
        self._append("runs", [(dataset, model, eval_config, list(tags), version, total - before, updated)], self._RUNS)
        return total - before, updated

    def _run_path(self, dataset: str, model: str, eval_config: str | None, version: int) -> str:
        import hashlib

        config = hashlib.sha256(repr(eval_config).encode()).hexdigest()[:16]
        return f"{self._results_path(dataset)}/model={model}/config={config}/version={version}"

    def download_results(self, dataset: str, model: str, commit: int | None = None) -> dict[str | None, DataFrame]:
        """Per evaluation configuration: every datapoint, result columns null where untested."""
        points, ids = self.download(dataset, commit), self.ids(dataset)
        out = {}
        for run in self._current_runs(dataset).where(F.col("model") == model).collect():  # one row per configuration
            res = self.spark.read.parquet(self._run_path(dataset, model, run.eval_config, run.version))
            res = res.drop(*[c for c in res.columns if c in points.columns and c not in ids])
            out[run.eval_config] = points.join(res, ids, "left")
        if not out:
            raise ValueError(f"no results of {model} on {dataset}")
        return out

    def models(self, dataset: str, tags: Sequence[str] = ()) -> DataFrame:
        """Models with results on the dataset whose tags include the given ones."""
        runs = self._current_runs(dataset).groupBy("model").agg(F.array_distinct(F.flatten(F.collect_list("tags"))).alias("tags"))
        want = F.array(*[F.lit(t) for t in tags]) if tags else F.array().cast("array<string>")
        return runs.where(F.size(F.array_except(want, "tags")) == 0)

    def download_results_by_tag(self, dataset: str, tag: str, commit: int | None = None) -> dict[str | None, DataFrame]:
        found = [r.model for r in self.models(dataset, [tag]).limit(2).collect()]
        if not found:
            raise LookupError(f"no model tagged {tag}")
        if len(found) > 1:
            raise ValueError(f"several models tagged {tag}")
        return self.download_results(dataset, found[0], commit)
