"""Data checks that report violations as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Locator patterns, datapoint types, and extensions by media type.
LOCATOR = r"^(s3|gs|https)://(.+/)+.+$"
IMAGE_LOCATOR = r"^(s3|gs|https)://(.+/)+.+\.(png|jpe?g|gif|tiff?)$"
EXTENSIONS = {
    "DATAPOINT/IMAGE": ["png", "jpg", "jpeg", "jpe", "gif", "tif", "tiff", "bmp", "webp", "svg", "ico", "heic", "heif", "avif"],
    "DATAPOINT/DOCUMENT": ["pdf", "txt", "text", "html", "htm", "css", "csv", "tsv", "md", "xml", "py", "js", "rtf", "vcf"],
    "DATAPOINT/VIDEO": ["mp4", "mpeg", "mpg", "mov", "qt", "avi", "webm", "mkv", "movie"],
    "DATAPOINT/AUDIO": ["mp3", "wav", "aif", "aiff", "au", "snd", "ra", "flac", "ogg", "opus", "aac", "m4a"],
    "DATAPOINT/POINT_CLOUD": ["pcd"],
}
DATA_TYPE_BY_EXTENSION = {e: t for t, es in EXTENSIONS.items() for e in es}


def extension(locator: Column) -> Column:
    """Lower-case file extension of a locator without its query and fragment."""
    bare = F.regexp_replace(locator, r"[?#].*$", "")
    return F.lower(F.regexp_extract(bare, r"\.([A-Za-z0-9]+)$", 1))


def data_type_of(ext: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in sorted(DATA_TYPE_BY_EXTENSION.items()) for x in pair])
    return F.coalesce(F.try_element_at(kinds, F.lower(ext)), F.lit("DATAPOINT/TABULAR"))


def data_type(df: DataFrame) -> Column:
    """Datapoint type from ``file_extension``, else ``locator``, else ``text``."""
    if "locator" in df.columns:
        return data_type_of(F.col("file_extension") if "file_extension" in df.columns else extension(F.col("locator")))
    return F.lit("DATAPOINT/TEXT" if "text" in df.columns else "DATAPOINT/TABULAR")


def infer_id_fields(columns: Sequence[str]) -> list[str]:
    if "id" in columns:
        return ["id"]
    named = [c for c in columns if c.startswith("id_") or c.endswith("_id")]
    if named:
        return named
    for c in ("locator", "text"):
        if c in columns:
            return [c]
    raise ValueError("name the id fields")


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")


def duplicate_keys(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Every key that occurs more than once."""
    return df.groupBy(*sorted(ids)).agg(F.count("*").alias("n")).where("n > 1")


def check_keys(df: DataFrame, ids: Sequence[str]) -> None:
    require_columns(df, ids)
    if df.isEmpty():
        raise ValueError("no rows")
    bad = duplicate_keys(df, ids).orderBy(*sorted(ids)).limit(10).collect()  # the message names ten
    if bad:
        raise ValueError(f"duplicate keys {[tuple(r[c] for c in sorted(ids)) for r in bad]}")


def check_results(columns: Sequence[str], ids: Sequence[str], thresholded: Sequence[str], eval_configs: Sequence, tags: Sequence[str]) -> None:
    if not set(columns) - set(ids) - set(thresholded):
        raise ValueError("results hold only id and thresholded fields")
    if len({repr(c) for c in eval_configs}) != len(eval_configs):
        raise ValueError("duplicate evaluation configurations")
    if any(not t.strip() for t in tags):
        raise ValueError("blank tag")


def result_violations(uploads: DataFrame, results: DataFrame, ids: Sequence[str], thresholded: Sequence[str] = ()) -> DataFrame:
    """(rule, model, eval_config, n) of everything that makes result sets unacceptable; nothing if all are fine.

    ``uploads`` have a row per result set (model, eval_config, tag), ``results`` the rows (model, eval_config, ids, fields).
    Rules: ``duplicate_config`` a model's configuration uploaded n times; ``blank_tag``; ``duplicate_id`` ids that stand more
    than once in a set; ``no_result`` rows whose fields besides ids and thresholded ones are all null.
    """
    run = ["model", "eval_config"]
    fields = [c for c in results.columns if c not in (*run, *ids, *thresholded)]
    twice = uploads.groupBy(*run).agg(F.count("*").alias("n")).where("n > 1").withColumn("rule", F.lit("duplicate_config"))
    blank = uploads.where(F.trim("tag") == "").groupBy(*run).agg(F.count("*").alias("n")).withColumn("rule", F.lit("blank_tag"))
    repeated = results.groupBy(*run, *ids).agg(F.count("*").alias("_n")).where("_n > 1").groupBy(*run).agg(F.count("*").alias("n")).withColumn("rule", F.lit("duplicate_id"))
    some = F.lit(False)
    for c in fields:
        some = some | F.col(c).isNotNull()
    empty = results.where(~some).groupBy(*run).agg(F.count("*").alias("n")).withColumn("rule", F.lit("no_result"))
    out = twice.unionByName(blank).unionByName(repeated).unionByName(empty)
    return out.select("rule", *run, "n")


def repeated_names(names: DataFrame, scope: Sequence[str], name: str) -> DataFrame:
    """(scope, name, n) of names given more than once within their scope, such as metrics of a group or test cases of a standard."""
    return names.groupBy(*scope, name).agg(F.count("*").alias("n")).where("n > 1")


def valid_locator(c: Column, image: bool = False) -> Column:
    """A null locator passes."""
    return c.isNull() | F.lower(c).rlike(IMAGE_LOCATOR if image else LOCATOR)


def bad_inferences(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    blank = F.coalesce(F.trim(F.col(label)) == "", F.lit(True))
    off = F.isnan(F.col(score)) | ~F.col(score).between(0, 1)
    return df.where(blank | F.coalesce(off, F.lit(True)))


def coerced(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Cast columns to a schema without failing."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS {t})").alias(c) for c, t in schema.items()])


def coercion_failures(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """(field, failures): values a cast would lose."""
    lost = [F.struct(F.lit(c).alias("field"), F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS {t}) IS NULL")).alias("failures")) for c, t in schema.items()]
    return df.agg(F.array(*lost).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def trusted_sample(df: DataFrame, key: str, ends: int = 10, rows: int = 1000) -> DataFrame:
    """Rows to check of a frame that is trusted: the first and last by key and those of smallest key hash; all if there are no more.

    A row that is picked twice is checked once. Each pick keeps only its few rows per task, so nothing is sorted as a whole.
    """
    picks = [(F.col(key).asc(), ends), (F.md5(F.col(key).cast("string")).asc(), rows), (F.col(key).desc(), ends)]
    ids = None
    for order, n in picks:
        some = df.orderBy(order).limit(n).select(key)
        ids = some if ids is None else ids.unionAll(some)
    return df.join(F.broadcast(ids.distinct()), key, "left_semi")  # at most 2 * ends + rows ids


def field_profile(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, distinct_count, has_null, lo, hi); distinct values are counted exactly."""
    kinds = dict(df.dtypes)
    numeric = [f for f in fields if kinds[f] in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    parts = [
        F.struct(
            F.lit(f).alias("field"), F.count_distinct(f).alias("distinct_count"), F.bool_or(F.col(f).isNull()).alias("has_null"),
            (F.min(f) if f in numeric else F.lit(None)).cast("double").alias("lo"), (F.max(f) if f in numeric else F.lit(None)).cast("double").alias("hi"),
        )
        for f in fields
    ]
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def field_values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, value, n): distinct values of categorical fields."""
    text = df.select(*[F.col(f).cast("string").alias(f) for f in fields])
    return text.unpivot([], list(fields), "field", "value").groupBy("field", "value").agg(F.count("*").alias("n"))


# Shape checks on annotation columns: true where the value is valid.
def valid_text_segment(start: Column, end: Column) -> Column:
    return (start >= 0) & (start < end)


def valid_polygon(points: Column) -> Column:
    return F.size(points) >= 3


def histogram_fault(buckets: Column, frequency: Column) -> Column:
    """Why a histogram is not valid: ``few`` edges, ``sizes`` that do not fit, edges not ``rising``; null if it is."""
    rising = F.forall(F.sequence(F.lit(1), F.size(buckets) - 1), lambda i: F.get(buckets, i) > F.get(buckets, i - 1))
    return F.when(F.size(buckets) < 2, "few").when(F.size(buckets) != F.size(frequency) + 1, "sizes").when(~rising, "rising")


def matrix_fault(labels: Column, matrix: Column) -> Column:
    """Why a confusion matrix is not valid: ``few`` labels, wrong number of ``rows`` or ``columns``; null if it is."""
    n = F.size(labels)
    return F.when(n < 2, "few").when(F.size(matrix) != n, "rows").when(~F.forall(matrix, lambda row: F.size(row) == n), "columns")


def valid_histogram(buckets: Column, frequency: Column) -> Column:
    rising = F.forall(F.sequence(F.lit(1), F.size(buckets) - 1), lambda i: F.get(buckets, i) > F.get(buckets, i - 1))
    return (F.size(buckets) == F.size(frequency) + 1) & (F.size(buckets) >= 2) & rising


def valid_curve(x: Column, y: Column) -> Column:
    return F.size(x) == F.size(y)


def valid_matrix(labels: Column, matrix: Column) -> Column:
    n = F.size(labels)
    return (n >= 2) & (F.size(matrix) == n) & F.forall(matrix, lambda row: F.size(row) == n)
