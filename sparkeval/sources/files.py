"""CSV, parquet and JSON readers and writers for evaluation tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed patterns of cell recovery: ids like 3e2 stay text; plain numbers and infinities become numbers.
SCIENTIFIC = r"^[+-]?\d+(\.\d+)?[eE][+-]?\d+"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+|(?i)inf(inity)?)\s*$"
_CSV = {"header": "true", "escape": '"', "quote": '"', "multiLine": "true"}
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def cell_kind(c: Column) -> Column:
    """null, boolean, number, json or text for one string cell."""
    looks_json = c.rlike(r"^[\[{]") & F.try_parse_json(c).isNotNull()
    return (
        F.when(c.isNull() | c.isin("", "NaN", "null"), "null").when(F.lower(c).isin("true", "false"), "boolean").when(c.rlike(SCIENTIFIC), "text")
        .when(c.rlike(NUMBER), "number").when(looks_json, "json").otherwise("text")
    )


def cell_text(c: Column) -> Column:
    """Text of a cell with one surrounding pair of quotes removed; scientific-looking ids and broken JSON stay as they are."""
    quoted = c.rlike(r"^['\"]") & c.rlike(r"['\"]$") & (F.length(c) >= 2)
    return F.when(quoted, F.regexp_replace(c, r"^['\"]|['\"]$", "")).otherwise(c)


def recovered(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Give all-string columns the type their cells agree on; mixed columns stay text, JSON becomes variant.

    One aggregate finds the kinds of every column; the values are then plain expressions.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    if not names:
        return df
    kinds = df.agg(*[F.array_sort(F.collect_set(F.nullif(cell_kind(F.col(f"`{n}`")), F.lit("null")))).alias(n) for n in names]).first()
    whole = df.agg(*[F.bool_and(~F.col(f"`{n}`").contains(".")).alias(n) for n in names if kinds[n] == ["number"]] or [F.lit(1).alias("_")]).first()
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name not in names:
            out.append(c)
            continue
        keep = F.when(cell_kind(c) != "null", c)
        if kinds[f.name] == ["number"]:
            out.append(F.trim(keep).try_cast("bigint" if whole[f.name] else "double").alias(f.name))
        elif kinds[f.name] == ["boolean"]:
            out.append((F.lower(keep) == "true").alias(f.name))
        elif kinds[f.name] == ["json"]:
            out.append(F.try_parse_json(keep).alias(f.name))
        else:
            out.append(cell_text(keep).alias(f.name))
    return df.select(*out)


def encoded(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return recovered(spark.read.options(**_CSV).csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    encoded(df).write.options(header="true", escape='"', quote='"').csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return recovered(spark.read.parquet(path))


def write_parquet(df: DataFrame, path: str) -> None:
    encoded(df).write.parquet(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files that each hold one JSON array or object."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def as_object(columns: Sequence[str]) -> Column:
    """One JSON object of the columns, keys sorted."""
    return F.to_json(F.struct(*sorted(columns)))


def from_objects(df: DataFrame, column: str, flatten: bool = False) -> DataFrame:
    """Columns from a JSON object column: the union of keys, missing ones null, ``data_type`` dropped.

    One pass finds the schema; ``flatten`` lifts the fields of nested objects as ``outer.inner``.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0]
    ddl = found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    parsed = df.withColumn("_o", F.from_json(column, ddl)).drop(column)
    keep = [c for c in df.columns if c != column]
    out = [F.col(c) for c in keep]
    for f in parsed.schema["_o"].dataType.fields:
        if f.name.endswith("data_type"):
            continue
        if flatten and isinstance(f.dataType, T.StructType):
            out += [F.col(f"_o.`{f.name}`.`{g.name}`").alias(f"{f.name}.{g.name}") for g in f.dataType.fields if not g.name.endswith("data_type")]
        else:
            out.append(F.col(f"_o.`{f.name}`").alias(f.name))
    return parsed.select(*out)


def coco_rows(images: DataFrame, annotations: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per image with its labelled boxes as corners."""
    box = F.struct(
        F.col("name").alias("label"), F.col("bbox")[0].alias("x1"), F.col("bbox")[1].alias("y1"),
        (F.col("bbox")[0] + F.col("bbox")[2]).alias("x2"), (F.col("bbox")[1] + F.col("bbox")[3]).alias("y2"),
    )
    a = annotations.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id")
    a = a.join(images.select(F.col("id").alias("image_id"), "locator"), "image_id")
    return a.groupBy("locator").agg(F.array_sort(F.collect_list(box)).alias("boxes"))


def read_coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, annotations and categories of a COCO document."""
    doc = read_json(spark, path)
    return tuple(doc.select(F.explode(k).alias("r")).select("r.*") for k in ("images", "annotations", "categories"))


def nested_boxes(flat: DataFrame, image: str, meta: Sequence[str], box: Sequence[str]) -> DataFrame:
    """A flat table of boxes as one row per image with a box array and the image's fields."""
    return flat.groupBy(image).agg(F.array_sort(F.collect_list(F.struct(*box))).alias("boxes"), *[F.max(m).alias(m) for m in meta])


def checked_embeddings(df: DataFrame, ids: Sequence[str], column: str = "embedding") -> DataFrame:
    """Float vectors of one size with their ids, or an error."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.NumericType):
        raise ValueError("embeddings must be arrays of numbers")
    sizes = df.agg(F.count_distinct(F.size(column)).alias("n"), F.bool_or(F.col(column).isNull()).alias("null")).first()
    if sizes.n > 1 or sizes.null:
        raise ValueError("embeddings differ in size")
    return df.select(*ids, F.col(column).cast("array<float>").alias(column))


def write_embeddings(df: DataFrame, path: str, key: str, ids: Sequence[str]) -> None:
    checked_embeddings(df, ids).withColumn("key", F.lit(key)).write.mode("append").partitionBy("key").parquet(path)


CHUNK_BYTES, SINGLE_BYTES, PREFLIGHT_ROWS = 250_000_000, 2_000_000_000, 1000


def folder_bytes(spark: SparkSession, path: str) -> int:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def chunk_rows(df: DataFrame, scratch: str, chunk_bytes: int = CHUNK_BYTES, single_bytes: int = SINGLE_BYTES, rows: int = PREFLIGHT_ROWS) -> tuple[int, int]:
    """(rows of the frame, rows of a chunk), from the size of an export of its first rows below ``scratch``.

    A frame whose whole export would not pass ``single_bytes`` is one chunk.
    """
    total = df.count()
    head = min(rows, total)
    if not head:
        raise ValueError("nothing to export")
    df.limit(head).coalesce(1).write.mode("overwrite").parquet(scratch)
    per_row = folder_bytes(df.sparkSession, scratch) / head
    return total, total if per_row * total <= single_bytes else max(1, math.ceil(chunk_bytes / per_row))


def write_chunks(df: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, single_bytes: int = SINGLE_BYTES, rows: int = PREFLIGHT_ROWS) -> int:
    """Write a frame as parquet files of at most so many rows as make about ``chunk_bytes``; returns that number of rows.

    Rows are dealt out evenly over as many tasks as there are chunks, so no task writes more than about one file.
    """
    total, each = chunk_rows(df, f"{path}/_preflight", chunk_bytes, single_bytes, rows)
    df.repartition(math.ceil(total / each)).write.mode("overwrite").option("maxRecordsPerFile", each).parquet(f"{path}/chunks")
    return each
