"""One query for each operator, over its whole table with production parameters, and the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkeval.llm import bpe, decontamination, html_text, infill, language_id, license_scan, line_dedup, near_dedup, neighbours, quality, spelling, sql, substring_dedup, token_files
from sparkeval.llm.common import ORACLES, QUERIES, new_path, query, read

__all__ = ["ORACLES", "QUERIES"]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query("op1_decontamination", sql.LEAKS)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op2_near_dedup", sql.NEAR_DUPLICATES)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), width=2, percent=80)


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    manifest = token_files.write_tokens(docs, vocabulary("byte_bpe_50k.json"), new_path(spark, "tokens"))
    return token_files.read_tokens(manifest)


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), split_pattern())


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (quality.fold() == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op10_line_dedup", sql.LINES)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = language_id.train(docs.where(quality.fold() != 2))
    out = language_id.predict(docs.select("doc_id", "text"), prototypes)
    return out.select("doc_id", (quality.fold() == 2).alias("held_out"), "lang_pred", "score")


@query("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), k=20)


@query("op6_html_text")
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


@query("op11_fill_in_middle", sql.INFILL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(read(spark, sf_dir, "documents"))


@query("op12_license_scan", sql.LICENSES)
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read(spark, sf_dir, "documents"))


@query("op13_spelling_variants", sql.VARIANTS)
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read(spark, sf_dir, "documents"))
