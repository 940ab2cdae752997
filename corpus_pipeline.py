"""Documents to token ids in five stages, each one operator of sparkeval.llm on everything the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkeval.llm import bpe, decontamination, line_dedup, near_dedup, quality
from sparkeval.llm.common import fresh, materialize, read
from sparkeval.llm.queries import split_pattern, vocabulary

QUALITY = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones outside the held-out fold, scores at 0.5 or more.

    Texts without words are no bad prose and stay, as do all documents if nothing is labelled.
    """
    name = fresh(docs.columns, "score")
    scored = quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")), name=name)
    wordless = F.length(F.trim(F.coalesce("text", F.lit("")))) == 0
    return scored.where((F.col(name) >= QUALITY) | wordless).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later matches of any line; one that loses all its lines goes. n_chars is counted again."""
    counts = (fresh(docs.columns, "n_lines"), fresh(docs.columns, "n_removed"))
    out = line_dedup.dedup_lines(docs, counts=counts)
    out = out.where((F.col(counts[1]) == 0) | (F.col(counts[1]) < F.col(counts[0])))
    return out.select(*[F.coalesce(F.length("text"), F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar sets of five-word shingles: the smallest doc_id, once. Rows without an id stay.

    Rows that repeat a doc_id with another text are judged by their own text.
    """
    code = fresh(docs.columns, "code")
    gone = near_dedup.near_duplicates(docs, width=5, percent=80, codes=True).where("NOT kept").select("doc_id", F.col("code").alias(code)).distinct()
    named = docs.where("doc_id IS NOT NULL").withColumn(code, F.xxhash64("text")).join(gone, ["doc_id", code], "left_anti")
    return named.dropDuplicates(["doc_id", "text"]).select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item to 0.8 of its five-word shingles or more."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, and digests of the ids and of what they decode to."""
    coded = bpe.encode_documents(docs, vocabulary("byte_bpe_50k.tiktoken"), split_pattern())
    return coded.withColumns({"ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256)}).drop("decoded")


STAGES = [
    ("quality classifier", keep_quality), ("line dedup", drop_repeated_lines), ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark), ("byte-level BPE encoding and decoding", encode),
]

#: None: SQL can express neither the classifier nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents``; every stage is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0])
    return docs
