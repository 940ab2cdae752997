"""Text comparison and text properties."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkeval.functions.ratios import ratio
from sparkeval.functions.types import struct_of

_EDIT = 1 << 32  # one edit outweighs any number of hits
GROUP_CELLS = 1 << 16  # table cells that advance together


def words(c: Column) -> Column:
    """Whitespace-separated words; none for empty text."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def normalized(c: Column) -> Column:
    """Lower case without punctuation, articles and repeated spaces."""
    bare = F.regexp_replace(F.lower(c), r"[\p{Punct}]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?U)\b(a|an|the)\b", " "), r"\s+", " "))


def _ragged(side: Sequence, codes: np.ndarray, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of texts as the rows of one array, filled up behind their ends, and the texts' lengths."""
    lengths = np.array([len(x) for x in side], dtype=np.int64)
    out = np.full((len(side), int(lengths.max(initial=0))), fill, dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = codes
    return out, lengths


def in_step(ref: pd.Series, cand: pd.Series, table: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``table(a, n, b, m)`` over groups of text pairs of about one length, as word ids; its results in order, and both lengths.

    All pairs of a group advance together, a word of each reference at a time, so short texts share their steps. A group
    holds GROUP_CELLS table cells or a single pair.
    """
    sides = [[() if x is None else x for x in column] for column in (ref, cand)]
    n, m = (np.array([len(x) for x in side], dtype=np.int64) for side in sides)
    out = np.zeros(len(n), dtype=np.int64)
    order = np.argsort(np.maximum(n, m), kind="stable")
    at = 0
    while at < len(order):
        width = np.maximum(n, m)[order[at:]] + 1
        size = max(1, int(np.searchsorted(width * np.arange(1, len(width) + 1), GROUP_CELLS, "right")))
        group = order[at : at + size]
        first, second = ([side[i] for i in group] for side in sides)
        codes = pd.factorize(np.array([w for x in (*first, *second) for w in x], dtype=object))[0]
        cut = int(n[group].sum())
        (x, nx), (y, ny) = _ragged(first, codes[:cut], -1), _ragged(second, codes[cut:], -2)
        out[group] = table(x, nx, y, ny)
        at += size
    return out, n, m


def _edits(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """For each pair the least of edits * _EDIT - hits."""
    shift = np.arange(b.shape[1] + 1, dtype=np.int64) * _EDIT
    row = np.tile(shift, (len(a), 1))
    for i in range(a.shape[1]):
        step = row + _EDIT
        step[:, 1:] = np.minimum(step[:, 1:], row[:, :-1] + np.where(b == a[:, i : i + 1], -1, _EDIT))
        step = np.minimum.accumulate(step - shift, axis=1) + shift
        row = np.where((i < n)[:, None], step, row)
    return row[np.arange(len(a)), m]


def _common(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> np.ndarray:
    """For each pair the length of the longest common subsequence; words behind an end equal none."""
    row = np.zeros((len(a), b.shape[1] + 1), dtype=np.int64)
    for i in range(a.shape[1]):
        step = row.copy()
        step[:, 1:] = np.maximum(step[:, 1:], row[:, :-1] + (b == a[:, i : i + 1]))
        row = np.maximum.accumulate(step, axis=1)
    return row[np.arange(len(a)), m]


@F.pandas_udf(struct_of(cost="long", hits="long", n_ref="long", n_cand="long"))
def aligned(ref: pd.Series, cand: pd.Series) -> pd.DataFrame:
    """Fewest word edits from ``ref`` to ``cand`` and, among those, the most hits."""
    least, n, m = in_step(ref, cand, _edits)
    cost = -(-least // _EDIT)
    return pd.DataFrame({"cost": cost, "hits": cost * _EDIT - least, "n_ref": n, "n_cand": m})


def edit_counts(df: DataFrame, ref: str, cand: str) -> DataFrame:
    """Add hits, substitutions, deletions, insertions of the best word alignment."""
    a = df.withColumn("_a", aligned(words(F.col(ref)), words(F.col(cand)))).select("*", "_a.*").drop("_a")
    a = a.withColumn("substitutions", F.col("n_ref") + F.col("n_cand") - 2 * F.col("hits") - F.col("cost"))
    return a.withColumn("deletions", F.col("n_ref") - F.col("hits") - F.col("substitutions")).withColumn(
        "insertions", F.col("n_cand") - F.col("hits") - F.col("substitutions")
    )


def error_rates(df: DataFrame) -> DataFrame:
    """WER, MER, word information preserved and lost from summed or single alignment counts."""
    c = F.col
    wip = ratio("hits", "n_ref") * ratio("hits", "n_cand")
    return df.select("*", ratio("cost", "n_ref").alias("wer"), ratio("cost", c("cost") + c("hits")).alias("mer"), wip.alias("wip"), (1 - wip).alias("wil"))


def character_error_rate(ref: str, cand: str) -> Column:
    return ratio(F.levenshtein(F.col(ref), F.col(cand)), F.char_length(F.col(ref)))


@F.pandas_udf(struct_of(lcs="long"))
def common_subsequence(ref: pd.Series, cand: pd.Series) -> pd.DataFrame:
    """Length of the longest common word subsequence."""
    return pd.DataFrame({"lcs": in_step(ref, cand, _common)[0]})


def rouge_l(df: DataFrame, ref: str, cand: str) -> DataFrame:
    d = df.withColumn("_r", words(F.col(ref))).withColumn("_c", words(F.col(cand)))
    d = d.withColumn("_lcs", common_subsequence("_r", "_c")["lcs"])
    p, r = ratio("_lcs", F.size("_c")), ratio("_lcs", F.size("_r"))
    return d.select("*", ratio(2 * p * r, p + r).alias("rouge_l")).drop("_r", "_c", "_lcs")


def ngrams(tokens: str, n: int) -> Column:
    size = F.size(tokens) - n + 1
    grams = F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(size > 0, grams).otherwise(F.array().cast("array<string>"))


def ngram_overlap(df: DataFrame, keys: Sequence[str], ref: str, cand: str, orders: Sequence[int]) -> DataFrame:
    """(keys, n, hits, n_ref, n_cand): clipped n-gram matches, from one combining count per gram."""
    t = df.select(*keys, words(F.col(ref)).alias("_r"), words(F.col(cand)).alias("_c"))
    parts = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(side == "_r").alias("is_ref"), ngrams(side, n).alias("grams")) for n in orders for side in ("_r", "_c")])
    g = t.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.n", "p.is_ref", F.explode_outer("p.grams").alias("gram"))
    counts = g.groupBy(*keys, "n", "gram").agg(
        F.count_if(F.col("is_ref") & F.col("gram").isNotNull()).alias("r"), F.count_if(~F.col("is_ref") & F.col("gram").isNotNull()).alias("c")
    )
    return counts.groupBy(*keys, "n").agg(F.sum(F.least("r", "c")).alias("hits"), F.sum("r").alias("n_ref"), F.sum("c").alias("n_cand"))


def rouge_n(overlap: DataFrame) -> DataFrame:
    p, r = ratio("hits", "n_cand"), ratio("hits", "n_ref")
    return overlap.select("*", r.alias("recall"), p.alias("precision"), ratio(2 * p * r, p + r).alias("f1"))


def bleu(df: DataFrame, keys: Sequence[str], ref: str, cand: str, order: int = 4) -> DataFrame:
    """Geometric mean of clipped 1..4-gram precisions times the brevity penalty; 0 if any precision is 0."""
    o = ngram_overlap(df, keys, ref, cand, range(1, order + 1))
    first = lambda c: F.max(F.when(F.col("n") == 1, F.col(c)))
    b = o.groupBy(*keys).agg(
        F.min("hits").alias("worst"), F.avg(F.when(F.col("hits") > 0, F.ln(F.col("hits") / F.col("n_cand")))).alias("log_p"), first("n_ref").alias("r"), first("n_cand").alias("c")
    )
    brevity = F.when(F.col("c") >= F.col("r"), 1.0).otherwise(F.exp(1 - F.try_divide(F.col("r"), F.col("c"))))
    return b.select(*keys, F.when(F.col("worst") > 0, brevity * F.exp("log_p")).otherwise(0.0).alias("bleu"))


def meteor(df: DataFrame, keys: Sequence[str], ref: str, cand: str) -> DataFrame:
    """Exact-word METEOR: words align by occurrence, chunks are runs adjacent on both sides."""
    keys = list(keys)

    def side(c: str, pos: str) -> DataFrame:
        t = df.select(*keys, F.posexplode(words(F.col(c))).alias(pos, "word"))
        return t.withColumn("occ", F.row_number().over(W.partitionBy(*keys, "word").orderBy(pos)))  # one text at a time

    m = side(ref, "i").join(side(cand, "j"), [*keys, "word", "occ"])
    order = W.partitionBy(*keys).orderBy("j")
    new = (F.col("i") - F.lag("i").over(order) != 1) | (F.col("j") - F.lag("j").over(order) != 1)
    m = m.withColumn("new", F.coalesce(new, F.lit(True))).groupBy(*keys).agg(F.count("*").alias("m"), F.count_if("new").alias("chunks"))
    t = df.select(*keys, F.size(words(F.col(ref))).alias("n_ref"), F.size(words(F.col(cand))).alias("n_cand")).join(m, keys, "left")
    p, r = ratio("m", "n_cand"), ratio("m", "n_ref")
    score = ratio(10 * p * r, r + 9 * p) * (1 - 0.5 * ratio("chunks", "m"))
    return t.select(*keys, F.when(F.col("m") > 0, score).otherwise(0.0).alias("meteor"))


def text_properties(c: Column) -> list[Column]:
    """Character (with and without spaces), word, sentence and non-ASCII counts, and vocabulary level."""
    w = words(c)
    return [
        F.char_length(c).alias("characters"), F.char_length(F.regexp_replace(c, r"\s", "")).alias("characters_no_space"), F.size(w).alias("words"),
        F.regexp_count(c, F.lit(r"[.!?]+")).alias("sentences"), F.regexp_count(c, F.lit(r"[^\x00-\x7F]")).alias("non_ascii"),
        ratio(F.size(F.array_distinct(w)), F.size(w)).alias("vocabulary_level"),
    ]


def summary_failed(gt: Column, cand: Column, least_words: int = 3) -> Column:
    """A summary fails without ground truth or with at most three words."""
    return gt.isNull() | cand.isNull() | (F.size(words(cand)) <= least_words)


def binary_label(score: Column, threshold: float, positive: str, negative: str) -> tuple[Column, Column]:
    """Label and its confidence from one score: negatives report 1 - score."""
    hit = score >= threshold
    return F.when(hit, positive).otherwise(negative), F.when(hit, score).otherwise(1 - score)


def label_confidence(scored: str, label: Column) -> Column:
    """Score of a label in an array of scored labels, 0 if absent."""
    return F.coalesce(F.get(F.filter(scored, lambda x: x["label"] == label), F.lit(0))["score"], F.lit(0.0))


def normalized_url(c: Column) -> Column:
    """URL without query and fragment."""
    return F.regexp_replace(c, r"[?#].*$", "")


def query_parameter(url: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def qa_correct(bert_f1: Column, rouge_1: Column, threshold: float) -> Column:
    return F.round((bert_f1 + rouge_1) / 2, 3) >= threshold


def question_suite(answers: DataFrame, case: str = "test_case", story: str = "story") -> DataFrame:
    """One row: distinct stories over all test cases, questions and correct answers counted per case, overall accuracy to three digits."""
    cases = answers.groupBy(case).agg(F.count_if("correct").alias("n_correct"), F.count("*").alias("n")).agg(F.sum("n").alias("n_questions"), F.sum("n_correct").alias("n_correct"))
    stories = answers.agg(F.count_distinct(story).alias("n_stories"))
    return cases.crossJoin(stories).select("n_stories", "n_questions", "n_correct", F.round(ratio("n_correct", "n_questions"), 3).alias("overall_accuracy"))  # two single rows
