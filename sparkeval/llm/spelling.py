"""Spelling variants by pivotal grams: words one edit apart, the commoner form of each, and the root of its chain.

All bigrams are put in one order, rare ones first. A word's prefix is its bigrams up to the third in that order; two of
them that do not overlap, the rarest such pair by dynamic programming over the prefix, are its pivots. One edit leaves at
least one of the two pivots whole, and if the prefix of word r ends no later in the order than that of word s, that pivot is
in the prefix of s. So pivots of r are joined with prefixes of s only, from the word whose prefix ends first.

Position limits: an edit after a pivot leaves all letters up to the pivot's end in place, counted from the left; an edit
before one leaves all letters from the pivot on in place, counted from the right. The join key therefore holds the letters
up to (or from) the bigram and the length of s, which is that of r give or take one; for an edit between the pivots, or in
one of them, also the word's letter at the other end if that lies beyond the other pivot. So a common bigram is no common
key. What meets is compared by a letter summary and then by the edit distance itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch

#: The letters that are lower-cased.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROUNDS = 64


def occurrences(docs: DataFrame, noise: int = 97, least_length: int = 5) -> DataFrame:
    """(word) of every run of letters of the texts, A-Z lower-cased, if ``least_length`` code points or more are left.

    Where ``noise`` divides the CRC-32 h of ``<doc_id>:<run>``, the run loses its code point h % length. A null text has no
    runs; a null doc_id counts as an empty one.
    """
    lowered = F.translate("text", UPPER, UPPER.lower())
    # The outer form, as the other one is preceded by a filter that finds all runs once more.
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode_outer(F.regexp_extract_all(lowered, F.lit("([a-zÀ-ÿ]+)"), F.lit(1))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.where(F.length("run") >= least_length).select(F.when(h % noise == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)


def bigram_order(words: DataFrame) -> dict[str, int]:
    """Every bigram's place in the order of (number of words with it, bigram); at most 90 x 90 of them, whatever the corpus."""
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    rows = words.select("word", at.alias("i")).groupBy(F.expr("substring(word, i, 2)").alias("gram")).agg(F.count("*").alias("n")).collect()
    return {gram: place for place, (_, gram) in enumerate(sorted((r.n, r.gram) for r in rows))}


def choose_pivots(word: str, order: dict[str, int]) -> tuple[int, list[int], tuple[int, int]]:
    """The order's place where the word's prefix ends, the positions of the prefix bigrams, and the two pivots (left, right).

    The prefix holds every bigram up to the third occurrence in the order, with all repeats of the last one. Three
    occurrences always hold two that do not overlap.
    """
    ranks = [order[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[2]
    prefix = [i for i, rank in enumerate(ranks) if rank <= last]
    # best[k]: the rarest way to have chosen k + 1 bigrams without overlap among those seen; the first waits until it is two letters back.
    one: tuple[int, int] | None = None
    two: tuple[int, int, int] | None = None
    waiting: list[int] = []
    for i in prefix:
        while waiting and waiting[0] <= i - 2:
            j = waiting.pop(0)
            one = min(one or (ranks[j], j), (ranks[j], j))
        if one is not None:
            pair = (one[0] + ranks[i], one[1], i)
            two = min(two or pair, pair)
        waiting.append(i)
    return last, prefix, (two[1], two[2])


def pivoted(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """``words`` (word, n) with last, prefix and the pivots left and right (positions from 0)."""
    shared = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = [choose_pivots(word, shared.value) for word in batch.column("word").to_pylist()]
            new = [
                pa.array([c[0] for c in chosen], pa.int32()), pa.array([c[1] for c in chosen], pa.list_(pa.int32())),
                pa.array([c[2][0] for c in chosen], pa.int32()), pa.array([c[2][1] for c in chosen], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *new], names=["word", "n", "last", "prefix", "left", "right"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, last int, prefix array<int>, left int, right int")


def _key(side: str, part: Column, beyond: Column, length: Column) -> Column:
    return F.xxhash64(F.lit(side), part, beyond, length.cast("int"))


def _letters(word: Column) -> Column:
    """One bit for each letter (modulo 64) that the word has an odd number of times; one edit changes at most two."""
    codes = F.transform(F.split(word, ""), lambda c: F.pmod(F.ascii(c), F.lit(64)))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda bits, code: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), code)))


#: What r (a, with pivots at left and right) and s (b) share, by the place of the edit: after both pivots, before both,
#: after the left one, else at the left one. The letters beyond the other pivot are shared too; the key holds one of them.
SHARED = (
    "substring(a, 1, right + 2) = substring(b, 1, right + 2)",
    "substring(a, left + 1, length(a)) = right(b, length(a) - left)",
    "substring(a, 1, left + 2) = substring(b, 1, left + 2) AND (length(a) = right + 2 OR right(a, 1) = right(b, 1))",
)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, na, nb): every pair of words exactly one inserted, deleted or replaced code point apart, once.

    ``words`` holds distinct words of at least four code points and their counts (word, n). Each pair is reported by one
    row of the join: from the word whose prefix ends first, by the first place of the edit that fits.
    """
    scratch = Scratch(words.sparkSession)
    placed = scratch.write(pivoted(words, bigram_order(words)).withColumn("bits", _letters(F.col("word"))), "spelling-pivots")
    n, letter = F.length("word"), F.lit("")
    sized = placed.select("*", F.explode(F.array(n - 1, n, n + 1)).alias("length"))
    parts = [
        ("L", "substring(word, 1, right + 2)", letter),
        ("R", "substring(word, left + 1, length(word))", letter),
        ("L", "substring(word, 1, left + 2)", F.when(n > F.col("right") + 2, F.right("word", F.lit(1))).otherwise("")),
        ("R", "substring(word, right + 1, length(word))", F.when(F.col("left") > 0, F.left("word", F.lit(1))).otherwise("")),
    ]
    keys = F.posexplode(F.array(*[_key(side, F.expr(part), beyond, F.col("length")) for side, part, beyond in parts])).alias("place", "key")
    pivots = sized.select(F.col("word").alias("a"), F.col("n").alias("na"), F.struct("last", "word").alias("ends"), "left", "right", F.col("bits").alias("abits"), keys)
    grams = placed.select("*", F.explode("prefix").alias("i"))
    begins, finishes = F.expr("substring(word, 1, i + 2)"), F.expr("substring(word, i + 1, length(word))")
    open_ = F.array(_key("L", begins, letter, n), _key("R", finishes, letter, n))
    tail = F.when(n > F.col("i") + 2, F.array(_key("L", begins, F.right("word", F.lit(1)), n)))
    head = F.when(F.col("i") > 0, F.array(_key("R", finishes, F.left("word", F.lit(1)), n)))
    none = F.array().cast("array<bigint>")
    held = F.explode(F.concat(open_, F.coalesce(tail, none), F.coalesce(head, none))).alias("key")
    prefixes = grams.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.struct("last", "word").alias("bends"), F.col("bits").alias("bbits"), held)
    cheap = (F.col("ends") < F.col("bends")) & (F.bit_count(F.col("abits").bitwiseXOR(F.col("bbits"))) <= 2)
    told = F.lit(False)
    for place, shared in enumerate(SHARED):
        told = told | ((F.col("place") > place) & F.expr(shared))
    near = F.when(cheap, (F.levenshtein("a", "b", 1) == 1) & ~told).otherwise(F.lit(False))
    joined = pivots.join(prefixes, (pivots["key"] == prefixes["key"]) & near)
    out = scratch.write(joined.select("a", "b", "na", "nb"), "spelling-pairs")
    scratch.drop(placed)
    return out


def word_forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word from the pairs of near ones."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))).alias("e")
    best = F.min(F.struct((-F.col("m")).alias("minus"), F.col("other").alias("other")))
    near = pairs.select(ends).select("e.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    common = -F.col("best.minus") >= 2 * F.col("n")
    return words.join(near, "word", "left").select(
        "word", F.when(common, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(common, -F.col("best.minus")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the end of its chain of forms.

    Each step at least doubles the count, so chains are short and without cycles; a round of jumps halves what is left of them.
    """
    scratch = Scratch(forms.sparkSession)
    jumps = scratch.write(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(ROUNDS):
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = scratch.write(jumps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        scratch.drop(jumps)
        jumps = moved.select("word", "root")
        done = moved.where("moved").isEmpty()
        if done:
            return jumps
    raise RuntimeError("a chain of forms did not end")


def spelling_variants(docs: DataFrame, noise: int = 97, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are the results of ``occurrences`` with at least ``least_count`` of them over all whole texts. Two words are near
    if one inserted, deleted or replaced code point makes them equal; a word's form is its near word of the largest count (ties:
    the first in code-point order) if that is at least twice its own, else null. root follows the forms to the last one, and
    is the word itself without any. Repeated rows count as often as they stand there; null texts and empty texts have no
    words; an empty table gives an empty one. Columns other than doc_id and text are not read, so their names cannot clash.
    """
    if least_length < 4:
        raise ValueError("two pivots need words of at least four code points")
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(occurrences(docs.select("doc_id", "text"), noise, least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count), "spelling-words")
    forms = scratch.write(word_forms(words, near_pairs(words)), "spelling-forms")
    ends = roots(forms)
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
