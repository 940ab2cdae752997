"""License notices by an exact set-similarity join of templates with word runs, in DataFrame operations only.

A template is the word set of a notice; a block is any run of consecutive words a quarter longer than the notice. A template
is found where a block holds at least ``percent`` of its distinct words. All template words are put in one order, by their
count over all texts and then by spelling, so that words that are rare in this corpus come first. A block that holds enough
of a template's words holds one of the first size - need + 1 (the prefix): only those words are looked up, and each block is
judged at the first template word in the order that it holds. From there on no more than the rest of the template can be
shared (place), and the words around must hold enough of it (length), before its runs are compared one by one.

Phrases are found word for word, looked up by their rarest word.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything but \x00-\x2F, \x3A-\x60 and \x7B-\x7F; several times faster than the same class written by what it leaves out.
WORD = "[0-9a-z\\x80-\\x{10FFFF}]+"
PERCENT = 90

#: Phrases that stand for a license wherever they are found word for word.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

#: Notices as they are commonly written, with their labels.
TEMPLATES = (
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("bsd", "bsd license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal"),
    ("epl", "eclipse public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license"),
    ("mit", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
    ("reserved", "all rights reserved"),
)

#: The documented bound of what goes to all tasks: words of all phrases and templates together.
MOST_WORDS = 100_000


def block_width(notice: str) -> int:
    return len(notice.split()) * 5 // 4


def needed(notice: str, percent: int) -> int:
    return -(-len(set(notice.split())) * percent // 100)


def words_of(text: Column) -> Column:
    """A text's words, A-Z lower-cased; none for a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))


def _table(docs: DataFrame, rows: list[tuple], names: str) -> DataFrame:
    """A small constant table."""
    cells = [F.struct(*[F.array(*map(F.lit, v)).cast("array<string>") if isinstance(v, list) else F.lit(v) for v in row]) for row in rows]
    return docs.sparkSession.range(1).select(F.inline(F.array(*cells))).toDF(*names.split())


def word_counts(docs: DataFrame, words: set[str], text: str = "text") -> dict[str, int]:
    """How often each of the given words stands in all texts."""
    wanted = F.broadcast(_table(docs, [(w,) for w in sorted(words)], "word"))
    found = docs.select(F.explode_outer(words_of(F.col(text))).alias("word")).join(wanted, "word").groupBy("word").agg(F.count("*").alias("n"))
    return dict.fromkeys(words, 0) | {r.word: r.n for r in found.collect()}


LOOKUP = "word kind label offset width need size wanted"


def _lookups(phrases: tuple, templates: tuple, percent: int, counts: dict[str, int]) -> list[tuple]:
    """Rows (LOOKUP): what to compare where the word stands."""
    rows = []
    for label, phrase in phrases:
        listed = phrase.split()
        rarest = min(listed, key=lambda w: (counts[w], w))
        rows.append((rarest, "phrase", label, listed.index(rarest), len(listed), len(listed), len(listed), listed))
    for label, notice in templates:
        order = sorted(set(notice.split()), key=lambda w: (counts[w], w))
        need = needed(notice, percent)
        for i in range(len(order) - need + 1):
            rows.append((order[i], "template", label, i, block_width(notice), need, len(order), order[i:]))
    return rows


def _places(docs: DataFrame, keep: list[Column], phrases: tuple, templates: tuple, percent: int, text: str, ends: bool) -> DataFrame:
    """The kept columns, n_words, kind, label, place and score of everything found; with ``ends`` also a row of kind 'text' per text."""
    notices = [n for _, n in (*phrases, *templates)]
    if any(not n or re.search(r"[\x00-\x1f\x21-\x2f\x3a-\x60\x7b-\x7f]", n) or n != " ".join(n.split()) for n in notices):
        raise ValueError("phrases and templates are words in lower case with single spaces")
    if sum(len(n.split()) for n in notices) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} words of phrases and templates")
    if not 0 < percent <= 100:
        raise ValueError("percent lies above 0 and at most at 100")
    rows = _lookups(phrases, templates, percent, word_counts(docs, {w for n in notices for w in n.split()}, text))
    if ends:
        rows.append(("", "text", "", 0, 1, 1, 1, [""]))
    lookups = F.broadcast(_table(docs, rows, LOOKUP))
    texts = docs.select(*keep, words_of(F.col(text)).alias("words"))
    # The outer form, as the other one is preceded by a filter that finds all words once more.
    listed = F.concat("words", F.array(F.lit(""))) if ends else F.col("words")
    spread = texts.select("*", F.posexplode_outer(listed).alias("at", "word"))
    met = spread.join(lookups, "word")
    # around holds the words that a block with this word can hold; the text's own words stay behind. Written, as only generated
    # code passes words on without a copy of the text's array for each of them, and the comparisons below are none.
    template = F.col("kind") == "template"
    start = F.when(template, F.greatest(F.col("at") - F.col("width") + 1, F.lit(0))).otherwise(F.col("at") - F.col("offset"))
    met = met.withColumn("start", start.cast("int")).where("start >= 0")
    around = F.when(F.col("kind") != "text", F.slice("words", F.col("start") + 1, F.when(template, F.col("at") - F.col("start")).otherwise(0) + F.col("width")))
    names = [c for c in texts.columns if c != "words"]
    met = met.select(*names, F.size("words").cast("bigint").alias("n_words"), "at", *LOOKUP.split()[1:], "start", around.alias("around"))
    met = Scratch(docs.sparkSession).write(met, "license-words")
    shared = F.size(F.array_intersect("wanted", "around"))
    begins = F.filter(F.sequence(F.lit(1), F.col("at") - F.col("start") + 1), lambda i: F.array_contains(F.col("wanted"), F.get("around", i - 1)))
    most = F.array_max(F.transform(begins, lambda i: F.size(F.array_intersect("wanted", F.slice("around", i, F.col("width"))))))
    met = met.withColumn("most", F.when(template, F.when((F.col("size") - F.col("offset") >= F.col("need")) & (shared >= F.col("need")), most)).when((F.col("kind") == "text") | (F.col("around") == F.col("wanted")), F.col("size")))
    place = F.when(template, F.col("at")).otherwise(F.col("start")).cast("bigint").alias("place")
    return met.where("most >= need").select(*names, "n_words", "kind", "label", place, F.when(F.col("kind") == "text", 0.0).otherwise(F.col("most") / F.col("size")).alias("score"))


def license_places(docs: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """``docs`` without the text, one row for everything found: kind, label, place (a word number from 0), score and n_words.

    A phrase gives one row for each place where it starts, score 1. A template gives one row for each of its prefix words that
    stands in a block with enough of it: the place of that word and the best share of the template among such blocks.
    """
    keep = [F.col(c) for c in docs.columns if c != text]
    taken = {"n_words", "kind", "label", "place", "score", "words", "at", "word", "start", "around", "most", "offset", "width", "need", "size", "wanted"}
    if clash := sorted(c for c in docs.columns if c != text and c.lower() in taken):
        raise ValueError(f"rename the columns {clash}")
    return _places(docs, keep, phrases, templates, percent, text, ends=False)


def scan_licenses(docs: DataFrame, phrases: tuple = PHRASES, templates: tuple = TEMPLATES, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of phrases, first_word and last_word are the smallest and largest start (null without any);
    base_labels are the labels of phrases found, labels those and the templates', both distinct, sorted and joined by commas
    (empty without any); score is the largest share of a phrase or template found, 0 without any. A null text is empty. Null
    and repeated keys are kept: rows are told apart by key and text, and rows that repeat both get equal results. Other
    columns are not read. An empty table gives an empty one.
    """
    labels = sorted({label for label, _ in (*phrases, *templates)})
    if len(labels) > 62:
        raise ValueError("more than 62 labels")
    keep = [F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("code")]
    found = _places(docs, keep, phrases, templates, percent, text, ends=True)
    bit = F.lit(0).cast("bigint")
    for i, label in enumerate(labels):
        bit = F.when(F.col("label") == label, F.lit(1 << i).cast("bigint")).otherwise(bit)
    phrase = F.col("kind") == "phrase"
    grouped = found.groupBy("id", "code").agg(
        F.count_if(F.col("kind") == "text").alias("copies"), F.max("n_words").alias("n_words"), F.count_if(phrase).alias("n"),
        F.min(F.when(phrase, F.col("place"))).alias("first_word"), F.max(F.when(phrase, F.col("place"))).alias("last_word"),
        F.bit_or(F.when(phrase, bit).otherwise(0)).alias("base"), F.bit_or(bit).alias("every"), F.max("score").alias("score"),
    )

    def joined(bits: str) -> Column:
        return F.concat_ws(",", *[F.when(F.col(bits).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, label) for i, label in enumerate(labels)])

    rows = grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    n_base = (F.col("n") / F.col("copies")).cast("bigint").alias("n_base")
    return rows.select(F.col("id").alias(key), "n_words", n_base, "first_word", "last_word", joined("base").alias("base_labels"), joined("every").alias("labels"), "score")
