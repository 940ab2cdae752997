"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line's tokens are its distinct words, lower-cased. A line goes if an earlier line (by doc_id, then place in the text) has
a Jaccard similarity of at least ``percent`` with it. Lines of equal token sets are one class, numbered in the order of
their first lines. Of two similar sets in one order of all tokens, the first n - ceil(t * n) + 1 tokens of each share a token
(the prefix). From the first shared token on, each set must still hold as many tokens as have to be shared, the sizes bound
each other, and so do the parities of 64 to 256 token classes, as many as the sets are large: every bit in which two parities
differ is a token that only one set has. Two sets must also share enough prefix tokens: the rest of the one whose prefix ends first cannot make up for more. The
order puts rare tokens first: it sorts by half powers of two of a token's slot count, from a table of fixed size over all
lines, then by hash, so that no count has to be looked up by a join. What passes is counted on the full token sets.

The classes that share a prefix token are compared with the first of them, which decides whole groups of near copies; only
classes that this leaves undecided are then compared with every earlier class of their prefix tokens, in rounds that each
take a part of the tokens, so that no exchange holds them all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkeval.llm.common import Scratch, fresh

SLOT_BITS, PACK_BITS = 17, 12
#: Words of a parity at most, and the rounds of the last comparison.
WORDS, ROUNDS = 4, 3
BITS = [f"b{k}" for k in range(WORDS)]
#: Levels are one ASCII character each, from "0" on.
ZERO, TOP = 48, 78
SPACE = "[ \\t\\x0b\\f\\r]+"


def _worded(line: Column) -> Column:
    return F.rlike(line, F.lit("[^ \\t\\x0b\\f\\r]"))


def slot_levels(texts: DataFrame) -> Column:
    """For each hash slot twice the binary logarithm of its word count over all texts, a constant of one byte for each slot."""
    words = texts.select(F.explode(F.split(F.lower("text"), "[ \\t\\n\\x0b\\f\\r]+")).alias("word"))
    slots = words.select(F.shiftrightunsigned(F.xxhash64("word"), 64 - SLOT_BITS).cast("int").alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    level = F.char(F.least(F.floor(2 * F.log2("n")), F.lit(TOP)) + ZERO)
    cell = F.struct(F.col("slot").bitwiseAND((1 << PACK_BITS) - 1).alias("at"), level.alias("level"))
    packed = slots.groupBy(F.shiftright("slot", PACK_BITS).alias("part")).agg(F.array_sort(F.collect_list(cell)).alias("cells"))  # at most 2^PACK_BITS
    gap = lambda x, i: F.repeat(F.lit("0"), x.at - F.coalesce(F.get(F.col("cells"), i - 1).at, F.lit(-1)) - 1)
    filled = F.array_join(F.transform("cells", lambda x, i: F.concat(gap(x, i), x.level)), "")
    found = dict(packed.select("part", F.rpad(filled, 1 << PACK_BITS, "0")).collect())
    blank = "0" * (1 << PACK_BITS)
    return F.lit("".join(found.get(part, blank) for part in range(1 << (SLOT_BITS - PACK_BITS))).encode())


def ranked_tokens(line: Column, levels: Column) -> Column:
    """The line's distinct tokens in the global order: level in the top bits, 56 bits of hash below."""

    def rank(word: Column) -> Column:
        token = F.xxhash64(word)
        slot = F.shiftrightunsigned(token, 64 - SLOT_BITS).cast("int")
        level = F.ascii(F.substring(levels, slot + 1, 1).cast("string")) - ZERO
        return F.shiftleft(level.cast("bigint"), 56) + token.bitwiseAND((1 << 56) - 1)

    words = F.split(F.btrim(F.lower(line), F.lit(" \t\x0b\f\r")), SPACE)
    return F.sort_array(F.array_distinct(F.transform(words, rank)))


def _ceil_share(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100)


def _places() -> tuple[Column, Column, Column, Column]:
    """Sizes of the two sets and places of a token that they share, from (at, cat)."""
    low = (1 << 31) - 1
    return F.shiftrightunsigned("at", 31), F.shiftrightunsigned("cat", 31), F.col("at").bitwiseAND(low), F.col("cat").bitwiseAND(low)


def _need(percent: int) -> Column:
    """How many tokens the two sets of (at, cat) have to share."""
    n, m, _, _ = _places()
    return F.ceil(percent * (n + m) / (100 + percent))


def _size_classes(n: Column, percent: int) -> Column:
    """The twofold size classes of a set: its own, and the next one if sets of that can be similar to it."""
    own = F.floor(F.log2(n))
    return F.when(100 * n >= percent * F.pow(F.lit(2), own + 1), F.array(own, own + 1)).otherwise(F.array(own))


def _width(size_class: Column) -> Column:
    """Words of the parities in a size class: two random sets of it differ in far more bits than similar ones may."""
    return F.least(F.lit(WORDS), F.pow(F.lit(2), F.greatest(size_class - 5, F.lit(0)))).cast("int")


def parities(tokens: Column, percent: int) -> Column:
    """The parity of the tokens in each of 64 classes a word, in as many words as the largest size class of the set takes."""

    def word(k: int, width: int) -> Column:
        flip = lambda acc, t: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), t.bitwiseAND(63).cast("int")))
        own = lambda acc, t: F.when(t.bitwiseAND(64 * (width - 1)) == 64 * k, flip(acc, t)).otherwise(acc)
        return F.aggregate(tokens, F.lit(0).cast("bigint"), own if width > 1 else flip)

    width = _width(F.array_max(_size_classes(F.size(tokens), percent)))
    wide = F.when(width == 1, F.array(word(0, 1)))
    for w in (1 << i for i in range(1, WORDS.bit_length())):
        wide = wide.when(width == w, F.array(*[word(k, w) for k in range(w)]))
    return F.coalesce(wide, F.array().cast("array<bigint>"))


def folded(bits: Column, width: Column) -> list[Column]:
    """The parities in ``width`` words, the rest of ``WORDS`` 0."""
    part = lambda k: F.aggregate(F.filter(bits, lambda _, i: F.pmod(i, width) == k), F.lit(0).cast("bigint"), lambda acc, x: acc.bitwiseXOR(x))
    return [F.when(F.lit(k) < width, part(k)).otherwise(F.lit(0).cast("bigint")).alias(b) for k, b in enumerate(BITS)]


def _alike(percent: int, bits: list[str]) -> Column:
    """Whether the sets of (at, bits) and (cat, bits with a c before them) can be similar by their sizes and parities."""
    n, m, _, _ = _places()
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    differ = sum((F.bit_count(F.col(b).bitwiseXOR(F.col(f"c{b}"))) for b in bits), F.lit(0))
    return sizes & (differ <= n + m - 2 * _need(percent))


def _first(percent: int) -> Column:
    """Whether they can be similar if the token of these places is the first that they share."""
    n, m, i, j = _places()
    return F.least(n - i, m - j) >= _need(percent)


def _any(percent: int) -> Column:
    """Whether they can be similar if they share the token of these places, be it the first or not."""
    n, m, i, j = _places()
    return F.least(i, j) + F.least(n - i, m - j) >= _need(percent)


def _enough(percent: int) -> Column:
    """How many prefix tokens they have to share: the prefix that ends first holds all that they share up to its end."""
    n, m, _, _ = _places()
    return _need(percent) - _ceil_share(F.greatest(n, m), percent) + 1


def removed_classes(scratch: Scratch, docs: DataFrame, classes: DataFrame, levels: Column, percent: int) -> DataFrame:
    """(id) of the classes that have an earlier similar class."""
    # A bucket is a token and a size class, twofold wide; sets that can be similar to sets of the next class are in that one too.
    def sized(of: DataFrame, width: Column) -> DataFrame:
        single = of.select("id", "n", F.explode(_size_classes(F.col("n"), percent)).alias("class"), "prefix", "bits")
        return single.select("id", "n", "class", "prefix", *folded(F.col("bits"), width))

    def places(of: DataFrame, wanted: Column) -> DataFrame:
        single = of.select("id", "n", "class", *BITS, F.posexplode("prefix").alias("place", "token")).where(wanted)
        bucket = F.shiftleft(F.col("token").cast("bigint"), 8) + F.col("class")
        return single.select(bucket.alias("token"), "id", *BITS, (F.shiftleft(F.col("n").cast("bigint"), 31) + F.col("place")).alias("at"))

    all_ = places(sized(classes, F.lit(1)), F.lit(True)).withColumnRenamed("b0", "bits")
    # For the star the shorter prefix does that suffices against a set of at least the same size; it only has to find most.
    n_, place = F.shiftrightunsigned("at", 31), F.col("at").bitwiseAND((1 << 31) - 1)
    rare = all_.where(place < n_ - F.ceil(2 * percent * n_ / (100 + percent)) + 1).select("token", "id", "bits", "at")
    first = rare.groupBy("token").agg(F.count("*").alias("size"), F.min("id").alias("cid"), F.min_by("at", "id").alias("cat"), F.min_by("bits", "id").alias("cbits")).where("size > 1").drop("size")
    pair = [F.col("cid").alias("a"), F.col("id").alias("b")]
    star = scratch.write(rare.join(first, "token").where((F.col("id") > F.col("cid")) & _alike(percent, ["bits"]) & _first(percent)).select(*pair).distinct(), "line-pairs")
    decided = _similar(scratch, docs, classes, star, levels, percent)
    # A decided class has the number -1 - id: no number is before it, so it is only what others are compared with.
    known = decided.select("id", F.lit(True).alias("known"))
    signed = classes.join(known, "id", "left").withColumn("id", F.when(F.col("known"), -1 - F.col("id")).otherwise(F.col("id"))).drop("known")
    signed = scratch.write(sized(signed, _width(F.col("class"))), "line-signed")
    number = F.greatest("cid", -1 - F.col("cid"))
    rounds = []
    for k in range(ROUNDS):
        part = F.pmod("token", F.lit(ROUNDS)) == k
        open_ = places(signed, part)
        earlier = places(signed, part).withColumnsRenamed({"id": "cid", "at": "cat"} | {b: f"c{b}" for b in BITS})
        # Two sets may meet in two size classes; the larger one's own is where their shared tokens are counted.
        met = open_.join(earlier, "token").where((number < F.col("id")) & _alike(percent, BITS) & _any(percent))
        met = met.where(F.col("token").bitwiseAND(255) == F.floor(F.log2(F.greatest(*_places()[:2]))))
        hits = met.groupBy(number.alias("a"), F.col("id").alias("b"), _enough(percent).alias("enough")).agg(F.count("*").alias("shared"), F.max(_first(percent)).alias("first"))
        rounds.append(scratch.write(hits, "line-hits"))
    hits = reduce(DataFrame.unionByName, rounds).groupBy("a", "b", "enough").agg(F.sum("shared").alias("shared"), F.max("first").alias("first"))
    more = scratch.write(hits.where("first AND shared >= enough").select("a", "b"), "line-pairs")
    scratch.drop(signed, *rounds)
    late = _similar(scratch, docs, classes, more, levels, percent)
    scratch.drop(star, more)
    return decided.unionByName(late).distinct()


def _similar(scratch: Scratch, docs: DataFrame, classes: DataFrame, pairs: DataFrame, levels: Column, percent: int) -> DataFrame:
    """(id) of each b of the pairs whose full token set is similar to its a's."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(classes, "id")
    asked = needed.groupBy("row").agg(F.collect_list(F.struct("id", "place")).alias("asked"))  # at most the lines of a document
    lines = docs.join(asked, "row").select("asked", F.split("text", "\n").alias("lines"))
    picked = lines.select(F.explode(F.transform("asked", lambda x: F.struct(x.id.alias("id"), F.get("lines", x.place).alias("line")))).alias("p"))
    tokens = scratch.write(picked.select("p.id", ranked_tokens(F.col("p.line"), levels).alias("tokens")).dropDuplicates(["id"]), "line-tokens")
    both = pairs.join(tokens.withColumnsRenamed({"id": "a", "tokens": "x"}), "a").join(tokens.withColumnsRenamed({"id": "b", "tokens": "y"}), "b")
    sized = both.select("b", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("total"))
    out = scratch.write(sized.where(f"100 * shared >= {percent} * (total - shared)").select(F.col("b").alias("id")).distinct(), "line-decided")
    scratch.drop(tokens)
    return out


def dedup_lines(docs: DataFrame, percent: int = 80, key: str = "doc_id", text: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` with the later matches of every line removed from ``text``, and how many lines with words it had and lost.

    Whole texts, cut at line feeds. Lines without words stay; a null text stays null and has no lines. Every row stays, an
    emptied text is empty. Null ids come first in the order. Rows that repeat id and text are one document: each copy gets
    the same result. Other columns pass through; count columns that clash get underscores. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    row = fresh(docs.columns, "row")
    keyed = docs.withColumn(row, F.xxhash64(F.col(key), F.col(text)))
    texts = keyed.select(F.col(row).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    lines = texts.select("key", "row", F.posexplode(F.split("text", "\n")).alias("place", "line")).where(_worded(F.col("line")))
    levels = slot_levels(texts)
    sets = lines.select("key", "row", "place", ranked_tokens(F.col("line"), levels).alias("tokens"))
    n = F.size("tokens")
    prefix = F.when(n * (100 - percent) >= percent, F.transform(F.slice("tokens", 1, (n - _ceil_share(n, percent) + 1).cast("int")), lambda t: F.hash(t)))
    marked = sets.select(F.xxhash64("tokens").alias("set"), n.alias("n"), F.struct("key", "row", "place").alias("first"), F.coalesce(prefix, F.array().cast("array<int>")).alias("prefix"), parities(F.col("tokens"), percent).alias("bits"))
    grouped = marked.groupBy("set", "n").agg(F.min("first").alias("first"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    ordered = grouped.select("first.*", "n", "prefix", "bits").orderBy("key", "row", "place")
    classes = scratch.write(ordered.select(F.monotonically_increasing_id().alias("id"), "row", "place", "n", "prefix", "bits"), "line-classes")
    gone = removed_classes(scratch, texts.select("row", "text"), classes, levels, percent)
    kept = scratch.write(classes.join(gone, "id", "left_anti").groupBy("row").agg(F.collect_set("place").alias("kept")), "line-kept")
    scratch.drop(classes)
    return _rebuild(keyed, kept, row, text, counts).select(*docs.columns, *[fresh(docs.columns, c) for c in counts])


def _rebuild(keyed: DataFrame, kept: DataFrame, row: str, text: str, counts: tuple[str, str]) -> DataFrame:
    names = [fresh([c for c in keyed.columns if c != row], c) for c in counts]
    own = fresh(keyed.columns, "kept")
    lines = fresh([*keyed.columns, own], "lines")
    joined = keyed.join(kept.select(F.col("row").alias(row), F.col("kept").alias(own)), row, "left").withColumn(lines, F.split(text, "\n"))
    empty = F.array().cast("array<int>")
    blank = F.filter(F.transform(lines, lambda x, i: F.when(~_worded(x), i)), lambda i: i.isNotNull())
    places = F.sort_array(F.concat(F.coalesce(own, empty), blank))
    worded = F.coalesce(F.size(F.filter(lines, _worded)), F.lit(0))
    new = F.when(F.col(text).isNotNull(), F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n"))
    total = F.when(F.col(text).isNull(), 0).otherwise(worded)
    return joined.withColumns({text: new, names[0]: total, names[1]: total - F.coalesce(F.size(F.coalesce(own, empty)), F.lit(0))})
