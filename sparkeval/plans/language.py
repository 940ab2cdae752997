"""Queries on time segments, spans and text."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkeval.functions.ratios import r6
from sparkeval.operators import intervals, text
from sparkeval.plans import views
from sparkeval.plans.registry import query
from sparkeval.session import shared, table

REC = ["recording"]


def segs(spark, sf, side):
    return shared(spark, f"{sf}/seg_{side}", lambda: views.seg(spark, sf, side).select("recording", "speaker", "s", "e"))


@query("c10_speaker_co_occurrence", """SELECT r.recording, r.speaker AS ref_speaker, h.speaker AS hyp_speaker, round(sum(least(r.e, h.e) - greatest(r.s, h.s)), 4) AS seconds FROM w_seg r JOIN w_seg h
  ON r.side = 'ref' AND h.side = 'hyp' AND r.recording = h.recording AND r.s < h.e AND h.s < r.e GROUP BY 1, 2, 3""")  # fmt: skip
def c10(spark, sf):
    c = intervals.co_occurrence(segs(spark, sf, "ref"), segs(spark, sf, "hyp"), "recording", "speaker")
    return c.select("recording", "ref_speaker", "hyp_speaker", F.round("seconds", 4).alias("seconds"))


def merge_sql(name, source, by):
    return f"""{name}_i AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY {by} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS b FROM {source}),
{name}_g AS (SELECT *, sum(b) OVER (PARTITION BY {by} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM {name}_i),
{name} AS (SELECT {by}, min(s) AS s, max(e) AS e FROM {name}_g GROUP BY {by}, g)"""


REFHYP = "r0 AS (SELECT recording, speaker, s, e FROM w_seg WHERE side = 'ref'), h0 AS (SELECT recording, speaker, s, e FROM w_seg WHERE side = 'hyp')"


@query("d23_merge_segments", "SELECT recording, round(s, 6) AS s, round(e, 6) AS e FROM mr", ctes=REFHYP + ",\n" + merge_sql("mr", "r0", "recording"))
def d23(spark, sf):
    m = intervals.merged(segs(spark, sf, "ref"), REC)
    return m.select("recording", r6("s").alias("s"), r6("e").alias("e"))


@query("d23_merge_one_speaker", "SELECT recording, speaker, round(s, 6) AS s, round(e, 6) AS e FROM mr WHERE speaker = 'click'", ctes=REFHYP + ",\n" + merge_sql("mr", "r0", "recording, speaker"))
def d23b(spark, sf):
    m = intervals.merged(segs(spark, sf, "ref").where("speaker = 'click'"), ["recording", "speaker"])
    return m.select("recording", "speaker", r6("s").alias("s"), r6("e").alias("e"))


def cover_sql(name, a, b, by):
    on = " AND ".join(f"x.{c.strip()} = i.{c.strip()}" for c in by.split(","))
    return f"""{name}_b AS (SELECT DISTINCT {by}, t FROM (SELECT {by}, s AS t FROM {a} UNION ALL SELECT {by}, e FROM {a} UNION ALL SELECT {by}, s FROM {b} UNION ALL SELECT {by}, e FROM {b})),
{name}_x AS (SELECT {by}, t AS s, lead(t) OVER (PARTITION BY {by} ORDER BY t) AS e FROM {name}_b),
{name} AS (SELECT i.*, (SELECT count(*) FROM {a} x WHERE {on} AND x.s < i.e AND i.s < x.e) AS a, (SELECT count(*) FROM {b} x WHERE {on} AND x.s < i.e AND i.s < x.e) AS b FROM {name}_x i WHERE e IS NOT NULL)"""


MISS = REFHYP + ",\n" + cover_sql("cv", "r0", "h0", "recording") + ",\nms AS (SELECT recording, s, e FROM cv WHERE a > 0 AND b = 0),\n" + merge_sql("mm", "ms", "recording")


@query("d24_missed_speech", "SELECT recording, round(s, 6) AS s, round(e, 6) AS e FROM mm", ctes=MISS)
def d24(spark, sf):
    m = intervals.missed(segs(spark, sf, "ref"), segs(spark, sf, "hyp"), REC)
    return m.select("recording", r6("s").alias("s"), r6("e").alias("e"))


@query("d24_missed_speech_long", "SELECT recording, round(s, 6) AS s, round(e, 6) AS e FROM mm WHERE e - s >= 0.2", ctes=MISS)
def d24_long(spark, sf):
    """Missed speech without pieces shorter than 0.2 seconds."""
    m = intervals.missed(segs(spark, sf, "ref"), segs(spark, sf, "hyp"), REC, min_length=0.2)
    return m.select("recording", r6("s").alias("s"), r6("e").alias("e"))


@query("d24_false_speech", "SELECT recording, round(s, 6) AS s, round(e, 6) AS e FROM mm WHERE e - s >= 0.2", ctes=MISS.replace("WHERE a > 0 AND b = 0", "WHERE a = 0 AND b > 0"))
def d24_false(spark, sf):
    """Detected speech where nobody speaks: missed speech with the sides exchanged."""
    m = intervals.missed(segs(spark, sf, "hyp"), segs(spark, sf, "ref"), REC, min_length=0.2)
    return m.select("recording", r6("s").alias("s"), r6("e").alias("e"))


IDERR = (
    REFHYP + ",\nhk AS (SELECT * FROM h0 WHERE (recording, speaker) IN (SELECT recording, speaker FROM r0)),\n" + cover_sql("cv", "r0", "hk", "recording, speaker")
    + ",\nfn AS (SELECT recording, speaker, s, e FROM cv WHERE a > 0 AND b = 0), fp AS (SELECT recording, speaker, s, e FROM cv WHERE a = 0 AND b > 0),\n"
    + merge_sql("fnm", "fn", "recording, speaker") + ",\n" + merge_sql("fpm", "fp", "recording, speaker")
    + ",\nal AS (SELECT recording, s, e FROM (SELECT * FROM fnm UNION ALL SELECT * FROM fpm) WHERE e - s >= 0.2),\n" + merge_sql("am", "al", "recording")
)


@query("d24_identification_errors", "SELECT recording, count(*) AS n, round(sum(e - s), 4) AS seconds FROM am GROUP BY 1", ctes=IDERR)
def d24b(spark, sf):
    m = intervals.identification_errors(segs(spark, sf, "ref"), segs(spark, sf, "hyp"), "recording", "speaker")
    return m.groupBy("recording").agg(F.count("*").alias("n"), F.round(F.sum(F.col("e") - F.col("s")), 4).alias("seconds"))


PERMS = """sp AS (SELECT * FROM (VALUES (1, 'click'), (2, 'error'), (3, 'purchase'), (4, 'signup'), (5, 'view')) t(k, n)),
pm AS (SELECT row_number() OVER () AS pid, [a.n, b.n, c.n, d.n, e.n] AS p FROM sp a, sp b, sp c, sp d, sp e WHERE a.k <> b.k AND a.k <> c.k AND a.k <> d.k AND a.k <> e.k AND b.k <> c.k AND b.k <> d.k AND b.k <> e.k AND c.k <> d.k AND c.k <> e.k AND d.k <> e.k),
cells AS (SELECT pid, n AS rs, p[k] AS hs FROM pm, sp),
tot AS (SELECT co.recording, pid, sum(seconds) AS total FROM cells JOIN co ON co.ref_speaker = rs AND co.hyp_speaker = hs GROUP BY 1, 2),
bp AS (SELECT recording, max(total) AS total, arg_max(pid, total) AS pid FROM tot GROUP BY 1)"""
CO = """co AS (SELECT r.recording, r.speaker AS ref_speaker, h.speaker AS hyp_speaker, sum(least(r.e, h.e) - greatest(r.s, h.s)) AS seconds FROM {r} r JOIN {h} h ON r.recording = h.recording AND r.s < h.e AND h.s < r.e GROUP BY 1, 2, 3)"""


@query("d25_speaker_mapping", "SELECT recording, round(total, 4) AS seconds FROM bp", ctes=REFHYP + ",\n" + CO.format(r="r0", h="h0") + ",\n" + PERMS)
def d25(spark, sf):
    c = intervals.co_occurrence(segs(spark, sf, "ref"), segs(spark, sf, "hyp"), "recording", "speaker")
    return intervals.speaker_mapping(c, "recording").groupBy("recording").agg(F.round(F.sum("seconds"), 4).alias("seconds"))


DER = (
    REFHYP + ",\n" + merge_sql("rm", "r0", "recording, speaker") + ",\n" + merge_sql("hm", "h0", "recording, speaker") + ",\n" + CO.format(r="rm", h="hm") + ",\n" + PERMS + ",\n"
    + cover_sql("cv", "rm", "hm", "recording")
    + """,
du AS (SELECT recording, sum((e - s) * a) AS ref_s, sum((e - s) * b) AS hyp_s, sum((e - s) * greatest(a - b, 0)) AS miss, sum((e - s) * greatest(b - a, 0)) AS fa, sum((e - s) * least(a, b)) AS sh,
  coalesce(sum(e - s) FILTER (WHERE a > 0 AND b > 0), 0) AS tp, coalesce(sum(e - s) FILTER (WHERE a = 0 AND b > 0), 0) AS fp, coalesce(sum(e - s) FILTER (WHERE a > 0 AND b = 0), 0) AS fn, coalesce(sum(e - s) FILTER (WHERE a = 0 AND b = 0), 0) AS tn FROM cv GROUP BY 1),
idn AS (SELECT recording, sum(seconds) FILTER (WHERE ref_speaker = hyp_speaker) AS ident FROM co GROUP BY 1),
hb AS (SELECT recording, sum(m) AS hyp_best FROM (SELECT recording, hyp_speaker, max(seconds) AS m FROM co GROUP BY 1, 2) GROUP BY 1),
rb AS (SELECT recording, sum(m) AS ref_best FROM (SELECT recording, ref_speaker, max(seconds) AS m FROM co GROUP BY 1, 2) GROUP BY 1),
rl AS (SELECT recording, speaker, sum(e - s) AS rs FROM rm GROUP BY 1, 2), hl AS (SELECT recording, speaker, sum(e - s) AS hs FROM hm GROUP BY 1, 2),
je AS (SELECT rl.recording, avg(1 - coalesce(co.seconds, 0) / (rl.rs + CASE WHEN co.seconds IS NULL THEN 0 ELSE coalesce(hl.hs, 0) END - coalesce(co.seconds, 0))) AS jer FROM rl JOIN bp USING (recording) JOIN cells ON cells.pid = bp.pid AND cells.rs = rl.speaker
  LEFT JOIN co ON co.recording = rl.recording AND co.ref_speaker = rl.speaker AND co.hyp_speaker = cells.hs LEFT JOIN hl ON hl.recording = rl.recording AND hl.speaker = cells.hs GROUP BY 1)"""
)


@query("e49_diarization_metrics", """SELECT recording, round((fa + miss + sh - total) / ref_s, 5) AS diarization_error_rate, round(jer, 5) AS jaccard_error_rate, round(hyp_best / hyp_s, 5) AS purity, round(ref_best / ref_s, 5) AS coverage,
  round((tp + tn) / (tp + fp + fn + tn), 5) AS detection_accuracy, round(tp / (tp + fp), 5) AS detection_precision, round(tp / (tp + fn), 5) AS detection_recall, round((fa + miss + sh - ident) / ref_s, 5) AS identification_error_rate,
  round(ident / hyp_s, 5) AS identification_precision, round(ident / ref_s, 5) AS identification_recall FROM du JOIN bp USING (recording) JOIN idn USING (recording) JOIN hb USING (recording) JOIN rb USING (recording) JOIN je USING (recording)""", ctes=DER)  # fmt: skip
def e49(spark, sf):
    m = intervals.diarization_metrics(segs(spark, sf, "ref"), segs(spark, sf, "hyp"), "recording", "speaker")
    return m.select("recording", *[F.round(c, 5).alias(c) for c in m.columns if c != "recording"])


# -- spans -------------------------------------------------------------------------
SPANS = """tg AS (SELECT l_orderkey AS doc_id, l_linenumber AS idx, l_returnflag AS label, l_partkey % 50 AS s, l_partkey % 50 + 3 + l_linenumber AS e FROM w_line),
tq AS (SELECT l_orderkey AS doc_id, l_linenumber AS idx, CASE WHEN l_partkey % 7 = 0 THEN 'A' ELSE l_returnflag END AS label, l_partkey % 50 + l_suppkey % 3 AS s, l_partkey % 50 + l_suppkey % 3 + 3 + l_linenumber AS e FROM w_line WHERE l_suppkey % 8 <> 0),
ov AS (SELECT q.doc_id, q.idx, q.label, arg_min({'l': g.label, 's': g.s, 'e': g.e}, g.idx) AS f, bool_or(g.label = q.label AND g.s = q.s AND g.e = q.e) AS ex, any_value(q.s) AS s, any_value(q.e) AS e FROM tq q JOIN tg g ON q.doc_id = g.doc_id AND q.s < g.e AND g.s < q.e GROUP BY 1, 2, 3),
oc AS (SELECT tq.doc_id, tq.idx, tq.label, CASE WHEN ex THEN 'TP' WHEN f IS NULL THEN 'OVR_GEN' WHEN f.s = tq.s AND f.e = tq.e THEN 'CLS_ERROR' WHEN f.l = tq.label THEN 'LOC_ERROR' ELSE 'CLS_LOC_ERROR' END AS outcome FROM tq LEFT JOIN ov USING (doc_id, idx)
  UNION ALL SELECT doc_id, idx, label, 'FN' FROM tg WHERE NOT EXISTS (SELECT 1 FROM tq WHERE tq.doc_id = tg.doc_id AND tq.label = tg.label AND tq.s = tg.s AND tq.e = tg.e))"""


def spans(spark, sf):
    li = views.line(spark, sf)
    g = li.selectExpr("l_orderkey AS doc_id", "l_linenumber AS idx", "l_returnflag AS label", "l_partkey % 50 AS start", "l_partkey % 50 + 3 + l_linenumber AS `end`")
    q = li.where("l_suppkey % 8 <> 0").selectExpr(
        "l_orderkey AS doc_id", "l_linenumber AS idx", "CASE WHEN l_partkey % 7 = 0 THEN 'A' ELSE l_returnflag END AS label",
        "l_partkey % 50 + l_suppkey % 3 AS start", "l_partkey % 50 + l_suppkey % 3 + 3 + l_linenumber AS `end`",
    )
    return g, q


@query("c11_span_overlap", "SELECT count(*) AS pairs, CAST(sum(least(q.e, g.e) - greatest(q.s, g.s)) AS BIGINT) AS characters FROM tq q JOIN tg g ON q.doc_id = g.doc_id AND q.s < g.e AND g.s < q.e", ctes=SPANS)
def c11(spark, sf):
    from sparkeval.operators.matching import overlapping

    def flat(d):
        return d.select("doc_id", "start", "end", F.struct(F.col("start").cast("double").alias("x1"), F.lit(0.0).alias("y1"), F.col("end").cast("double").alias("x2"), F.lit(1.0).alias("y2")).alias("geom"))

    g, q = spans(spark, sf)
    pairs = overlapping(flat(g), flat(q), ["doc_id"])
    return pairs.agg(F.count("*").alias("pairs"), F.sum(F.least("a.end", "b.end") - F.greatest("a.start", "b.start")).alias("characters"))


@query("d21_span_outcomes", "SELECT doc_id, idx, label, outcome FROM oc", ctes=SPANS)
def d21(spark, sf):
    return intervals.span_outcomes(*spans(spark, sf))


# -- text --------------------------------------------------------------------------
# SQL words as in the operators; word ids as characters make the built-in edit distance work on words.
PAIRS = r"""tw AS (SELECT conv_id, turn, ref, cand, list_filter(regexp_split_to_array(ref, '\s+'), lambda x: x <> '') AS r, list_filter(regexp_split_to_array(cand, '\s+'), lambda x: x <> '') AS c FROM w_txt),
dummy AS (SELECT 1 AS one)"""
# Edit distance row by row of the reference: each step is a running minimum over the candidate's words;
# a cell is edits * 2^32 - hits, so the least cell has the fewest edits and, among those, the most hits.
EDITS = (
    PAIRS
    + """,
rw AS (SELECT conv_id, turn, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM tw),
cw AS (SELECT conv_id, turn, unnest(c) AS w, generate_subscripts(c, 1) AS j FROM tw),
dp(i, conv_id, turn, j, v) AS (
  SELECT 0::BIGINT, conv_id, turn, j::BIGINT, j * 4294967296::BIGINT FROM (SELECT conv_id, turn, j FROM cw UNION ALL SELECT conv_id, turn, 0 FROM tw)
  UNION ALL
  SELECT i + 1, conv_id, turn, j, (min(least(v + 4294967296, coalesce(d + CASE WHEN rword = cword THEN -1 ELSE 4294967296 END, 9e18::BIGINT)) - j * 4294967296) OVER (PARTITION BY conv_id, turn ORDER BY j ROWS UNBOUNDED PRECEDING) + j * 4294967296)::BIGINT
  FROM (SELECT dp.i, dp.conv_id, dp.turn, dp.j, dp.v, lag(dp.v) OVER (PARTITION BY dp.conv_id, dp.turn ORDER BY dp.j) AS d, rw.w AS rword, cw.w AS cword
    FROM dp JOIN rw ON rw.conv_id = dp.conv_id AND rw.turn = dp.turn AND rw.i = dp.i + 1 LEFT JOIN cw ON cw.conv_id = dp.conv_id AND cw.turn = dp.turn AND cw.j = dp.j)),
te AS (SELECT tw.conv_id, tw.turn, len(r) AS n_ref, len(c) AS n_cand, ceil(v / 4294967296.0)::BIGINT AS cost, (ceil(v / 4294967296.0) * 4294967296 - v)::BIGINT AS hits FROM tw JOIN dp ON dp.conv_id = tw.conv_id AND dp.turn = tw.turn AND dp.i = len(r) AND dp.j = len(c)),
ed AS (SELECT *, n_ref + n_cand - 2 * hits - cost AS subs FROM te)"""
)


def pairs(spark, sf):
    return shared(spark, f"{sf}/txt", lambda: views.txt(spark, sf))


def alignments(spark, sf):
    return shared(spark, f"{sf}/edits", lambda: text.edit_counts(pairs(spark, sf), "ref", "cand"))


# The check's edit distance works on bytes, so the pair's characters are numbered into one-byte ones.
CER = """ch AS (SELECT *, list_distinct(string_split(ref || cand, '')) AS v FROM w_txt),
ce AS (SELECT conv_id, turn, ref, array_to_string(list_transform(string_split(ref, ''), lambda x: chr((32 + list_position(v, x))::INT)), '') AS r, array_to_string(list_transform(string_split(cand, ''), lambda x: chr((32 + list_position(v, x))::INT)), '') AS c FROM ch)"""


@query("i01_word_error_rate", "SELECT conv_id, turn, round(cost / n_ref, 6) AS wer FROM te", ctes=EDITS, recursive=True)
def i01(spark, sf):
    return text.error_rates(alignments(spark, sf)).select("conv_id", "turn", r6("wer").alias("wer"))


@query("i02_character_error_rate", "SELECT conv_id, turn, round(levenshtein(r, c) / length(ref), 6) AS cer FROM ce", ctes=CER)
def i02(spark, sf):
    return pairs(spark, sf).select("conv_id", "turn", r6(text.character_error_rate("ref", "cand")).alias("cer"))


@query("i03_match_error_and_information", """SELECT conv_id, turn, round(cost / (cost + hits), 6) AS mer, round(1 - (hits / n_ref) * (hits / n_cand), 6) AS wil, round((hits / n_ref) * (hits / n_cand), 6) AS wip FROM te""", ctes=EDITS, recursive=True)
def i03(spark, sf):
    e = text.error_rates(alignments(spark, sf))
    return e.select("conv_id", "turn", *[r6(c).alias(c) for c in ("mer", "wil", "wip")])


@query("i04_word_edit_counts", """SELECT turn, hits, substitutions, deletions, insertions, cost, n_ref, n_cand, round(cost / n_ref, 6) AS wer, round(cost / (cost + hits), 6) AS mer, round(1 - (hits / n_ref) * (hits / n_cand), 6) AS wil,
  round((hits / n_ref) * (hits / n_cand), 6) AS wip FROM (SELECT turn, sum(hits)::BIGINT AS hits, sum(subs)::BIGINT AS substitutions, sum(n_ref - hits - subs)::BIGINT AS deletions, sum(n_cand - hits - subs)::BIGINT AS insertions, sum(cost)::BIGINT AS cost,
  sum(n_ref)::BIGINT AS n_ref, sum(n_cand)::BIGINT AS n_cand FROM ed GROUP BY 1)""", ctes=EDITS, recursive=True)  # fmt: skip
def i04(spark, sf):
    """Word edits summed per turn number."""
    names = ["hits", "substitutions", "deletions", "insertions", "cost", "n_ref", "n_cand"]
    sums = alignments(spark, sf).groupBy("turn").agg(*[F.sum(c).alias(c) for c in names])
    return text.error_rates(sums).select("turn", *names, *[r6(c).alias(c) for c in ("wer", "mer", "wil", "wip")])


@query("i05_normalized_text", r"""SELECT conv_id, turn, array_to_string(list_filter(regexp_split_to_array(regexp_replace(lower(text), '[!-/:-@\[-`{-~]', '', 'g'), '\s+'), lambda x: x NOT IN ('', 'a', 'an', 'the')), ' ') AS normalized FROM conversations""")
def i05(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", text.normalized(F.col("text")).alias("normalized"))


def gram_sql(n, side):
    return f"SELECT conv_id, turn, {n} AS n, unnest(list_transform(range(1, greatest(len({side}) - {n} + 2, 1)), lambda i: array_to_string({side}[i:i + {n} - 1], ' '))) AS g FROM tw"


def overlap_sql(orders):
    g = lambda side: " UNION ALL ".join(gram_sql(n, side) for n in orders)
    sizes = " UNION ALL ".join(f"SELECT conv_id, turn, {n} AS n, greatest(len(r) - {n} + 1, 0) AS n_ref, greatest(len(c) - {n} + 1, 0) AS n_cand FROM tw" for n in orders)
    return f"""rg AS (SELECT conv_id, turn, n, g, count(*) AS k FROM ({g('r')}) GROUP BY ALL), cg AS (SELECT conv_id, turn, n, g, count(*) AS k FROM ({g('c')}) GROUP BY ALL),
hit AS (SELECT conv_id, turn, n, sum(least(rg.k, cg.k)) AS hits FROM rg JOIN cg USING (conv_id, turn, n, g) GROUP BY ALL), siz AS ({sizes}),
og AS (SELECT siz.*, coalesce(hits, 0) AS hits FROM siz LEFT JOIN hit USING (conv_id, turn, n))"""


@query("i06_rouge_n", """SELECT conv_id, turn, n, round(coalesce(hits / nullif(n_ref, 0), 0), 6) AS recall, round(coalesce(hits / nullif(n_cand, 0), 0), 6) AS precision, round(CASE WHEN hits > 0 THEN 2 * hits / (n_ref + n_cand) ELSE 0 END, 6) AS f1 FROM og""",
  ctes=PAIRS + ",\n" + overlap_sql([1, 2]))
def i06(spark, sf):
    o = text.rouge_n(text.ngram_overlap(pairs(spark, sf), ["conv_id", "turn"], "ref", "cand", [1, 2]))
    return o.select("conv_id", "turn", "n", *[r6(c).alias(c) for c in ("recall", "precision", "f1")])


@query("i06_rouge_multi_reference", """SELECT conv_id, round(sum(hits) / nullif(sum(n_ref), 0), 6) AS rouge_sum, round(max(coalesce(hits / nullif(n_ref, 0), 0)), 6) AS rouge_max FROM og GROUP BY 1""", ctes=PAIRS + ",\n" + overlap_sql([1]))
def i06b(spark, sf):
    """Recall over several references: summed matches over summed lengths, and the best single reference."""
    o = text.rouge_n(text.ngram_overlap(pairs(spark, sf), ["conv_id", "turn"], "ref", "cand", [1]))
    return o.groupBy("conv_id").agg(r6(F.try_divide(F.sum("hits"), F.sum("n_ref"))).alias("rouge_sum"), r6(F.max("recall")).alias("rouge_max"))


# Longest common subsequence row by row: each step is a running maximum over the candidate's words.
LCS = (
    PAIRS
    + """,
rw AS (SELECT conv_id, turn, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM tw),
cw AS (SELECT conv_id, turn, unnest(c) AS w, generate_subscripts(c, 1) AS j FROM tw),
dp(i, conv_id, turn, j, v) AS (
  SELECT 0::BIGINT, conv_id, turn, j::BIGINT, 0::BIGINT FROM (SELECT conv_id, turn, j FROM cw UNION ALL SELECT conv_id, turn, 0 FROM tw)
  UNION ALL
  SELECT i + 1, conv_id, turn, j, (max(greatest(v, coalesce(d + CASE WHEN rword = cword THEN 1 ELSE 0 END, 0))) OVER (PARTITION BY conv_id, turn ORDER BY j ROWS UNBOUNDED PRECEDING))::BIGINT
  FROM (SELECT dp.i, dp.conv_id, dp.turn, dp.j, dp.v, lag(dp.v) OVER (PARTITION BY dp.conv_id, dp.turn ORDER BY dp.j) AS d, rw.w AS rword, cw.w AS cword
    FROM dp JOIN rw ON rw.conv_id = dp.conv_id AND rw.turn = dp.turn AND rw.i = dp.i + 1 LEFT JOIN cw ON cw.conv_id = dp.conv_id AND cw.turn = dp.turn AND cw.j = dp.j))"""
)


@query("i06_rouge_l", "SELECT tw.conv_id, tw.turn, round(2 * v / (len(r) + len(c)), 6) AS rouge_l FROM tw JOIN dp ON dp.conv_id = tw.conv_id AND dp.turn = tw.turn AND dp.i = len(r) AND dp.j = len(c)", ctes=LCS, recursive=True)
def i06c(spark, sf):
    """F-measure of the longest common subsequence."""
    return text.rouge_l(pairs(spark, sf), "ref", "cand").select("conv_id", "turn", r6("rouge_l").alias("rouge_l"))


@query("i07_bleu", """SELECT conv_id, turn, round(CASE WHEN min(hits) > 0 THEN exp(avg(ln(CASE WHEN hits > 0 THEN hits / n_cand END))) * CASE WHEN max(n_cand) FILTER (WHERE n = 1) >= max(n_ref) FILTER (WHERE n = 1) THEN 1
  ELSE exp(1 - max(n_ref) FILTER (WHERE n = 1) / max(n_cand) FILTER (WHERE n = 1)) END ELSE 0 END, 6) AS bleu FROM og GROUP BY 1, 2""", ctes=PAIRS + ",\n" + overlap_sql([1, 2, 3, 4]))  # fmt: skip
def i07(spark, sf):
    return text.bleu(pairs(spark, sf), ["conv_id", "turn"], "ref", "cand").withColumn("bleu", r6("bleu"))


MET = """rp AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, w ORDER BY i) AS occ FROM (SELECT conv_id, turn, unnest(r) AS w, generate_subscripts(r, 1) AS i FROM tw)),
cp AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, w ORDER BY j) AS occ FROM (SELECT conv_id, turn, unnest(c) AS w, generate_subscripts(c, 1) AS j FROM tw)),
al AS (SELECT conv_id, turn, i, j, lag(i) OVER o AS pi, lag(j) OVER o AS pj FROM rp JOIN cp USING (conv_id, turn, w, occ) WINDOW o AS (PARTITION BY conv_id, turn ORDER BY j)),
mt AS (SELECT conv_id, turn, count(*) AS m, count(*) FILTER (WHERE pi IS NULL OR i - pi <> 1 OR j - pj <> 1) AS ch FROM al GROUP BY 1, 2)"""


@query("i08_meteor", """SELECT tw.conv_id, tw.turn, round(CASE WHEN m > 0 THEN 10 * (m / len(c)) * (m / len(r)) / (m / len(r) + 9 * (m / len(c))) * (1 - 0.5 * ch / m) ELSE 0 END, 6) AS meteor FROM tw LEFT JOIN mt USING (conv_id, turn)""", ctes=PAIRS + ",\n" + MET)
def i08(spark, sf):
    return text.meteor(pairs(spark, sf), ["conv_id", "turn"], "ref", "cand").withColumn("meteor", r6("meteor"))


@query("i09_summary_failures", "SELECT turn, count(*) FILTER (WHERE len(c) <= 3) AS failed, round(avg(len(c) / len(r)), 5) AS length_ratio FROM tw GROUP BY 1", ctes=PAIRS)
def i09(spark, sf):
    ref, cand = F.col("ref"), F.col("cand")
    share = F.size(text.words(cand)) / F.size(text.words(ref))
    return pairs(spark, sf).groupBy("turn").agg(F.count_if(text.summary_failed(ref, cand)).alias("failed"), F.round(F.avg(share), 5).alias("length_ratio"))


@query("i11_text_properties", r"""SELECT doc_id, length(text) AS characters, length(regexp_replace(text, '\s', '', 'g')) AS characters_no_space, len(w) AS words, len(regexp_extract_all(text, '[.!?]+')) AS sentences,
  len(regexp_extract_all(text, '[^\x00-\x7F]')) AS non_ascii, round(coalesce(len(list_distinct(w)) / nullif(len(w), 0), 0), 6) AS vocabulary_level FROM (SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents)""")  # fmt: skip
def i11(spark, sf):
    p = table(spark, sf, "documents").select("doc_id", *text.text_properties(F.col("text")))
    return p.withColumn("vocabulary_level", r6("vocabulary_level"))


@query("i12_binary_label", "SELECT doc_id, CASE WHEN score >= 0.5 THEN 'good' ELSE 'bad' END AS label, round(CASE WHEN score >= 0.5 THEN score ELSE 1 - score END, 6) AS confidence FROM w_bin")
def i12(spark, sf):
    label, confidence = text.binary_label(F.col("score"), 0.5, "good", "bad")
    return views.binary(spark, sf).select("doc_id", label.alias("label"), r6(confidence).alias("confidence"))


@query("i13_label_confidence", "SELECT l_returnflag AS label, round(sum(CASE l_returnflag WHEN 'A' THEN l_discount WHEN 'R' THEN l_tax ELSE 0 END), 3) AS score FROM lineitem GROUP BY 1")
def i13(spark, sf):
    scored = F.array(F.struct(F.lit("A").alias("label"), F.col("l_discount").alias("score")), F.struct(F.lit("R").alias("label"), F.col("l_tax").alias("score")))
    df = table(spark, sf, "lineitem").select("l_returnflag", scored.alias("scored"))
    return df.groupBy(F.col("l_returnflag").alias("label")).agg(F.round(F.sum(text.label_confidence("scored", F.col("l_returnflag"))), 3).alias("score"))


@query("i14_url_normalisation", r"SELECT page_id, regexp_replace(url, '[?#].*$', '') AS bare, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages")
def i14(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("page_id", text.normalized_url(url).alias("bare"), text.query_parameter(url, "page").alias("page"), text.query_parameter(url, "ref").alias("ref"))


@query("i15_custom_score", "SELECT stratum, count(*) FILTER (WHERE round((score + (doc_id % 100) / 100.0) / 2, 3) >= 0.5) AS correct, count(*) AS n FROM w_bin GROUP BY 1")
def i15(spark, sf):
    ok = text.qa_correct(F.col("score"), (F.col("doc_id") % 100) / 100, 0.5)
    return views.binary(spark, sf).groupBy("stratum").agg(F.count_if(ok).alias("correct"), F.count("*").alias("n"))


@query("e39_question_suite", """SELECT count(DISTINCT conv_id) AS n_stories, count(*) AS n_questions, count(*) FILTER (WHERE round((length(text) % 100 / 100.0 + turn % 7 / 7.0) / 2, 3) >= 0.5) AS n_correct,
  round(count(*) FILTER (WHERE round((length(text) % 100 / 100.0 + turn % 7 / 7.0) / 2, 3) >= 0.5) / count(*), 3) AS overall_accuracy FROM conversations""")  # fmt: skip
def e39_questions(spark, sf):
    """A question-answering suite whose stories lie in several test cases: each counts once."""
    c = table(spark, sf, "conversations").withColumn("correct", text.qa_correct(F.length("text") % 100 / 100, F.col("turn") % 7 / 7, 0.5))
    return text.question_suite(c.select(F.col("role").alias("test_case"), F.col("conv_id").alias("story"), "correct"))


@query("e46_consistency_score", """SELECT user_id, round(count(b.event_id) FILTER (WHERE a.event_type = b.event_type) / nullif(count(b.event_id), 0), 6) AS consistency, any_value(h) AS hallucination
  FROM (SELECT user_id AS u, event_id, event_type FROM events) a JOIN (SELECT user_id, round(avg((value > 50)::INT), 6) AS h FROM events GROUP BY 1) g ON g.user_id = a.u LEFT JOIN (SELECT user_id AS v, event_id, event_type FROM events) b ON a.u = b.v AND a.event_id < b.event_id GROUP BY 1""")  # fmt: skip
def e46(spark, sf):
    """Share of all pairs of a user's answers that agree, from counts per answer; and the mean of 0/1 judgements."""
    same = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("c"), F.count_if(F.col("value") > 50).alias("made_up"))
    n, pairs = F.sum("c"), F.sum(F.col("c") * (F.col("c") - 1))
    return same.groupBy("user_id").agg(r6(F.try_divide(pairs, n * (n - 1))).alias("consistency"), r6(F.sum("made_up") / n).alias("hallucination"))
