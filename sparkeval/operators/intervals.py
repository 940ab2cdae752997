"""Time segments and text spans: coverage, merging, subtraction, co-occurrence and speaker mapping.

All of them come from one sweep over the segments' ends (see sweep). Nothing pairs segments with
segments, so a recording with very many overlapping ones costs one event per end.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.functions.types import struct_of
from sparkeval.operators.matching import overlapping
from sparkeval.operators.sweep import Sweep

MIN_ERROR = 0.2  # shortest identification error in seconds


def _either(n_ref: np.ndarray, n_hyp: np.ndarray) -> np.ndarray:
    return n_ref + n_hyp > 0


def _only_ref(n_ref: np.ndarray, n_hyp: np.ndarray) -> np.ndarray:
    return (n_ref > 0) & (n_hyp == 0)


def _only_hyp(n_ref: np.ndarray, n_hyp: np.ndarray) -> np.ndarray:
    return (n_hyp > 0) & (n_ref == 0)


def merged(segments: DataFrame, by: Sequence[str]) -> DataFrame:
    """Union of overlapping or touching segments per group."""
    return Sweep(segments, None, by).runs(open=_either).drop("condition")


def missed(ref: DataFrame, hyp: DataFrame, by: Sequence[str], min_length: float = 0.0) -> DataFrame:
    """Parts of ``ref`` that ``hyp`` does not cover, at least ``min_length`` long."""
    gaps = Sweep(ref, hyp, by).runs(missed=_only_ref).drop("condition")
    return gaps.where(F.col("e") - F.col("s") >= min_length)


def identification_errors(ref: DataFrame, hyp: DataFrame, recording: str, speaker: str) -> DataFrame:
    """Merged intervals per recording where some reference speaker's speech differs between the sides."""
    by = [recording, speaker]
    known = hyp.join(ref.select(*by).distinct(), by, "left_semi")
    errors = Sweep(ref, known, by).runs(missed=_only_ref, added=_only_hyp).where(F.col("e") - F.col("s") >= MIN_ERROR)
    return merged(errors.drop(speaker), [recording])


def co_occurrence(ref: DataFrame, hyp: DataFrame, recording: str, speaker: str) -> DataFrame:
    """(recording, ref_speaker, hyp_speaker, seconds): summed overlap of all segment pairs.

    At any time the overlapping pairs number (open on one side) x (open on the other), so the sum is an integral over the
    sweep's times.
    """
    pairs = Sweep(ref, hyp, [recording], speaker).totals().where("kind = 'pairs'")
    return pairs.select(recording, F.col("ref").alias("ref_speaker"), F.col("hyp").alias("hyp_speaker"), F.col("x").alias("seconds"))


def best_assignment(weight: np.ndarray) -> list[tuple[int, int]]:
    """Row to column assignment of greatest total weight by shortest augmenting paths; of equal paths the first column wins."""
    rows, cols = weight.shape
    if rows > cols:
        return [(i, j) for j, i in best_assignment(weight.T)]
    cost = -weight
    u, v, owner = np.zeros(rows + 1), np.zeros(cols + 1), np.full(cols + 1, -1)
    for i in range(rows):
        owner[cols], j = i, cols
        dist, back, done = np.full(cols, np.inf), np.full(cols, cols), np.zeros(cols + 1, bool)
        while True:
            done[j] = True
            free = ~done[:cols]
            reach = cost[owner[j]] - u[owner[j]] - v[:cols]
            closer = free & (reach < dist)
            dist[closer], back[closer] = reach[closer], j
            nxt = int(np.where(free, dist, np.inf).argmin())
            delta = dist[nxt]
            u[owner[done]] += delta
            v[done] -= delta
            dist[free] -= delta
            j = nxt
            if owner[j] < 0:
                break
        while j != cols:
            owner[j] = owner[back[j]]
            j = int(back[j])
    return sorted((int(owner[j]), j) for j in range(cols) if owner[j] >= 0)


_MAPPED = T.ArrayType(T.StructType([T.StructField("ref_speaker", T.StringType()), T.StructField("hyp_speaker", T.StringType()), T.StructField("seconds", T.DoubleType())]))


@F.pandas_udf(_MAPPED)
def _assign(cells: pd.Series) -> pd.Series:
    out = []
    for c in cells:
        refs, hyps = sorted({x["ref_speaker"] for x in c}), sorted({x["hyp_speaker"] for x in c})
        m = np.zeros((len(refs), len(hyps)))
        for x in c:
            m[refs.index(x["ref_speaker"]), hyps.index(x["hyp_speaker"])] = x["seconds"]
        out.append([{"ref_speaker": refs[i], "hyp_speaker": hyps[j], "seconds": float(m[i, j])} for i, j in best_assignment(m)])
    return pd.Series(out)


def speaker_mapping(seconds: DataFrame, recording: str) -> DataFrame:
    """(recording, ref_speaker, hyp_speaker, seconds): one-to-one mapping of greatest total overlap."""
    cells = seconds.groupBy(recording).agg(F.collect_list(F.struct("ref_speaker", "hyp_speaker", "seconds")).alias("c"))
    return cells.select(recording, F.explode(_assign("c")).alias("m")).select(recording, "m.*").where("seconds > 0")


_RATES = (
    "diarization_error_rate", "jaccard_error_rate", "purity", "coverage", "detection_accuracy", "detection_precision", "detection_recall",
    "identification_error_rate", "identification_precision", "identification_recall",
)


def _rates(totals: dict[tuple, float]) -> dict[str, float]:
    """Error rates of one recording from its total durations by (kind, ref, hyp)."""
    g = {kind: x for (kind, r, h), x in totals.items() if r is None and h is None}
    rs = {r: x for (kind, r, h), x in totals.items() if kind == "length" and r is not None}
    hs = {h: x for (kind, r, h), x in totals.items() if kind == "length" and h is not None}
    both = {(r, h): x for (kind, r, h), x in totals.items() if kind == "both"}
    # As in speaker_mapping, the speakers are those with shared time, in order of name.
    refs, hyps = sorted({r for r, _ in both}), sorted({h for _, h in both})
    weight = np.array([[both.get((r, h), 0.0) for h in hyps] for r in refs]).reshape(len(refs), len(hyps))
    chosen = {refs[i]: hyps[j] for i, j in best_assignment(weight) if weight[i, j] > 0} if refs else {}
    correct = sum(both[r, h] for r, h in chosen.items())
    identified = sum(x for (r, h), x in both.items() if r == h)
    best = lambda side: sum(max(x for key, x in both.items() if key[side] == name) for name in {key[side] for key in both})
    jaccard = []
    for r, length in rs.items():
        seconds = both.get((r, chosen.get(r)), 0.0)
        jaccard.append(1 - seconds / (length + (hs.get(chosen.get(r), 0.0)) - seconds))
    per = lambda a, b: a / b if b else 0.0
    tp, fp, fn, tn = (g.get(f"speech_{k}", 0.0) for k in ("tp", "fp", "fn", "tn"))
    wrong = g.get("false_alarm", 0.0) + g.get("miss", 0.0) + g.get("shared", 0.0)
    ref_s, hyp_s = g.get("ref_s", 0.0), g.get("hyp_s", 0.0)
    values = (
        per(wrong - correct, ref_s), sum(jaccard) / len(jaccard) if jaccard else None, per(best(1), hyp_s), per(best(0), ref_s),
        per(tp + tn, tp + fp + fn + tn), per(tp, tp + fp), per(tp, tp + fn), per(wrong - identified, ref_s), per(identified, hyp_s), per(identified, ref_s),
    )
    return dict(zip(_RATES, values))


@F.pandas_udf(struct_of(**dict.fromkeys(_RATES, "double")))
def _all_rates(totals: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_rates({(x["kind"], x["ref"], x["hyp"]): x["x"] for x in rows}) for rows in totals], columns=list(_RATES))


def diarization_metrics(ref: DataFrame, hyp: DataFrame, recording: str, speaker: str) -> DataFrame:
    """Error rates per recording from durations: diarization, identification, detection, purity, coverage, Jaccard.

    All durations come from one sweep; a recording's totals, one for each pair of its speakers, then meet in one row.
    """
    totals = Sweep(ref, hyp, [recording], speaker).totals().where("kind <> 'pairs'")
    rows = totals.groupBy(recording).agg(F.collect_list(F.struct("kind", "ref", "hyp", "x")).alias("totals"))
    return rows.select(recording, _all_rates("totals").alias("m")).select(recording, "m.*")


def span_outcomes(gts: DataFrame, preds: DataFrame, tags: Sequence[str] | None = None) -> DataFrame:
    """Named-entity outcomes: one row per prediction plus one per missed ground truth.

    Inputs: (doc_id, idx, label, start, end). The first overlapping ground truth in order decides an
    inexact prediction. Equal spans are collapsed before they meet, and spans meet only in shared tiles.
    """
    if tags is not None:
        gts, preds = (d.where(F.col("label").isin(list(tags))) for d in (gts, preds))
    span = lambda d: d.select("*", F.struct(F.col("start").cast("double").alias("x1"), F.lit(0.0).alias("y1"), F.col("end").cast("double").alias("x2"), F.lit(1.0).alias("y2")).alias("geom"))
    exact = ["doc_id", "label", "start", "end"]
    g = gts.groupBy(*exact).agg(F.min("idx").alias("idx"))
    p = preds.select(*exact).distinct()
    hits = overlapping(span(g), span(p), ["doc_id"])
    cols = [F.col(f"b.{c}").alias(c) for c in exact[1:]]
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.start") == F.col("b.start")) & (F.col("a.end") == F.col("b.end"))
    first = hits.groupBy("doc_id", *cols).agg(F.bool_or(same).alias("exact"), F.min(F.struct("a.idx", "a.label", "a.start", "a.end")).alias("f"))
    rows = preds.join(first, exact, "left")
    aligned = (F.col("f.start") == F.col("start")) & (F.col("f.end") == F.col("end"))
    outcome = (
        F.when(F.col("exact"), "TP").when(F.col("f").isNull(), "OVR_GEN").when(aligned, "CLS_ERROR")
        .when(F.col("f.label") == F.col("label"), "LOC_ERROR").otherwise("CLS_LOC_ERROR")
    )
    out = rows.select("doc_id", "idx", "label", outcome.alias("outcome"))
    fn = gts.join(p, exact, "left_anti").select("doc_id", "idx", "label", F.lit("FN").alias("outcome"))
    return out.unionByName(fn)
