"""User-defined evaluation: evaluators over DataFrames, inference functions and aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkeval.operators import classification, curves, detection
from sparkeval.operators.joins import per_case
from sparkeval.session import materialize


class Evaluator:
    """Override the steps; each takes and returns DataFrames. Configurations are plain values."""

    configurations: Sequence = (None,)

    def sample_metrics(self, samples: DataFrame, configuration) -> DataFrame:
        raise NotImplementedError

    def case_metrics(self, metrics: DataFrame, configuration) -> DataFrame:
        """``metrics`` holds one row per (test case, sample)."""
        raise NotImplementedError

    def case_plots(self, metrics: DataFrame, configuration) -> DataFrame | None:
        return None

    def suite_metrics(self, cases: DataFrame, configuration) -> DataFrame | None:
        return None

    def run(self, samples: DataFrame, membership: DataFrame, ids: Sequence[str]) -> dict:
        """Evaluate every configuration; sample metrics are computed once and shared by all test cases."""
        out = {}
        for c in self.configurations:
            metrics = materialize(self.sample_metrics(samples, c), "sample-metrics")
            placed = per_case(metrics, membership, ids)
            cases = materialize(self.case_metrics(placed, c), "case-metrics")
            out[c] = {"samples": metrics, "cases": cases, "plots": self.case_plots(placed, c), "suite": self.suite_metrics(cases, c)}
        return out


def evaluate_with(fn: Callable[[DataFrame], DataFrame], samples: DataFrame, membership: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Function form: sample metrics once, then one row per (test case, sample)."""
    return per_case(materialize(fn(samples), "sample-metrics"), membership, ids)


def infer(samples: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Run a model function over batches of samples."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield fn(pdf)

    return samples.mapInPandas(batches, schema)


def grouped_aggregate(df: DataFrame, by: Sequence[str], partial: Callable[[pd.DataFrame], dict], merge: Callable[[pd.DataFrame], dict], partial_schema: str, schema: str) -> DataFrame:
    """User aggregate in two steps: ``partial`` per group and batch, ``merge`` over a group's partial rows.

    A group is never shipped whole: only its partial rows meet.
    """
    by = list(by)

    def first(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [dict(zip(by, k), **partial(g)) for k, g in pdf.groupby(by, dropna=False)]
            if rows:
                yield pd.DataFrame(rows)

    def second(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([dict(zip(by, key), **merge(pdf))])

    return df.mapInPandas(first, partial_schema).groupBy(*by).applyInPandas(second, schema)


def expand(samples: DataFrame, fn: Callable[[dict], Iterable[dict]], schema) -> DataFrame:
    """User table function: every sample yields any number of rows."""

    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = [r for rec in pdf.to_dict("records") for r in fn(rec)]
            if rows:
                yield pd.DataFrame(rows)

    return samples.mapInPandas(batches, schema)


_SCALARS = (T.StringType, T.NumericType, T.BooleanType, T.TimestampType)


def check_type(schema: T.StructType, required: Sequence[str] = ()) -> None:
    """A workflow type holds scalars, annotations (structs) and arrays of them; maps are rejected."""

    def ok(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return ok(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(ok(f.dataType) for f in kind.fields)
        return isinstance(kind, _SCALARS)

    bad = [f.name for f in schema.fields if not ok(f.dataType)]
    missing = [r for r in required if r not in schema.names]
    if bad or missing:
        raise ValueError(f"unsupported fields {bad}, missing fields {missing}")


class DetectionEvaluator:
    """Ready-made detection evaluation, single or multiclass, on boxes or polygons."""

    def __init__(self, iou_threshold: float = 0.5, min_confidence: float = 0.0, threshold: str | float = detection.F1_OPTIMAL, multiclass: bool = True, **match_options):
        self.iou_threshold, self.min_confidence, self.threshold = iou_threshold, min_confidence, threshold
        self.multiclass, self.match_options = multiclass, match_options

    def run(self, gts: DataFrame, infs: DataFrame, cases: DataFrame) -> dict[str, DataFrame]:
        """``cases`` maps image_id to test_case; thresholds come from the distinct samples."""
        infs = detection.filter_inferences(infs, self.min_confidence)
        if self.multiclass:
            m = detection.match_multiclass(gts, infs, self.iou_threshold, **self.match_options)
        else:
            m = detection.match(gts, infs, self.iou_threshold, **self.match_options)
        m = materialize(m, "matches")
        labels = gts.select("label").union(infs.select("label")).distinct()
        if self.threshold != detection.F1_OPTIMAL:
            thresholds = labels.withColumn("threshold", F.lit(float(self.threshold)))
        elif self.multiclass:
            thresholds = curves.optimal_f1(curves.detection_counts(m), ["label"])
        else:
            best = curves.optimal_f1(curves.detection_counts(m, []), []).scalar()
            thresholds = labels.withColumn("threshold", F.greatest(best, F.lit(float(self.min_confidence))))
        thresholds = materialize(thresholds, "thresholds")
        placed = m.join(cases, "image_id")
        per_class = materialize(detection.class_metrics(placed, thresholds, fallback=self.min_confidence), "classes")
        by_case = detection.case_metrics(per_class)
        return {
            "samples": detection.image_metrics(m, thresholds, self.min_confidence), "classes": per_class, "cases": by_case,
            "suite": by_case.agg(F.avg("mean_ap").alias("mean_ap"), F.var_pop("macro_f1").alias("f1_variance")),
        }


class ClassificationEvaluator:
    """Ready-made multiclass evaluation of (test_case, gt, pred)."""

    def run(self, rows: DataFrame) -> dict[str, DataFrame]:
        cells = materialize(classification.confusion_counts(rows, ["test_case"]), "cells")
        counts = classification.class_counts(cells, ["test_case"])
        return {"classes": classification.class_rates(counts), "cases": classification.averaged(counts, ["test_case"], "macro"), "confusion": cells}
