"""Quality standards: metric groups over stratifications, compared between models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE_PER_STDDEV = 4.0  # a metric's range over its estimated standard deviation
EPSILON = 2.220446049250313e-16


@dataclass(frozen=True)
class Metric:
    """An aggregate over result columns; direction None keeps it out of comparisons."""

    label: str
    value: Column
    higher_is_better: bool | None = None


@dataclass(frozen=True)
class MetricGroup:
    name: str
    metrics: Sequence[Metric]

    def __post_init__(self):
        labels = [m.label for m in self.metrics]
        if len(set(labels)) != len(labels):
            raise ValueError(f"metric labels repeat in group {self.name}")


@dataclass(frozen=True)
class Stratification:
    """Named test cases: the column's value is the test case, null included."""

    name: str
    column: Column


def check_standard(groups: Sequence[MetricGroup], stratifications: Sequence[Stratification]) -> None:
    for what, names in (("metric group", [g.name for g in groups]), ("stratification", [s.name for s in stratifications])):
        if len(set(names)) != len(names):
            raise ValueError(f"{what} names repeat")
    if not groups:
        raise ValueError("a standard needs a metric group")


def tested_by_all(results: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Results on the datapoints every (model, eval config) was tested on."""
    which = F.struct("model", F.coalesce("eval_config", F.lit("null")).alias("c"))
    runs = results.select(which.alias("run")).distinct().agg(F.count("*")).scalar()
    # Distinct runs are few, so the set per datapoint is bounded by them.
    common = results.groupBy(*ids).agg(F.count_distinct(which).alias("_n")).where(F.col("_n") == runs).select(*ids)
    return results.join(common, list(ids), "left_semi")


def evaluate(results: DataFrame, groups: Sequence[MetricGroup], stratifications: Sequence[Stratification]) -> DataFrame:
    """Long table (model, eval_config, stratification, test_case, n, metric_group, metric, value).

    All stratifications and the whole dataset come from one grouping-sets pass.
    """
    check_standard(groups, stratifications)
    tagged = results.select("*", *[s.column.cast("string").alias(f"_s{i}") for i, s in enumerate(stratifications)])
    run = [F.col("model"), F.col("eval_config")]
    strata = [F.col(f"_s{i}") for i in range(len(stratifications))]
    names = [(g.name, m) for g in groups for m in g.metrics]
    aggregates = [m.value.cast("double").alias(f"_m{i}") for i, (_, m) in enumerate(names)]
    sets = [run] + [[*run, s] for s in strata]
    table = tagged.groupingSets(sets, *run, *strata).agg(F.count("*").alias("n"), *aggregates, *[F.grouping(s).alias(f"_g{i}") for i, s in enumerate(strata)])
    which = F.lit("Dataset")
    case = F.lit("Dataset")
    for i, s in enumerate(stratifications):
        here = F.col(f"_g{i}") == 0
        which, case = F.when(here, s.name).otherwise(which), F.when(here, F.coalesce(F.col(f"_s{i}"), F.lit("null"))).otherwise(case)
    metrics = F.explode(F.array(*[
        F.struct(F.lit(g).alias("metric_group"), F.lit(m.label).alias("metric"), F.col(f"_m{i}").alias("value")) for i, (g, m) in enumerate(names)
    ]))
    return table.select("model", "eval_config", which.alias("stratification"), case.alias("test_case"), "n", metrics.alias("m")).select(
        "model", "eval_config", "stratification", "test_case", "n", "m.*"
    )


def pivoted(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per test case, one column per ``model.metric_group.metric`` given."""
    name = F.concat_ws(".", "model", "metric_group", "metric")
    rows = long.withColumn("column", name).groupBy("stratification", "test_case")
    return rows.pivot("column", list(columns)).agg(F.first("value"))


def z_score(confidence: float) -> float:
    if not 0 <= confidence < 1:
        raise ValueError("confidence must be in [0, 1)")
    return NormalDist().inv_cdf((1 + confidence) / 2)


def margin_of_error(n: Column, confidence: float = 0.95, p: float = 0.5) -> Column:
    """Percent margin of a share estimated from n samples; 0 without samples."""
    return F.when(n > 0, 100 * z_score(confidence) * sqrt(p * (1 - p)) / F.sqrt(n.cast("double"))).otherwise(0.0)


def delta_percentage(a: Column, b: Column, limit: Column) -> Column:
    """Difference in percent of the limit's next power of ten (of the limit itself from 1000 on)."""
    power = F.pow(F.lit(10.0), F.ceil(F.log10(limit)))
    upper = F.when(limit > 0, F.when(power >= 1000, limit).otherwise(power))
    return 100 * (a - b) / F.coalesce(upper, a + EPSILON)


def compare(long: DataFrame, groups: Sequence[MetricGroup], reference_model: str, reference_eval_config: str | None, confidence: float) -> DataFrame:
    """Add ``performance_delta``: improved / regressed / similar / unknown against the reference run."""
    on = ["stratification", "test_case", "metric_group", "metric"]
    ref = long.where((F.col("model") == reference_model) & F.col("eval_config").eqNullSafe(F.lit(reference_eval_config)))
    top = F.max("value").over(W.partitionBy("stratification", "metric_group", "metric"))
    ref = ref.select(*on, F.col("value").alias("_ref"), top.alias("_max"))
    sign = F.lit(None).cast("int")
    for g in groups:
        for m in g.metrics:
            if m.higher_is_better is not None:
                here = (F.col("metric_group") == g.name) & (F.col("metric") == m.label)
                sign = F.when(here, 1 if m.higher_is_better else -1).otherwise(sign)
    joined = long.join(ref, on, "left")
    limit = F.when((F.col("_max") != 0) & ~F.isnan("_max"), F.col("_max")).otherwise(F.greatest("value", "_ref"))
    delta = sign * delta_percentage(F.col("value"), F.col("_ref"), limit)
    margin = margin_of_error(F.col("n"), confidence)
    known = F.col("value").isNotNull() & F.col("_ref").isNotNull() & ~F.isnan("value") & ~F.isnan("_ref") & sign.isNotNull()
    verdict = F.when(~known, "unknown").when(delta > margin, "improved").when(delta < -margin, "regressed").otherwise("similar")
    return joined.select(*[c for c in long.columns], F.coalesce(verdict, F.lit("unknown")).alias("performance_delta"))


def difficulty(results: DataFrame, ids: Sequence[str], lower_better: Sequence[str], higher_better: Sequence[str], weights: dict[str, float] | None = None) -> DataFrame:
    """(ids, model, difficulty): weighted sum of min-max scaled metrics, larger where the model does worse."""
    metrics = [*lower_better, *higher_better]
    weights = weights or {m: 1 / len(metrics) for m in metrics}
    signed = results.select(*ids, "model", *[(-F.col(m) if m in higher_better else F.col(m)).cast("double").alias(m) for m in metrics])
    span = signed.groupBy("model").agg(*[f(m).alias(f"_{n}_{m}") for m in metrics for n, f in (("lo", F.min), ("hi", F.max))])
    scaled = signed.join(span, "model")
    total = sum(weights[m] * F.try_divide(F.col(m) - F.col(f"_lo_{m}"), F.col(f"_hi_{m}") - F.col(f"_lo_{m}")) for m in metrics)
    return scaled.select(*ids, "model", total.alias("difficulty"))


def leaderboard(long: DataFrame, groups: Sequence[MetricGroup]) -> DataFrame:
    """(model, score, rank): mean directed z-score over metrics on the whole dataset, spread estimated from the range."""
    parts = []
    for g in groups:
        for m in g.metrics:
            if m.higher_is_better is not None:
                parts.append(((F.col("metric_group") == g.name) & (F.col("metric") == m.label), 1 if m.higher_is_better else -1))
    sign = F.lit(None).cast("int")
    for cond, s in parts:
        sign = F.when(cond, s).otherwise(sign)
    rows = long.where("stratification = 'Dataset'").withColumn("_sign", sign).where("_sign IS NOT NULL")
    per = W.partitionBy("metric_group", "metric")
    spread = (F.max("value").over(per) - F.min("value").over(per)) / RANGE_PER_STDDEV
    z = F.coalesce(F.try_divide(F.col("value") - F.avg("value").over(per), spread), F.lit(0.0)) * F.col("_sign")
    scores = rows.withColumn("_z", z).groupBy("model").agg(F.avg("_z").alias("score"))
    return scores.withColumn("rank", F.rank().over(W.orderBy(F.col("score").desc())))
