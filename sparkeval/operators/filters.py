"""Field, result and comparison filters as column predicates; derived fields and custom expressions."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Range:
    """Closed number range; an infinite bound is open, ``modulo`` keeps multiples."""

    min: float = -math.inf
    max: float = math.inf
    modulo: int | None = None

    def __post_init__(self):
        if math.isnan(self.min) or math.isnan(self.max):
            raise ValueError("nan is not a bound")
        if self.min > self.max:
            raise ValueError("min is above max")


@dataclass(frozen=True)
class FieldFilter:
    """Exactly one operation on a field, optionally by regular expression or inverted."""

    value_in: Sequence[str | bool] | None = None
    number_range: Range | None = None
    contains: str | None = None
    null_value: bool | None = None
    array_contains: Sequence | None = None
    regex_match: bool = False
    regex_flags: str = ""
    inverse: bool = False

    def __post_init__(self):
        given = [self.value_in, self.number_range, self.contains, self.null_value, self.array_contains]
        if sum(x is not None for x in given) != 1:
            raise ValueError("give exactly one operation")

    def predicate(self, column: Column) -> Column:
        if self.value_in is not None:
            p = column.isin(list(self.value_in))
        elif self.number_range is not None:
            r = self.number_range
            p = column.isNotNull()
            if not math.isinf(r.min):
                p = p & (column >= r.min)
            if not math.isinf(r.max):
                p = p & (column <= r.max)
            if r.modulo:
                p = p & (column % r.modulo == 0)
        elif self.contains is not None:
            flags = f"(?{self.regex_flags})" if self.regex_flags else ""
            p = column.rlike(flags + self.contains) if self.regex_match else column.contains(self.contains)
        elif self.null_value is not None:
            p = column.isNull()
        else:
            p = F.arrays_overlap(column, F.array(*[F.lit(v) for v in self.array_contains]))
        return ~F.coalesce(p, F.lit(False)) if self.inverse else p


def all_of(filters: dict[str, FieldFilter]) -> Column:
    return reduce(lambda a, b: a & b, [f.predicate(F.col(c)) for c, f in filters.items()], F.lit(True))


def by_fields(df: DataFrame, filters: dict[str, FieldFilter], ids: Sequence | DataFrame | None = None, id_column: str = "id") -> DataFrame:
    """Conjunction of field filters and, if given, an id list (or a table of ids)."""
    df = df.where(all_of(filters))
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        return df.join(ids.select(id_column), id_column, "left_semi")
    if len(set(ids)) != len(ids):
        raise ValueError("duplicate datapoint ids")
    return df.where(F.col(id_column).isin(list(ids)))


@dataclass(frozen=True)
class ResultFilter:
    """Filter on one model's result; ``untested`` keeps datapoints without one."""

    model: str
    eval_config: str | None = None
    fields: dict[str, FieldFilter] | None = None
    untested: bool = False

    def __post_init__(self):
        if self.fields and self.untested:
            raise ValueError("a result cannot be filtered by value and be absent")


def with_result(points: DataFrame, results: DataFrame, model: str, eval_config: str | None, name: str, ids: Sequence[str] = ("id",)) -> DataFrame:
    """Datapoints with one run's result as struct ``name`` (null where untested)."""
    run = results.where((F.col("model") == model) & F.col("eval_config").eqNullSafe(F.lit(eval_config)))
    fields = [c for c in results.columns if c not in ("model", "eval_config", *ids)]
    return points.join(run.select(*ids, F.struct(*fields).alias(name)), list(ids), "left")


def by_results(points: DataFrame, results: DataFrame, filters: Sequence[ResultFilter], ids: Sequence[str] = ("id",)) -> DataFrame:
    runs = [(f.model, f.eval_config) for f in filters]
    if len(set(runs)) != len(runs):
        raise ValueError("duplicate model and evaluation configuration")
    for i, f in enumerate(filters):
        name = f"_r{i}"
        points = with_result(points, results, f.model, f.eval_config, name, ids)
        if f.untested:
            points = points.where(F.col(name).isNull())
        elif f.fields:
            points = points.where(reduce(lambda a, b: a & b, [x.predicate(F.col(f"{name}.{c}")) for c, x in f.fields.items()]))
        points = points.drop(name)
    return points


def compared(left: Column, operator: str, right: Column, difference: Range | None = None) -> Column:
    """Relation of two fields: equal, not_equal, greater_than, smaller_than, difference_range."""
    if operator == "difference_range":
        return FieldFilter(number_range=difference or Range()).predicate(left - right)
    return {"equal": left == right, "not_equal": left != right, "greater_than": left > right, "smaller_than": left < right}[operator]


def scope(df: DataFrame, fields: Sequence[str] | None) -> DataFrame:
    """None keeps every field, an empty list none."""
    return df if fields is None else df.select(*fields)


_NAME = re.compile(r"^[A-Za-z0-9_]+$")  # fixed pattern of a derived field's name


def spark_expression(formula: str) -> str:
    """The formula's few own spellings in Spark SQL; Spark does the parsing."""
    operand = r"(@?[\w.]+(?:\([^()]*\))?|\([^()]*\))"
    power = re.compile(operand + r"\s*\^\s*" + operand)
    while power.search(formula):
        formula = power.sub(r"pow(\1, \2)", formula, count=1)
    return re.sub(r"@(?=\w)", "", formula).replace("==", "=").replace("array_size(", "size(")


def derived(df: DataFrame, name: str, formula: str) -> DataFrame:
    """Add a field computed from ``@datapoint.x`` and ``@result.y`` (struct columns of ``df``)."""
    if not _NAME.match(name):
        raise ValueError(f"bad derived field name {name!r}")
    return df.withColumn(name, F.expr(spark_expression(formula)))


def custom_filter(df: DataFrame, expression: str) -> DataFrame:
    return df.where(F.expr(spark_expression(expression)))


def custom_sort(df: DataFrame, expression: str, descending: bool = False, *then: str) -> DataFrame:
    key = F.expr(spark_expression(expression))
    return df.orderBy(key.desc() if descending else key.asc(), *then)


def page(df: DataFrame, key: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """One page of an ordered table."""
    return df.orderBy(*key).offset(offset).limit(limit)
