"""Regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkeval.operators.running import average_ranks


def errors(df: DataFrame, gt: str = "gt", pred: str = "pred") -> DataFrame:
    """Error columns; a null or negative prediction counts as a failure to detect."""
    failed = F.col(pred).isNull() | (F.col(pred) < 0)
    err = F.when(~failed, F.col(pred) - F.col(gt))
    return df.select("*", failed.alias("failed"), err.alias("error"), F.abs(err).alias("abs_error"), (err * err).alias("squared_error"))


def regression_metrics(df: DataFrame, by: Sequence[str] = (), gt: str = "gt", pred: str = "pred") -> DataFrame:
    """MAE, MSE, RMSE, R squared and Pearson correlation in one pass."""
    d = F.col(pred) - F.col(gt)
    sst = F.var_pop(gt) * F.count(gt)
    return df.where(F.col(gt).isNotNull() & F.col(pred).isNotNull()).groupBy(*by).agg(
        F.avg(F.abs(d)).alias("mae"), F.avg(d * d).alias("mse"), F.sqrt(F.avg(d * d)).alias("rmse"),
        (1 - F.try_divide(F.sum(d * d), sst)).alias("r_squared"), F.corr(pred, gt).alias("pearson"),
    )


def spearman(df: DataFrame, by: Sequence[str] = (), gt: str = "gt", pred: str = "pred") -> DataFrame:
    """Correlation of average ranks; equal value pairs are counted once with their weight."""
    by = list(by)
    cells = df.groupBy(*by, gt, pred).agg(F.count("*").alias("_n"))
    ranked = cells.join(average_ranks(df, by, gt, "_rg"), [*by, gt]).join(average_ranks(df, by, pred, "_rp"), [*by, pred])
    n, x, y = F.col("_n"), F.col("_rg"), F.col("_rp")
    s = ranked.groupBy(*by).agg(
        F.sum(n).alias("n"), F.sum(n * x).alias("x"), F.sum(n * y).alias("y"), F.sum(n * x * y).alias("xy"),
        F.sum(n * x * x).alias("xx"), F.sum(n * y * y).alias("yy"),
    )
    cov = F.expr("xy - x * y / n")
    return s.select(*by, F.try_divide(cov, F.sqrt(F.expr("xx - x * x / n")) * F.sqrt(F.expr("yy - y * y / n"))).alias("spearman"))
