"""Count-based metric formulas; a ratio is 0 unless its denominator is above 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(x) -> Column:
    return (x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)).cast("double")


def ratio(num, den) -> Column:
    """``num / den``, or 0 where ``den`` is null, NaN or not positive."""
    n, d = _d(num), _d(den)
    return F.when(~F.isnan(d) & (d > 0), F.try_divide(n, d)).otherwise(0.0)


def precision(tp, fp) -> Column:
    return ratio(tp, _d(tp) + _d(fp))


def recall(tp, fn) -> Column:
    return ratio(tp, _d(tp) + _d(fn))


def f_beta(tp, fp, fn, beta: float = 1.0) -> Column:
    p, r, b2 = precision(tp, fp), recall(tp, fn), beta * beta
    return ratio((1 + b2) * p * r, b2 * p + r)


def f1_score(tp, fp, fn) -> Column:
    return f_beta(tp, fp, fn, 1.0)


def accuracy(tp, fp, fn, tn) -> Column:
    return ratio(_d(tp) + _d(tn), _d(tp) + _d(fp) + _d(fn) + _d(tn))


def false_positive_rate(fp, tn) -> Column:
    return ratio(fp, _d(fp) + _d(tn))


def specificity(fp, tn) -> Column:
    return ratio(tn, _d(fp) + _d(tn))


def rounded(x, places: int) -> Column:
    """Rounded as SQL engines round doubles: the scaled double decides, not its shortest decimal form, so 0.035625 gives 0.03562."""
    scale = float(10**places)
    return F.round(_d(x) * F.lit(scale)) / F.lit(scale)


def r6(x) -> Column:
    """Rounded to six places for stable output."""
    return rounded(x, 6)
