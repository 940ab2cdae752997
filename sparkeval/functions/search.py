"""Position of a value among sorted cuts as one compiled expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cuts_below(value: str, cuts: Sequence[str | float], inclusive: bool = True) -> Column:
    """How many ascending cuts are at (or, exclusive, strictly) below ``value``, by halving.

    ``value`` and string cuts are SQL; a null value is below every cut.
    """
    texts = [c if isinstance(c, str) else f"double('{float(c)!r}')" for c in cuts]
    op = ">=" if inclusive else ">"

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {value} {op} {texts[mid]} THEN {tree(mid + 1, hi)} ELSE {tree(lo, mid)} END"

    return F.expr(tree(0, len(texts)))
