"""Exact decimal ratios: no floating point before the final rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded half away from zero; NULL when the denominator is 0."""
    # 24 + 2 integer digits leave the quotient 12 decimal places, far past any rounding here.
    top = numerator.cast("decimal(34,10)")
    bottom = F.nullif(denominator.cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
    return F.round(top / bottom, digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    return ratio(part.cast("decimal(34,6)") * F.lit(100), whole, digits)


def mean(total: Column, rows: Column, digits: int) -> Column:
    """Average from a sum and a count, so partial sums can be combined first."""
    return ratio(total, rows, digits)
