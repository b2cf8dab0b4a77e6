"""Rates and means rounded exactly to two places.

Dividing decimals first and rounding afterwards rounds twice, and rounding a
double misses exact halves. Both are avoided by counting hundredths with whole
numbers: ``(200 s + n) div 2 n`` is ``s / n`` in hundredths, halves away from
zero. The whole numbers are 38 digits wide, so products of large counts fit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE_INT = "decimal(38,0)"


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    """``round(numerator / denominator, 2)`` as double; NULL when the denominator is 0."""
    n = denominator.cast(WIDE_INT)
    s = numerator.cast(WIDE_INT)
    hundredths = F.call_function("div", F.abs(s) * F.lit(200) + n, n * F.lit(2))
    signed = F.when(s < 0, -hundredths).otherwise(hundredths)
    return F.when(n > 0, signed.cast("double") / F.lit(100.0))


def percent_2dp(part: Column, whole: Column) -> Column:
    """``round(part / whole * 100, 2)`` as double; NULL when the whole is 0."""
    return ratio_2dp(part.cast(WIDE_INT) * F.lit(100), whole)
