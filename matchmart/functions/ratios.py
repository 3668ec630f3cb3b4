"""Exact two-decimal ratios.

Integer arithmetic keeps the result independent of any engine's decimal
division: hundredths are computed half-up as a whole number first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hundredths(numerator: Column, denominator: Column, scale: int) -> Column:
    den = F.nullif(denominator.cast("long"), F.lit(0).cast("long"))
    num = numerator.cast("long")
    half_up = F.call_function("div", F.abs(num) * F.lit(2 * scale) + den, den * F.lit(2))
    return (F.signum(num) * half_up).cast("double") / F.lit(100.0)


def average(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, two decimals half-up, NULL for a zero denominator."""
    return _hundredths(numerator, denominator, 100)


def percentage(numerator: Column, denominator: Column) -> Column:
    """100 * numerator / denominator, two decimals half-up, NULL for a zero denominator."""
    return _hundredths(numerator, denominator, 10_000)
