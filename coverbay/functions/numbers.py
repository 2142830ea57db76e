"""Numeric expressions with the rounding and null behaviour the tables need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clip(value: Column, low, high) -> Column:
    """Bound a value; NULL stays NULL (``least`` and ``greatest`` would skip it)."""
    bounded = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), bounded)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient of two exact sums, NULL unless the denominator is positive."""
    positive = F.when(denominator > 0, denominator.cast("double"))
    return numerator.cast("double") / positive


def money_round(value: Column) -> Column:
    """Two places, half to even."""
    return F.bround(value, 2).cast("decimal(18,2)")
