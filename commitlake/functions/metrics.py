"""Rates and percentages rounded the same way in every engine.

Inputs are non-negative, so half-up rounding is ``floor(x*100 + 0.5) / 100``;
this avoids engine differences in rounding a binary double at decimal ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _round2(x: Column) -> Column:
    return F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)


def rate(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded to 2 places, NULL when the denominator is 0 or NULL."""
    return _round2(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def pct(numerator: Column, denominator: Column) -> Column:
    """100 * numerator / denominator rounded to 2 places, NULL on a zero denominator."""
    return _round2(F.lit(100.0) * F.try_divide(numerator.cast("double"), denominator.cast("double")))


def greatest_strict(x: Column, floor_value) -> Column:
    """``GREATEST`` that stays NULL when ``x`` is NULL (Spark's skips NULLs)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(floor_value)))
