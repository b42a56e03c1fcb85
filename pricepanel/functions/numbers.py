"""Number expressions with NULL-safe edges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_number(value: Column) -> Column:
    """Double, with text that is no number, NaN and infinities turned to NULL."""
    x = value.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def divide(a: Column, b: Column) -> Column:
    """``a / b``, NULL when ``b`` is zero or either is NULL."""
    return F.try_divide(a, b)


def at_least(value: Column, floor: float) -> Column:
    """The larger of both, but NULL for NULL (``greatest`` alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(float(floor))))


def direction(value: Column, base: Column) -> Column:
    """1, 0 or -1 as ``value`` is above, at or below ``base``; NULL without a base."""
    return (
        F.when(base.isNull(), None)
        .when(value > base, 1)
        .when(value < base, -1)
        .otherwise(0)
        .cast("long")
    )
