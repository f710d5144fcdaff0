"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0.0 where the ratio is undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def percent_or_zero(part: Column, whole: Column) -> Column:
    return ratio_or_zero(part, whole) * 100


def round_even(value: Column, digits: int) -> Column:
    """Half-to-even rounding, the convention of the reports."""
    return F.bround(value, digits)
