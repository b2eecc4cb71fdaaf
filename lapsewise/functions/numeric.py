"""Exact arithmetic for money and rates.

Sums of doubles depend on the order of the rows, and so on the partitioning.
Money is therefore summed as whole cents in a bigint, and rounding is done on
integers (half away from zero); a double appears only in the last step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    return (amount.cast("decimal(18,2)") * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return cents.cast("double") / F.lit(100.0)


def _floor_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def round_half_up(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to the nearest integer; null for a zero denominator."""
    safe = F.nullif(denominator, F.lit(0))
    size = _floor_div(F.abs(numerator) * 2 + safe, safe * 2)
    return F.when(numerator < 0, -size).otherwise(size)


def percentage(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals; null when ``whole`` is 0."""
    return from_cents(round_half_up(part * 10000, whole))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
