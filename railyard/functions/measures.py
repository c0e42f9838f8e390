"""Aggregate columns and number rules shared by marts, metrics and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, scale: int) -> Column:
    """Round a double by scaling it in binary: round(x * 10^s) / 10^s.

    ``F.round`` rounds the shortest decimal text of the double instead, which differs on ties.
    """
    factor = float(10**scale)
    return F.round(c * F.lit(factor), 0) / F.lit(factor)


def count_true(predicate: Column) -> Column:
    """Rows where the predicate is true; 0 when there are none."""
    return F.count_if(predicate)


def sum_where(value: Column, predicate: Column) -> Column:
    """Sum over the rows where the predicate is true; NULL when there are none."""
    return F.sum(F.when(predicate, value))


def percent(part: Column, whole: Column, scale: int, intermediate_scale: int | None = None) -> Column:
    """``part`` as a percentage of ``whole``, in the declared DECIMAL(6, scale).

    Computed in double, so 2 of 3 gives 66.667. ``intermediate_scale=1`` instead gives what an engine
    shows that divides in DECIMAL with one decimal before rounding (66.700).
    """
    value = part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double")
    if intermediate_scale is not None:
        value = round_half_up(value, intermediate_scale)
    return round_half_up(value, scale).cast(f"decimal(6,{scale})")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL when the denominator is 0 or NULL."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
