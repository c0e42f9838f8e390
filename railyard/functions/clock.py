"""Time columns. ``as_of`` stands for "now" and is always a parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(as_of: str | dt.datetime | dt.date) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def as_date(as_of: str | dt.datetime | dt.date) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz").cast("date")


def micros_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", earlier, later)


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds, counted as elapsed time."""
    return F.timestamp_diff("SECOND", earlier, later)


def hours_between(earlier: Column, later: Column) -> Column:
    """Whole hours, counted as elapsed time (00:59 to 01:01 is 0 hours)."""
    return F.timestamp_diff("HOUR", earlier, later)


def month_of(c: Column) -> Column:
    return F.trunc(c, "month")
