"""High-water-mark filters for incremental loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how far before the high-water mark a load looks back.
BACK_WINDOW = dt.timedelta(hours=1)
EPOCH = dt.datetime(1970, 1, 1)


def high_water(target: DataFrame, column: str) -> dt.datetime | None:
    """The greatest event time already loaded; one value, read once, used as a literal."""
    return target.agg(F.max(column).alias("high_water")).first()["high_water"]


def since_high_water(
    source: DataFrame,
    event_time: str,
    mark: dt.datetime | None,
    back_window: dt.timedelta = BACK_WINDOW,
) -> DataFrame:
    """Rows later than the mark less the back window. An empty target counts as the epoch.

    The bound is a literal of the column's own type, so it is pushed to the Parquet scan and prunes row
    groups.
    """
    bound = (mark or EPOCH) - back_window
    return source.filter(F.col(event_time) > _literal(bound, source, event_time))


def strictly_since(source: DataFrame, column: str, mark: object | None, full_refresh: bool = False) -> DataFrame:
    """Rows later than the mark, without a back window. A full refresh keeps all rows.

    With an empty target the comparison is with NULL, so no row passes.
    """
    if full_refresh:
        return source
    if mark is None:
        return source.filter(F.lit(False))
    return source.filter(F.col(column) > _literal(mark, source, column))


def _literal(value: object, source: DataFrame, column: str) -> Column:
    """A literal of the column's type; times are UTC, which the session zone must be too."""
    return F.lit(str(value)).cast(source.schema[column].dataType)
