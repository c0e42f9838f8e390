"""Freshness of tables: the load gate, the source thresholds and the lag report.

Each table is reduced to (row count, last event) in one aggregation; everything after that is a handful
of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.functions.clock import as_timestamp, micros_between, seconds_between

# Thresholds in hours, and the classes of the gate.
SLA_HOURS, HISTORICAL_HOURS = 6.0, 24.0
WARN_HOURS, ERROR_HOURS = 2.0, 24.0
EMPTY, NULL_TIMESTAMP, FRESH, HISTORICAL, STALE = "EMPTY", "NULL_TIMESTAMP", "FRESH", "HISTORICAL", "STALE"

MICROS_PER_HOUR = 3_600_000_000

Tables = Mapping[str, tuple[DataFrame, str]]  # table name -> (rows, event-time column)


def last_events(tables: Tables) -> DataFrame:
    parts = [
        df.agg(F.count("*").alias("row_count"), F.max(F.col(ts).cast("timestamp_ntz")).alias("last_event")).select(
            F.lit(name).alias("table_name"), "row_count", "last_event"
        )
        for name, (df, ts) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gate(
    tables: Tables,
    as_of: str | dt.datetime,
    sla_hours: float = SLA_HOURS,
    historical_hours: float = HISTORICAL_HOURS,
) -> DataFrame:
    """Status per table. Empty and undated tables fail, then in this order: within the SLA is fresh,
    beyond the cutoff is a backfill (passes with a warning), anything between is stale and fails."""
    return gate_of(last_events(tables), as_of, sla_hours, historical_hours)


def gate_of(
    events: DataFrame,
    as_of: str | dt.datetime,
    sla_hours: float = SLA_HOURS,
    historical_hours: float = HISTORICAL_HOURS,
) -> DataFrame:
    """The gate over (table_name, row_count, last_event), from ``last_events`` or from kept statistics."""
    lag = micros_between(F.col("last_event"), as_timestamp(as_of))
    status = (
        F.when(F.col("row_count") == 0, EMPTY)
        .when(F.col("last_event").isNull(), NULL_TIMESTAMP)
        .when(lag <= int(sla_hours * MICROS_PER_HOUR), FRESH)
        .when(lag > int(historical_hours * MICROS_PER_HOUR), HISTORICAL)
        .otherwise(STALE)
    )
    outcome = F.when(F.col("status") == FRESH, "pass").when(F.col("status") == HISTORICAL, "warn").otherwise("fail")
    return (
        events.withColumn("lag_hours", lag.cast("double") / float(MICROS_PER_HOUR))
        .withColumn("status", status)
        .withColumn("outcome", outcome)
    )


def source_freshness(
    tables: Tables, as_of: str | dt.datetime, warn_hours: float = WARN_HOURS, error_hours: float = ERROR_HOURS
) -> DataFrame:
    """pass, warn or error by age. A table without any event time is an error."""
    age = micros_between(F.col("last_event"), as_timestamp(as_of))
    status = (
        F.when(F.col("last_event").isNull(), "error")
        .when(age > int(error_hours * MICROS_PER_HOUR), "error")
        .when(age > int(warn_hours * MICROS_PER_HOUR), "warn")
        .otherwise("pass")
    )
    return last_events(tables).select("table_name", "last_event", status.alias("status"))


def lag_minutes(tables: Tables, as_of: str | dt.datetime) -> DataFrame:
    lag = seconds_between(F.col("last_event"), as_timestamp(as_of)).cast("double") / 60.0
    return last_events(tables).select("table_name", "last_event", lag.alias("lag_min"))
