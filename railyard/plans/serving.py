"""Serving: typed copies of the marts, refreshed over a rolling window."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard import contracts
from railyard.functions.clock import as_date, month_of
from railyard.operators.merge import merge_into_parquet, merge_upsert
from railyard.session import require_ansi
from railyard.sources.tables import PARTITION, is_committed, table_path

REPORT_MONTH = PARTITION["serving"]


@dataclass(frozen=True)
class ServingTable:
    name: str
    mart: str
    keys: tuple[str, ...]
    date: str


# Merge keys, and the days a later run refreshes.
DAILY_VOLUME = ServingTable("daily_txn_volume", "mart_daily_txn_volume", ("report_date", "scheme"), "report_date")
SCHEME_PERFORMANCE = ServingTable(
    "scheme_performance", "mart_scheme_performance", ("report_date", "scheme", "channel"), "report_date"
)
SETTLEMENT = ServingTable(
    "settlement_summary",
    "mart_settlement_summary",
    ("settlement_date", "originating_bank_id", "receiving_bank_id"),
    "settlement_date",
)
TABLES = (DAILY_VOLUME, SCHEME_PERFORMANCE, SETTLEMENT)
WINDOW_DAYS = 7


def in_window(df: DataFrame, date: str, as_of: str | dt.date, days: int = WINDOW_DAYS) -> DataFrame:
    return df.filter(F.col(date) >= F.date_sub(as_date(as_of), days))


def typed(table: ServingTable, mart: DataFrame) -> DataFrame:
    return contracts.conform(mart, contracts.SERVING[table.name])


def publish(
    table: ServingTable, mart: DataFrame, existing: DataFrame | None, as_of: str | dt.date, days: int = WINDOW_DAYS
) -> DataFrame:
    """The serving table after a run: a full copy first, later only the window is merged in."""
    rows = typed(table, mart)
    if existing is None:
        return rows
    return merge_upsert(existing, in_window(rows, table.date, as_of, days), table.keys)


def load_serving(table: ServingTable, mart: DataFrame, root: str, as_of: str | dt.date) -> DataFrame:
    """Create or refresh the serving table under ``root`` and read it. Its partition follows from its key.

    Where ``as_of`` is a moment it is the load stamp too.
    """
    spark = mart.sparkSession
    require_ansi(spark)  # a sum too large for its column raises, instead of being published as NULL
    path = table_path(root, "serving", table.name)
    rows = typed(table, mart)
    if is_committed(spark, path):
        rows = in_window(rows, table.date, as_of)
    stamp = as_of if isinstance(as_of, dt.datetime) else None
    rows = contracts.stamped(rows, "serving", stamp).withColumn(REPORT_MONTH, month_of(F.col(table.date)))
    merge_into_parquet(
        spark, path, rows, table.keys, REPORT_MONTH, partition_fixed_by_key=True, schema=rows.schema
    )
    return spark.read.schema(rows.schema).parquet(path)
