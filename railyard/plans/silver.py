"""Silver: one cleansed, typed, deduplicated row per key and rail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard import contracts
from railyard.checks import CHECKS
from railyard.operators.dedup import EARLY, LATEST, latest_at, latest_per_key, latest_read_again, not_null_key
from railyard.operators.directory import KeyDirectory
from railyard.operators.incremental import high_water, since_high_water
from railyard.operators.merge import merge_into_parquet, merge_upsert
from railyard.rails import Rail
from railyard.session import require_ansi
from railyard.sources import statistics
from railyard.sources.tables import PARTITION, clear_mark, is_committed, note_mark, pending_mark, table_path
from railyard.sources.tables import full_refresh as replace_table

EVENT_DAY = PARTITION["silver"]


def silver(rail: Rail, bronze: DataFrame, kept: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The whole silver step: needed columns, latest version per key, cleansing.

    NULL keys are dropped before the shuffle where the rail drops them at all. With ``kept`` bronze is cheap to read
    again, so that only repeated keys' rows need the shuffle (``latest_read_again``).
    """
    source = bronze.select(*rail.source_columns)
    if rail.drop_null_key:
        source = not_null_key(source, rail.dedup_keys)
    if kept is None:
        latest = latest_per_key(source, rail.dedup_keys, order=[rail.event_time], prefer=rail.prefer)
    else:
        latest = latest_read_again(source, rail.dedup_keys, order=[rail.event_time], prefer=rail.prefer, kept=kept)
    return cleanse(rail, latest)


def silver_at(rail: Rail, bronze: DataFrame, early: Column) -> DataFrame:
    """``silver`` of all rows and of the ``early`` ones by one pass; ``LATEST`` and ``EARLY`` tell whose row it is."""
    source = bronze.select(*rail.source_columns)
    if rail.drop_null_key:
        source = not_null_key(source, rail.dedup_keys)
    latest = latest_at(source, rail.dedup_keys, order=[rail.event_time], prefer=rail.prefer, early=early)
    return latest.select([f.column() for f in rail.fields] + [LATEST, EARLY])


def cleanse(rail: Rail, latest: DataFrame) -> DataFrame:
    return latest.select([f.column() for f in rail.fields])


def silver_increment(rail: Rail, bronze: DataFrame, target: DataFrame) -> DataFrame:
    """Silver rows of one incremental load: what is newer than the target's high-water mark less 1 hour.

    The mark is on event time, so a change to a row that is older than that is not seen; a full refresh
    repairs it.
    """
    return silver(rail, since_high_water(bronze, rail.event_time, high_water(target, rail.high_water)))


def silver_after_load(rail: Rail, bronze: DataFrame, target: DataFrame) -> DataFrame:
    """The silver table after an incremental load, as a DataFrame."""
    return merge_upsert(target, silver_increment(rail, bronze, target), rail.merge_keys)


def with_event_day(rail: Rail, df: DataFrame) -> DataFrame:
    return df.withColumn(EVENT_DAY, F.col(rail.event_day).cast("date"))


def table_schema(spark: SparkSession, rail: Rail) -> T.StructType:
    """Columns of the written table: silver, load stamp, partition."""
    columns = cleanse(rail, spark.createDataFrame([], rail.bronze_schema)).schema.fields
    stamp = T.StructField(contracts.LOAD_STAMP["silver"], T.TimestampType())
    return T.StructType([*columns, stamp, T.StructField(EVENT_DAY, T.DateType())])


def read_silver(spark: SparkSession, rail: Rail, root: str) -> DataFrame:
    """The rail's written table. The schema is given, so files older than a column read it as NULL."""
    return spark.read.schema(table_schema(spark, rail)).parquet(table_path(root, "silver", rail.silver_table))


def silver_path(rail: Rail, root: str) -> str:
    return table_path(root, "silver", rail.silver_table)


def key_directory(spark: SparkSession, rail: Rail, root: str) -> KeyDirectory:
    """Which day each key of the rail's written table is in."""
    columns = {f.name: f for f in table_schema(spark, rail).fields}
    schema = T.StructType([columns[c] for c in (*rail.merge_keys, EVENT_DAY)])
    return KeyDirectory.beside(spark, silver_path(rail, root), rail.merge_keys, schema)


def row_rules(rail: Rail) -> dict[str, Column]:
    """The rail's row tests by name, true for a row that breaks one."""
    return {f"{c.column} {c.kind}": c.violation() for c in CHECKS.get(rail.silver_table, ()) if c.kind != "unique"}


def measure(
    spark: SparkSession, rail: Rail, root: str, changed: Sequence[object] | None, before: Sequence[T.Row] | None
) -> None:
    """Bring the written table's statistics up to date, measuring the changed days only."""
    statistics.refresh(
        spark, silver_path(rail, root), read_silver(spark, rail, root), EVENT_DAY, rail.high_water, changed, before, row_rules(rail)
    )


def silver_statistics(spark: SparkSession, rail: Rail, root: str) -> statistics.Totals:
    """Rows, greatest event time and broken row tests of the written table; measured only where that is missing."""
    found = statistics.read(spark, silver_path(rail, root))
    if found is None:
        measure(spark, rail, root, None, None)
        found = statistics.read(spark, silver_path(rail, root))
    return statistics.totals(found)


def load_silver(
    rail: Rail,
    bronze: DataFrame,
    root: str,
    full_refresh: bool = False,
    before_change: Callable[[list[object] | None], None] | None = None,
    loaded_at: dt.datetime | None = None,
) -> None:
    """Create or incrementally update the rail's silver table under ``root``.

    ``before_change`` is told the days about to change, or None for all of them. ``loaded_at`` is the load stamp, now
    by default. The high-water mark comes from the table's statistics.
    """
    spark = bronze.sparkSession
    require_ansi(spark)
    path = silver_path(rail, root)
    noted = False
    if full_refresh or not is_committed(spark, path):
        rows = silver(rail, bronze)
    else:
        # the mark of a load that broke off still holds: the target's maximum may be that load's own
        mark = pending_mark(spark, path)
        if mark is None:
            mark = silver_statistics(spark, rail, root).last_event
            if mark is not None:
                note_mark(spark, path, mark)
        rows = silver(rail, since_high_water(bronze, rail.event_time, mark))
        noted = True
    merge_silver(rail, rows, root, full_refresh, before_change, loaded_at)
    if noted or full_refresh:
        clear_mark(spark, path)


def merge_silver(
    rail: Rail,
    rows: DataFrame,
    root: str,
    full_refresh: bool = False,
    before_change: Callable[[list[object] | None], None] | None = None,
    loaded_at: dt.datetime | None = None,
    newer_by: str | None = None,
) -> None:
    """Merge silver rows, each key once, into the written table; directory and statistics follow.

    Where keys are is looked up in the key directory, so the table's key columns are scanned only where the directory
    is missing. Directory and statistics are taken back before the first change and completed after the last.
    """
    spark = rows.sparkSession
    path = silver_path(rail, root)
    rows = with_event_day(rail, contracts.stamped(rows, "silver", loaded_at))
    directory = key_directory(spark, rail, root)
    before = statistics.read(spark, path)

    def begin(days: list[object] | None) -> None:
        if before_change:
            before_change(days)
        directory.invalidate()
        statistics.invalidate(spark, path)

    def complete(batch: DataFrame | None, days: list[object] | None) -> None:
        if batch is None:
            directory.rebuild(read_silver(spark, rail, root), path)
        else:
            directory.put(batch)
            directory.confirm()
        measure(spark, rail, root, days, None if batch is None else before)

    if full_refresh:
        begin(None)
        replace_table(rows, path, EVENT_DAY)
        complete(None, None)
        return

    def locate(batch: DataFrame) -> DataFrame:
        if not directory.complete:
            directory.rebuild(read_silver(spark, rail, root), path)
        return directory.find(batch)

    merge_into_parquet(
        spark, path, rows, rail.merge_keys, EVENT_DAY, schema=table_schema(spark, rail),
        before_change=begin, locate=locate, newer_by=newer_by, after_change=complete,
    )
