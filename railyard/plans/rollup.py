"""Rollups kept per silver day, so that a full refresh of the marts reads only the days that changed.

The marts are rebuilt completely on every run. Reading all of silver for that would make the hourly cost
grow with history. Instead each rail has a rollup table with one partition per silver day; a run recomputes
the partitions of changed days and derives the marts from the rollups, which hold a few rows per day.

Changed days are noted before silver changes and forgotten after the rollups are written. A run that
breaks off in between leaves its notes, and the next one recomputes those days.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.merge import in_partitions, partition_path, write_partitions
from railyard.plans import gold
from railyard.plans.silver import EVENT_DAY, read_silver
from railyard.rails import ACH, Rail
from railyard.session import drop_path, list_folders
from railyard.sources.tables import append_rows, is_committed, recorded_write, table_exists, table_path

NOTES = "changed_days"
NOTE_SCHEMA = T.StructType([T.StructField(EVENT_DAY, T.DateType()), T.StructField("everything", T.BooleanType())])


def _notes_path(root: str, rail: Rail) -> str:
    return f"{table_path(root, 'silver', NOTES)}/{rail.name}"


def note_changes(spark: SparkSession, root: str, rail: Rail, days: list[dt.date | None] | None) -> None:
    """Remember days whose rollups are out of date; None means all of them."""
    rows = [(None, True)] if days is None else [(day, False) for day in days]
    if rows:
        append_rows(spark.createDataFrame(rows, NOTE_SCHEMA).coalesce(1), _notes_path(root, rail))


def _noted(spark: SparkSession, root: str, rail: Rail) -> set[dt.date | None] | None:
    """Days noted for the rail; None for all of them, an empty set for none."""
    path = _notes_path(root, rail)
    if not table_exists(spark, path):
        return set()
    notes = spark.read.schema(NOTE_SCHEMA).parquet(path).distinct().collect()  # one row per day
    return None if any(n.everything for n in notes) else {n[EVENT_DAY] for n in notes}


def _path(root: str, rail: Rail, kind: str) -> str:
    return table_path(root, "gold", f"rollup_{kind}_{rail.name}")


def _rollup(rail: Rail, kind: str, rows: DataFrame) -> DataFrame:
    if kind == "channel":
        return gold.channel_rollup(gold.unified(rail, rows, EVENT_DAY), EVENT_DAY)
    return gold.settlement_rollup(rows, EVENT_DAY)


def _read(spark: SparkSession, root: str, rail: Rail, kind: str) -> DataFrame:
    """The written rollup; the schema is given, as a rollup without rows has no files."""
    schema = _rollup(rail, kind, read_silver(spark, rail, root)).schema
    return spark.read.schema(schema).parquet(_path(root, rail, kind)).drop(EVENT_DAY)


def _refresh(spark: SparkSession, root: str, rail: Rail, kind: str, days: set[dt.date | None] | None) -> None:
    path = _path(root, rail, kind)
    rows = read_silver(spark, rail, root)
    whole = days is None or not is_committed(spark, path)
    with recorded_write(spark, path):
        if whole:
            drop_path(spark, path)
        else:
            changed = list(days)
            for day in changed:
                drop_path(spark, partition_path(path, EVENT_DAY, day))
            rows = rows.filter(in_partitions(EVENT_DAY, changed))
        write_partitions(_rollup(rail, kind, rows), path, EVENT_DAY)


def refresh_rollups(spark: SparkSession, root: str, rail: Rail) -> None:
    """Bring the rail's rollups up to date with silver."""
    days = _noted(spark, root, rail)
    for kind in ("channel", "settlement") if rail.name == ACH.name else ("channel",):
        if days is None or days or not is_committed(spark, _path(root, rail, kind)):
            _refresh(spark, root, rail, kind, days)
    drop_path(spark, _notes_path(root, rail))


def tidy_notes(spark: SparkSession, root: str) -> None:
    """Remove the notes folder once no rail has notes in it."""
    path = table_path(root, "silver", NOTES)
    if not list_folders(spark, path):
        drop_path(spark, path)


def channel_rollups(spark: SparkSession, root: str, rails: list[Rail]) -> DataFrame:
    """All rails' rollups per date, scheme and channel."""
    parts = [_read(spark, root, rail, "channel") for rail in rails]
    return gold.merged_rollup(reduce(DataFrame.unionByName, parts))


def settlement_rollups(spark: SparkSession, root: str) -> DataFrame:
    return gold.merged_settlement_rollup(_read(spark, root, ACH, "settlement"))
