"""Silver from a streamed bronze table: each load reads the chunks that are new to it, and nothing else of bronze.

What a load has taken in is kept beside the silver table: the names of the chunks, and a directory with the last
event applied to each bronze key (its ``seq``, whether the key lives, its event time). An event counts if it is later
than the one applied, so chunks may come in any order, be read twice or be folded: the outcome is the same. The
directory's totals are bronze's row count and greatest event time, so gate, telemetry and alignment read no bronze row.

Written in this order: silver, directory, chunk names. A run that breaks off in between is repeated by the next one.
Deletes leave bronze and stay in silver, as with every incremental load here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.changelog import DELETE, last_event, live_rows
from railyard.operators.directory import BUCKET, KeyDirectory
from railyard.operators.merge import same_key
from railyard.plans.silver import merge_silver, silver, silver_path
from railyard.rails import Rail
from railyard.session import require_ansi, staged
from railyard.sources import statistics
from railyard.sources.tables import beside, full_refresh, is_committed, path_exists
from railyard.streaming import bronze

LIVE, EVENT_AT = "live", "event_at"


@dataclass(frozen=True)
class StreamedBronze:
    """A bronze table of change chunks, as ``streaming.bronze`` writes it."""

    rail: Rail
    path: str


def applied(spark: SparkSession, source: StreamedBronze, root: str) -> KeyDirectory:
    """The last event applied to silver, by bronze key."""
    keys = [source.rail.bronze_schema[k] for k in source.rail.keys]
    schema = T.StructType([
        *keys, T.StructField("seq", T.LongType()), T.StructField(LIVE, T.BooleanType()), T.StructField(EVENT_AT, T.TimestampNTZType())
    ])
    return KeyDirectory(spark, beside(silver_path(source.rail, root), "applied"), source.rail.keys, schema)


def _taken_path(source: StreamedBronze, root: str) -> str:
    return beside(silver_path(source.rail, root), "taken")


def taken(spark: SparkSession, source: StreamedBronze, root: str) -> list[str]:
    """Chunks that loads have taken in."""
    path = _taken_path(source, root)
    if not path_exists(spark, path) or not is_committed(spark, path):
        return []
    return [r["chunk"] for r in spark.read.schema("chunk string").parquet(path).collect()]  # one row per chunk


def _note_taken(spark: SparkSession, source: StreamedBronze, root: str, names: list[str]) -> None:
    full_refresh(spark.createDataFrame([(n,) for n in names], "chunk string").coalesce(1), _taken_path(source, root))


def _as_entries(events: DataFrame, rail: Rail) -> DataFrame:
    lives = F.coalesce(F.col("op") != DELETE, F.lit(False))
    return events.select(*rail.keys, "seq", lives.alias(LIVE), F.col(rail.event_time).cast("timestamp_ntz").alias(EVENT_AT))


def load_streamed(
    spark: SparkSession,
    source: StreamedBronze,
    root: str,
    before_change: Callable[[list[object] | None], None] | None = None,
    loaded_at: dt.datetime | None = None,
) -> None:
    """Bring the rail's silver table under ``root`` up to date with the chunks not yet taken in."""
    require_ansi(spark)
    rail, directory = source.rail, applied(spark, source, root)
    first = not is_committed(spark, silver_path(rail, root))
    present, known = bronze.chunks(spark, source.path), [] if first else taken(spark, source, root)
    new = [c for c in present if c not in set(known)]
    if not new and not first:
        return
    events = last_event(bronze.read_events(spark, rail, source.path, new), rail.keys)
    if first:
        merge_silver(rail, silver(rail, live_rows(events)), root, before_change=before_change, loaded_at=loaded_at)
        directory.rebuild(_as_entries(events, rail), directory.path)
        _measure(directory, None, None)
    else:
        if not directory.complete:
            old = bronze.read_events(spark, rail, source.path, [c for c in present if c in set(known)])
            directory.rebuild(_as_entries(last_event(old, rail.keys), rail), directory.path)
            _measure(directory, None, None)
        with staged(_winners(events, directory), "changes") as won:
            # a silver key that stands for several bronze keys keeps its newest version
            newer_by = None if set(rail.keys) == set(rail.dedup_keys) else rail.high_water
            merge_silver(rail, silver(rail, live_rows(won)), root, before_change=before_change, loaded_at=loaded_at, newer_by=newer_by)
            before = statistics.read(spark, directory.path)
            statistics.invalidate(spark, directory.path)
            buckets, changed = directory.buckets, directory.put(_as_entries(won, rail))
            _measure(directory, changed, before if directory.buckets == buckets else None)
    _note_taken(spark, source, root, present)


def _winners(events: DataFrame, directory: KeyDirectory) -> DataFrame:
    """Events later than the one applied to their key."""
    known = directory.find(events).select(*directory.keys, F.col("seq").alias("_applied"))
    joined = events.alias("e").join(known.alias("k"), same_key(directory.keys, "e", "k"), "left")
    return joined.filter("k._applied IS NULL OR e.seq > k._applied").select("e.*")


def _measure(directory: KeyDirectory, buckets: list[int] | None, before: list[T.Row] | None) -> None:
    statistics.refresh(directory.spark, directory.path, directory.read().filter(LIVE), BUCKET, EVENT_AT, buckets, before)


def bronze_totals(spark: SparkSession, source: StreamedBronze, root: str) -> statistics.Totals:
    """Live rows and their greatest event time, as far as loads have taken bronze in."""
    directory = applied(spark, source, root)
    if not directory.complete:
        return statistics.Totals(0, None)
    found = statistics.read(spark, directory.path)
    if found is None:
        _measure(directory, None, None)
        found = statistics.read(spark, directory.path)
    return statistics.totals(found)


def arrived(spark: SparkSession, source: StreamedBronze) -> statistics.Totals:
    """Events in the table's chunks and their greatest event time, taken in or not: what the freshness gate asks."""
    facts = bronze.chunk_facts(spark, source.rail, source.path).agg(F.sum("events"), F.max("last_event")).first()
    return statistics.Totals(facts[0] or 0, facts[1])


def fold_taken(spark: SparkSession, source: StreamedBronze, root: str, fan: int = bronze.FOLD_AT) -> int:
    """Fold chunks that have been taken in, by the size rule; how many went. The folded chunk counts as taken in."""
    names = taken(spark, source, root)
    present = set(bronze.chunks(spark, source.path))
    gone = 0
    for name, chunks in bronze.due_folds(spark, source.rail, source.path, [n for n in names if n in present], fan).items():
        names = [*(n for n in names if n in present and n != name), name]
        _note_taken(spark, source, root, names)
        gone += bronze.fold_chunks(spark, source.rail, source.path, name, only=chunks, again=True)
    return gone
