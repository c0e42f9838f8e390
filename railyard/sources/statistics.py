"""Small tables of what a large table holds part by part, merged instead of counted again.

A table's statistics are one row per part (a day, a bucket): rows, greatest event time, and violations of row rules.
A load measures the parts it has written and leaves the others' rows as they are, so totals cost nothing that grows
with the table. Statistics lie beside their table. They are taken back before the table changes and completed after
it; a run that breaks off in between leaves none, and the next one measures all parts again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.merge import in_partitions
from railyard.session import drop_path
from railyard.sources.tables import beside, full_refresh, is_committed, path_exists

SCHEMA = T.StructType([
    T.StructField("part", T.StringType()), T.StructField("row_count", T.LongType()),
    T.StructField("last_event", T.TimestampNTZType()), T.StructField("violations", T.MapType(T.StringType(), T.LongType())),
])


@dataclass(frozen=True)
class Totals:
    row_count: int
    last_event: dt.datetime | None
    violations: dict[str, int] = field(default_factory=dict)


def path_of(table_path: str) -> str:
    return beside(table_path, "statistics")


def measured(rows: DataFrame, part: str, event_time: str, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per part of ``rows``, in one aggregation. ``rules``: by name, true for a row that breaks the rule."""
    broken = [x for name, rule in (rules or {}).items() for x in (F.lit(name), F.count_if(rule))]
    return rows.groupBy(F.col(part).cast("string").alias("part")).agg(
        F.count("*").alias("row_count"),
        F.max(F.col(event_time).cast("timestamp_ntz")).alias("last_event"),
        (F.create_map(*broken) if broken else F.create_map().cast("map<string,bigint>")).alias("violations"),
    )


def invalidate(spark: SparkSession, table_path: str) -> None:
    """Take the statistics back; done before the table changes."""
    drop_path(spark, path_of(table_path))


def refresh(
    spark: SparkSession,
    table_path: str,
    rows: DataFrame,
    part: str,
    event_time: str,
    changed: Sequence[object] | None,
    before: Sequence[T.Row] | None,
    rules: Mapping[str, Column] | None = None,
) -> None:
    """Write the statistics of a table: ``changed`` parts of ``rows`` are measured, the rest is as in ``before``.

    ``changed`` None measures everything, as does ``before`` None (statistics were missing) or rules that differ.
    """
    kept: list[T.Row] = []
    if changed is not None and before is not None and all(set(r["violations"]) == set(rules or {}) for r in before):
        names = {None if v is None else str(v) for v in changed}
        kept = [r for r in before if r["part"] not in names]
        rows = rows.filter(in_partitions(part, list(changed)))
    fresh = measured(rows, part, event_time, rules).collect()  # one row per part
    full_refresh(spark.createDataFrame([*kept, *fresh], SCHEMA).coalesce(1), path_of(table_path))


def read(spark: SparkSession, table_path: str) -> list[T.Row] | None:
    """One row per part, or None where no complete statistics are."""
    path = path_of(table_path)
    if not path_exists(spark, path) or not is_committed(spark, path):
        return None
    return spark.read.schema(SCHEMA).parquet(path).collect()


def totals(parts: Sequence[T.Row]) -> Totals:
    times = [r["last_event"] for r in parts if r["last_event"] is not None]
    violations: dict[str, int] = {}
    for r in parts:
        for name, n in r["violations"].items():
            violations[name] = violations.get(name, 0) + n
    return Totals(sum(r["row_count"] for r in parts), max(times, default=None), violations)


def as_rows(spark: SparkSession, tables: Mapping[str, Totals]) -> DataFrame:
    """(table_name, row_count, last_event), as the freshness and alignment operators count them."""
    schema = "table_name string, row_count bigint, last_event timestamp_ntz"
    return spark.createDataFrame([(name, t.row_count, t.last_event) for name, t in tables.items()], schema)
