"""Consistency audits between layers, and row-count telemetry.

Audits return issue rows: a healthy lake gives none. All of them aggregate first; what is compared is one
row per table or per mart key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.functions.clock import as_date, as_timestamp, hours_between
from railyard.operators.merge import same_key

# Fixed value: hours after which a table counts as not refreshed.
MAX_AGE_HOURS = 4


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row alignment: rows per table."""
    return _union(
        [
            df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def empty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables).filter(F.col("row_count") == 0)


def pair_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Bronze and silver rows per pair."""
    sides = []
    for name, (bronze, silver) in pairs.items():
        for df, is_bronze in ((bronze, True), (silver, False)):
            n = F.count("*")
            zero = F.lit(0).cast("bigint")
            sides.append(
                df.agg(n.alias("n")).select(
                    F.lit(name).alias("pair_name"),
                    (F.col("n") if is_bronze else zero).alias("bronze_count"),
                    (zero if is_bronze else F.col("n")).alias("silver_count"),
                )
            )
    return (
        _union(sides)
        .groupBy("pair_name")
        .agg(F.sum("bronze_count").alias("bronze_count"), F.sum("silver_count").alias("silver_count"))
    )


def conservation(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Pairs whose silver table has more rows than bronze."""
    return pair_counts(pairs).filter(F.col("silver_count") > F.col("bronze_count"))


def orphan_keys(silver: DataFrame, bronze: DataFrame, silver_keys: Sequence[str], bronze_keys: Sequence[str]) -> DataFrame:
    """Silver keys that bronze no longer has (deleted at the source, kept by the merge)."""
    known = bronze.select([F.col(b).cast("string").alias(s) for s, b in zip(silver_keys, bronze_keys)])
    return silver.select(*silver_keys).join(known, list(silver_keys), "left_anti")


def reconcile_keys(
    gold: DataFrame, serving: DataFrame, keys: Sequence[str], value: str, date: str, as_of: str | dt.date, days: int = 7
) -> DataFrame:
    """Keys of the window that only one side has."""
    start = F.date_sub(as_date(as_of), days)
    g = gold.filter(F.col(date) >= start).select(*keys, F.col(value).alias("_v"))
    s = serving.filter(F.col(date) >= start).select(*keys, F.col(value).alias("_v"))
    nothing = F.lit(None).cast("bigint")

    def only(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.alias("l").join(right.select(*keys).alias("r"), same_key(keys, "l", "r"), "left_anti")

    missing = only(g, s).select(
        F.lit("gold_minus_serving").alias("direction"), *keys, F.col("_v").alias("gold_value"), nothing.alias("serving_value")
    )
    extra = only(s, g).select(
        F.lit("serving_minus_gold").alias("direction"), *keys, nothing.alias("gold_value"), F.col("_v").alias("serving_value")
    )
    return missing.unionByName(extra)


def reconcile_values(gold: DataFrame, serving: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys both sides have with different values; a NULL on one side only is a difference."""
    joined = gold.select(*keys, value).alias("g").join(
        serving.select(*keys, value).alias("s"), same_key(keys, "g", "s"), "inner"
    )
    gold_value, serving_value = F.col(f"g.{value}"), F.col(f"s.{value}")
    return joined.filter(~gold_value.eqNullSafe(serving_value)).select(
        *[F.col(f"g.{k}").alias(k) for k in keys],
        gold_value.alias("gold_value"),
        serving_value.alias("serving_value"),
    )


def stamp_coverage(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows without their writer's load stamp; a table that lacks the column counts with all its rows."""
    parts = []
    for name, (df, stamp) in tables.items():
        missing = F.count_if(F.col(stamp).isNull()) if stamp in df.columns else F.count("*")
        parts.append(
            df.agg(missing.cast("bigint").alias("unstamped_rows")).select(
                F.lit(name).alias("table_name"), F.lit(stamp).alias("stamp"), "unstamped_rows"
            )
        )
    return _union(parts)


def partition_presence(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Partitions (months) per table. A table with none is an issue."""
    parts = [
        df.select(F.trunc(date, "month").alias("m"))
        .groupBy("m")
        .count()
        .agg(F.count("*").alias("partition_count"))
        .select(F.lit(name).alias("table_name"), "partition_count", (F.col("partition_count") == 0).alias("is_issue"))
        for name, (df, date) in tables.items()
    ]
    return _union(parts)


def write_age(
    tables: Mapping[str, tuple[DataFrame, str]], as_of: str | dt.datetime, max_hours: int = MAX_AGE_HOURS
) -> DataFrame:
    """Tables last written more than ``max_hours`` whole hours ago."""
    parts = [
        df.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("last_write")).select(
            F.lit(name).alias("table_name"),
            hours_between(F.col("last_write"), as_timestamp(as_of)).alias("hours_since_last_write"),
        )
        for name, (df, ts) in tables.items()
    ]
    return _union(parts).filter(F.col("hours_since_last_write") > max_hours)


def pipeline_metrics(
    pairs: Mapping[str, tuple[DataFrame, DataFrame]], run_id: str, batch_date: str | dt.date, recorded_at: str | dt.datetime
) -> DataFrame:
    """One telemetry row per topic. Offset and lag are placeholders, as the chain does not know them."""
    return metrics_of(pair_counts(pairs), run_id, batch_date, recorded_at)


def metrics_of(
    counts: DataFrame, run_id: str, batch_date: str | dt.date, recorded_at: str | dt.datetime
) -> DataFrame:
    """Telemetry rows from (pair_name, bronze_count, silver_count), from ``pair_counts`` or from kept statistics."""
    return counts.select(
        F.lit(run_id).alias("run_id"),
        F.col("pair_name").alias("source_topic"),
        F.lit(0).cast("bigint").alias("kafka_offset"),
        F.col("bronze_count").alias("bronze_row_count"),
        F.col("silver_count").alias("silver_row_count"),
        F.lit(0.0).alias("sink_lag_seconds"),
        F.lit(str(batch_date)).cast("date").alias("batch_date"),
        as_timestamp(recorded_at).alias("recorded_at"),
    )


def drift_report(metrics: DataFrame, batch_date: str | dt.date) -> DataFrame:
    """Per topic of a day: last run, greatest counts, and silver less bronze."""
    return (
        metrics.filter(F.col("batch_date") == F.lit(str(batch_date)).cast("date"))
        .groupBy("source_topic")
        .agg(
            F.max("recorded_at").alias("last_run"),
            F.max("bronze_row_count").alias("bronze"),
            F.max("silver_row_count").alias("silver"),
            (F.max("silver_row_count") - F.max("bronze_row_count")).alias("drift"),
        )
    )
