"""The hourly chain: freshness gate, silver, tests, telemetry, gold, serving.

One function call per run; when to call it is up to the caller's scheduler.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard import contracts
from railyard.checks import CHECKS
from railyard.functions.clock import month_of
from railyard.operators import audit, freshness, quality
from railyard.operators.merge import compact, merge_into_parquet, replace_partitions
from railyard.plans import gold, rollup, serving, silver, streamed
from railyard.plans.streamed import StreamedBronze
from railyard.rails import ACH, RAILS, Rail
from railyard.session import in_parallel, staged
from railyard.sources import statistics
from railyard.sources.statistics import Totals
from railyard.sources.tables import PARTITION, is_committed, require_columns, table_exists, table_path, typed_rows

REPORT_MONTH = PARTITION["gold"]
BATCH_MONTH = "batch_month"


class ChainStopped(RuntimeError):
    """A gate or a blocking test failed; later stages did not run."""


Bronze = DataFrame | StreamedBronze


def run_chain(
    spark: SparkSession,
    bronze: Mapping[str, Bronze],
    root: str,
    as_of: dt.datetime,
    run_id: str,
    maintain: bool = True,
    block_on_tests: bool = True,
) -> DataFrame:
    """Run all stages under ``root`` and return the alignment report (rows per table).

    A rail's bronze is a DataFrame, which is passed over once for gate, telemetry and alignment and filtered by the
    high-water mark for the load, or a ``StreamedBronze``, of which only new chunks are read. Silver is tested and
    counted by its statistics, so a run reads the days it changes. ``as_of`` is the load stamp of all layers.
    A failed gate stops the chain before anything is written; a failed test after the layer it concerns.
    A run that is repeated with its ``run_id`` leaves its telemetry once.
    """
    arrivals = check_gate(spark, bronze, as_of)
    in_parallel(lambda name: load_rail(spark, RAILS[name], bronze[name], root, as_of), bronze)
    check_silver(spark, [RAILS[name] for name in bronze], root, block_on_tests)
    if maintain:
        in_parallel(lambda name: maintain_rail(spark, RAILS[name], bronze[name], root), bronze)
    counted = counts_of(spark, bronze, arrivals, root)
    record_metrics(spark, counted, root, as_of, run_id)

    marts = build_gold(spark, root, [RAILS[name] for name in bronze], as_of)
    check_layer(marts, block_on_tests)
    published = [t for t in serving.TABLES if t.mart in marts]
    copies = in_parallel(lambda t: publish(spark, t, marts[t.mart], root, as_of, maintain), published)
    served = {t.name: copy for t, copy in zip(published, copies)}
    check_layer(served, block_on_tests)
    tables = {RAILS[n].bronze_table: pair[0] for n, pair in counted.items()}
    tables |= {RAILS[n].silver_table: pair[1] for n, pair in counted.items()}
    return statistics.as_rows(spark, tables).select("table_name", "row_count").unionByName(audit.row_counts(marts | served))


def load_rail(spark: SparkSession, rail: Rail, bronze: Bronze, root: str, loaded_at: dt.datetime | None = None) -> None:
    """Load silver, noting the days that change for the rollups."""
    note = partial(rollup.note_changes, spark, root, rail)
    if isinstance(bronze, StreamedBronze):
        streamed.load_streamed(spark, bronze, root, before_change=note, loaded_at=loaded_at)
    else:
        silver.load_silver(rail, bronze, root, before_change=note, loaded_at=loaded_at)


def maintain_rail(spark: SparkSession, rail: Rail, bronze: Bronze, root: str) -> None:
    """Compact silver days of many small files, and fold chunks of bronze that silver has taken in."""
    compact(spark, silver.silver_path(rail, root), silver.EVENT_DAY)
    if isinstance(bronze, StreamedBronze):
        streamed.fold_taken(spark, bronze, root)


def publish(
    spark: SparkSession, table: serving.ServingTable, mart: DataFrame, root: str, as_of: dt.datetime, maintain: bool
) -> DataFrame:
    """Refresh one serving table and read it."""
    served = serving.load_serving(table, mart.drop(REPORT_MONTH), root, as_of)
    path = table_path(root, "serving", table.name)
    if maintain and table_exists(spark, path):
        compact(spark, path, REPORT_MONTH)
    return spark.read.schema(served.schema).parquet(path)


def check_gate(spark: SparkSession, bronze: Mapping[str, Bronze], as_of: dt.datetime) -> dict[str, Totals]:
    """Rows (of a stream: events) and greatest event time per bronze table; raises where the gate fails."""
    by_table = {RAILS[n].bronze_table: (RAILS[n], source) for n, source in bronze.items()}
    frames = {t: (df, rail.event_time) for t, (rail, df) in by_table.items() if not isinstance(df, StreamedBronze)}
    known = {t: streamed.arrived(spark, source) for t, (_, source) in by_table.items() if isinstance(source, StreamedBronze)}
    if frames:
        known |= {r["table_name"]: Totals(r["row_count"], r["last_event"]) for r in freshness.last_events(frames).collect()}
    failed = freshness.gate_of(statistics.as_rows(spark, known), as_of).filter(F.col("outcome") == "fail").collect()
    if failed:  # one row per table
        raise ChainStopped("; ".join(f"{r['table_name']}: {r['status']}" for r in failed))
    return known


def counts_of(
    spark: SparkSession, bronze: Mapping[str, Bronze], arrivals: Mapping[str, Totals], root: str
) -> dict[str, tuple[Totals, Totals]]:
    """Bronze and silver totals per rail, from what the gate counted and from kept statistics."""
    found = {}
    for name, source in bronze.items():
        rail = RAILS[name]
        there = streamed.bronze_totals(spark, source, root) if isinstance(source, StreamedBronze) else arrivals[rail.bronze_table]
        found[name] = (there, silver.silver_statistics(spark, rail, root))
    return found


def _stop_on(failed: list, block: bool) -> None:
    if failed and block:
        raise ChainStopped(
            "; ".join(f"{r['table_name']}.{r['column_name']} {r['check_name']}: {r['violations']}" for r in failed)
        )


def check_layer(tables: Mapping[str, DataFrame], block: bool) -> None:
    _stop_on(quality.blocking(quality.check_tables(tables, CHECKS)).collect(), block)  # one row per test


def check_silver(spark: SparkSession, rails: list[Rail], root: str, block: bool) -> None:
    results = [silver_tests(spark, rail, root) for rail in rails]
    _stop_on(quality.blocking(reduce(DataFrame.unionByName, results)).collect(), block)


def silver_tests(spark: SparkSession, rail: Rail, root: str) -> DataFrame:
    """The rail's column tests, from the written table's statistics and key directory.

    Row tests were counted day by day when the days were written. A key is unique if the table has as many rows as the
    directory has keys; only where it has not are the repeated values counted.
    """
    totals, checks = silver.silver_statistics(spark, rail, root), CHECKS[rail.silver_table]
    lines = []
    for c in checks:
        if c.kind != "unique":
            violations = totals.violations.get(f"{c.column} {c.kind}", 0)
        elif (c.column,) == rail.merge_keys and silver.key_directory(spark, rail, root).count() == totals.row_count:
            violations = 0
        else:
            violations = quality.duplicate_values(silver.read_silver(spark, rail, root), c.column).count()
        lines.append((rail.silver_table, c.column, c.kind, c.severity, violations))
    return spark.createDataFrame(lines, "table_name string, column_name string, check_name string, severity string, violations bigint")


def record_metrics(
    spark: SparkSession, counted: Mapping[str, tuple[Totals, Totals]], root: str, as_of: dt.datetime, run_id: str
) -> None:
    """One telemetry row per topic and run; a repeated run replaces its own."""
    pairs = [(RAILS[n].topic, there.row_count, here.row_count) for n, (there, here) in counted.items()]
    counts = spark.createDataFrame(pairs, "pair_name string, bronze_count bigint, silver_count bigint")
    append_run(audit.metrics_of(counts, run_id, as_of.date(), as_of), table_path(root, "serving", "pipeline_metrics"))


def append_run(metrics: DataFrame, path: str) -> None:
    """Add a run's telemetry to the typed table; rows the run left before are replaced, in its month and in others."""
    spark = metrics.sparkSession
    rows = typed_rows(metrics, contracts.PIPELINE_METRICS).withColumn(BATCH_MONTH, F.trunc("batch_date", "month"))
    if is_committed(spark, path):
        require_columns(spark.read.parquet(path).schema, rows.schema, path)
    merge_into_parquet(spark, path, rows, ["run_id", "source_topic"], BATCH_MONTH, schema=rows.schema)


def build_gold(
    spark: SparkSession, root: str, rails: list[Rail], loaded_at: dt.datetime | None = None
) -> dict[str, DataFrame]:
    """Full refresh of the marts, reading only the silver days that changed since the last one."""
    in_parallel(lambda rail: rollup.refresh_rollups(spark, root, rail), rails)
    rollup.tidy_notes(spark, root)
    with staged(rollup.channel_rollups(spark, root, rails), "rollup") as channels:
        built = [
            (serving.DAILY_VOLUME, gold.daily_volume_from_rollup(channels)),
            (serving.SCHEME_PERFORMANCE, gold.scheme_performance_from_rollup(channels)),
        ]
        if ACH in rails:
            built.append((serving.SETTLEMENT, gold.settlement_from_rollup(rollup.settlement_rollups(spark, root))))
        written = in_parallel(lambda pair: _write_mart(pair[1], root, pair[0], loaded_at), built)
    return {table.mart: mart for (table, _), mart in zip(built, written)}


def _write_mart(mart: DataFrame, root: str, table: serving.ServingTable, loaded_at: dt.datetime | None) -> DataFrame:
    rows = contracts.stamped(mart, "gold", loaded_at).withColumn(REPORT_MONTH, month_of(F.col(table.date)))
    path = table_path(root, "gold", table.mart)
    replace_partitions(rows, path, REPORT_MONTH)
    return mart.sparkSession.read.schema(rows.schema).parquet(path)
