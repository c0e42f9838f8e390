"""The registered queries: every operator, run over the driver's whole tables.

Bronze, silver, gold and serving keys compute from the tables directly. Metrics, tests, audits and reports
ask a written silver and gold layer, as their users do; it is derived once per session and data folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard import contracts
from railyard.checks import CHECKS
from railyard.functions.cleanse import hash_pii
from railyard.operators import audit, changelog, dedup, freshness, incremental, lineage, merge, profile, quality
from railyard.plans import chain, gold, reports, semantic, serving, silver
from railyard.rails import ACH, ATM, IPN, RAILS, WALLET
from railyard.session import in_parallel, pin_utc, shared_dir
from railyard.sources import documents, rejects, surrogates, tables, topic
from railyard.streaming import bronze as bronze_stream

Query = Callable[[SparkSession, str], DataFrame]

# The moments the scenarios use. Events end on 2024-01-30, orders and line items in 2001.
FIRST_LOAD = {"ipn": "2024-01-20 12:00:00", "wallet": "2024-01-20 12:00:00", "ach": "2001-06-01 12:00:00"}
AS_OF = "2024-01-31 03:00:00"
SECOND_RUN = "2024-01-28"
SETTLEMENT_RUN = "2001-06-09"
STALE_WINDOW = "2024-01-25"
POSITIONS_DAY = "2000-06-16"


# ---- Layers -------------------------------------------------------------------------------------------


def bronze_of(spark: SparkSession, sf_dir: str, rail: str) -> DataFrame:
    return surrogates.BRONZE[rail](spark, sf_dir)


def bronzes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {rail: bronze_of(spark, sf_dir, rail) for rail in RAILS}


def first_load(spark: SparkSession, sf_dir: str, rail: str) -> DataFrame:
    """Bronze as it stood at the rail's first load; rails without one were complete by then."""
    rows = bronze_of(spark, sf_dir, rail)
    if rail not in FIRST_LOAD:
        return rows
    return rows.filter(in_first_load(rail))


def in_first_load(rail: str) -> Column:
    return F.col(RAILS[rail].event_time).cast("timestamp_ntz") < moment(FIRST_LOAD[rail])


def once(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read back, for queries that use them several times."""
    path = f"{shared_dir(rows.sparkSession).rstrip('/')}/railyard-once/{label}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def silver_of(spark: SparkSession, sf_dir: str, rail: str) -> DataFrame:
    return silver.silver(RAILS[rail], bronze_of(spark, sf_dir, rail))


def silvers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {rail: silver_of(spark, sf_dir, rail) for rail in RAILS}


def silver_from(rail: str, bronze: DataFrame) -> DataFrame:
    """Silver of whole rails; where bronze is cheap to read again, only rows of repeated keys are shuffled."""
    return silver.silver(RAILS[rail], bronze, once if rail in surrogates.CHEAP_TO_READ else None)


def first_silvers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dict(zip(RAILS, in_parallel(lambda rail: silver_from(rail, first_load(spark, sf_dir, rail)), RAILS)))


def daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_volume(gold.all_rails(silvers(spark, sf_dir)))


def both_loads(rail: str) -> str:
    return f"{RAILS[rail].silver_table}_both_loads"


_LAKES: dict[tuple[str, str], tuple[str, set[str], RLock]] = {}


class Lake:
    """Silver and gold in the shared folder, plus the bronze rows they come from.

    Each table is written once per session and data folder, when a query first asks for it, from the tables below it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        pin_utc(spark)
        self.spark, self.sf_dir = spark, sf_dir
        fresh = (f"{shared_dir(spark).rstrip('/')}/railyard-lake/{uuid.uuid4().hex}", set(), RLock())
        self.root, self._written, self._lock = _LAKES.setdefault((spark.sparkContext.applicationId, sf_dir), fresh)

    def _table(self, layer: str, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
        path = tables.table_path(self.root, layer, name)
        if path not in self._written:
            tables.full_refresh(rows(), path)
            self._written.add(path)
        return tables.read_table(self.spark, self.root, layer, name)

    def bronze(self, rail: str) -> DataFrame:
        return bronze_of(self.spark, self.sf_dir, rail)

    def _both_loads(self, rail: str) -> DataFrame:
        """Silver after the first load and now, of a rail that is dear to read: one pass over bronze gives both."""
        return self._table("silver", both_loads(rail), lambda: silver.silver_at(RAILS[rail], self.bronze(rail), in_first_load(rail)))

    def _first_silver(self, rail: str) -> DataFrame:
        if rail not in FIRST_LOAD:
            return self._silver(rail)
        if rail in surrogates.CHEAP_TO_READ:
            return silver_from(rail, first_load(self.spark, self.sf_dir, rail))
        return self._both_loads(rail).filter(dedup.EARLY).drop(dedup.LATEST, dedup.EARLY)

    @property
    def first_silvers(self) -> dict[str, DataFrame]:
        """Silver of all rails as it stood after the first load."""
        with self._lock:
            return dict(zip(RAILS, in_parallel(self._first_silver, RAILS)))

    def _silver(self, rail: str) -> DataFrame:
        if tables.table_path(self.root, "silver", both_loads(rail)) in self._written:
            return self._both_loads(rail).filter(dedup.LATEST).drop(dedup.LATEST, dedup.EARLY)
        return self._table("silver", RAILS[rail].silver_table, lambda: silver_from(rail, self.bronze(rail)))

    def silver(self, rail: str) -> DataFrame:
        with self._lock:
            return self._silver(rail)

    def mart(self, name: str) -> DataFrame:
        def from_rollup() -> DataFrame:
            return self._table("gold", "channel_rollup", lambda: gold.channel_rollup(gold.all_rails(self.silvers)))

        rows = {
            "mart_daily_txn_volume": lambda: gold.daily_volume_from_rollup(from_rollup()),
            "mart_scheme_performance": lambda: gold.scheme_performance_from_rollup(from_rollup()),
            "mart_settlement_summary": lambda: gold.settlement_summary(self.silver("ach")),
        }
        with self._lock:
            return self._table("gold", name, rows[name])

    def serving(self, table: serving.ServingTable) -> DataFrame:
        return serving.typed(table, self.mart(table.mart))

    @property
    def silvers(self) -> dict[str, DataFrame]:
        with self._lock:
            return dict(zip(RAILS, in_parallel(self._silver, RAILS)))

    def build(self) -> None:
        """Write all tables that are not there yet."""
        _ = self.silvers, self.marts

    @property
    def marts(self) -> dict[str, DataFrame]:
        return {t.mart: self.mart(t.mart) for t in serving.TABLES}

    @property
    def event_times(self) -> dict[str, tuple[DataFrame, str]]:
        return {r.bronze_table: (self.bronze(r.name), r.event_time) for r in RAILS.values()}

    def published(self, kinds: Sequence[str]) -> dict[str, DataFrame]:
        """All published tables that have tests of the kinds, with the load stamp of their layer."""

        def asked(name: str) -> bool:
            return any(c.kind in kinds for c in CHECKS.get(name, ()))

        out = {r.bronze_table: self.bronze(r.name) for r in RAILS.values() if asked(r.bronze_table)}
        rails = [r.name for r in RAILS.values() if asked(r.silver_table)]
        with self._lock:
            silver_rows = dict(zip(rails, in_parallel(self._silver, rails)))
        out |= {RAILS[n].silver_table: contracts.stamped(df, "silver") for n, df in silver_rows.items()}
        out |= {t.mart: contracts.stamped(self.mart(t.mart), "gold") for t in serving.TABLES if asked(t.mart)}
        out |= {t.name: contracts.stamped(self.serving(t), "serving") for t in serving.TABLES if asked(t.name)}
        return out


def on_lake(ask: Callable[[Lake], DataFrame]) -> Query:
    return lambda spark, sf_dir: ask(Lake(spark, sf_dir))


# ---- Bronze -------------------------------------------------------------------------------------------


def bronze_queries() -> dict[str, Query]:
    def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = topic.encode(surrogates.ach_changelog(spark, sf_dir), ACH)
        return changelog.latest_state(topic.decode(records, ACH), ACH.keys)

    def streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The changelog as a file topic, read as a stream into a bronze table."""
        tag = hashlib.sha256(sf_dir.encode()).hexdigest()[:8]
        base = f"{shared_dir(spark).rstrip('/')}/railyard-stream/{tag}-{uuid.uuid4().hex}"
        topic.encode(surrogates.ach_changelog(spark, sf_dir), ACH).write.parquet(f"{base}/topic")
        files = str(topic.files_per_batch(spark, f"{base}/topic", at_least=2))
        changes = topic.read_stream(spark, ACH, source="parquet", path=f"{base}/topic", maxFilesPerTrigger=files)
        query = bronze_stream.start_upsert(changes, ACH, f"{base}/bronze", f"{base}/checkpoint", interval=None)
        query.awaitTermination()
        return bronze_stream.read_state(spark, ACH, f"{base}/bronze")

    def wallet_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
        return surrogates.wallet(spark, sf_dir).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))

    def fitting_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = surrogates.damaged_wallet_documents(spark, sf_dir)
        rows = documents.project_documents(docs, "document", required=["_id"])
        return rows.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))

    def rejected_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
        docs = surrogates.damaged_wallet_documents(spark, sf_dir)
        rows = documents.rejected_documents(docs, "document", required=["_id"])
        return rows.select("event_id", rejects.REASON, F.array_join(rejects.FIELDS, ",").alias("fields"))

    def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The damaged topic read as a stream that goes on; its reject table."""
        base = f"{shared_dir(spark).rstrip('/')}/railyard-stream/{uuid.uuid4().hex}"
        surrogates.damaged_ach_topic(spark, sf_dir).write.parquet(f"{base}/topic")
        files = str(topic.files_per_batch(spark, f"{base}/topic", at_least=4))
        changes = topic.read_stream(spark, ACH, source="parquet", path=f"{base}/topic", with_rejects=True, maxFilesPerTrigger=files)
        query = bronze_stream.start_upsert(
            changes, ACH, f"{base}/bronze", f"{base}/checkpoint", interval=None, reject_path=f"{base}/rejects"
        )
        query.awaitTermination()
        rows = bronze_stream.read_rejects(spark, f"{base}/rejects")
        return rows.select(topic.RECORD_KEY, "seq", rejects.REASON, F.array_join(rejects.FIELDS, ",").alias("fields"))

    def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Transfers that arrive as text, in two portions and another order of columns, appended to a typed target."""
        path = f"{shared_dir(spark).rstrip('/')}/railyard-target/{uuid.uuid4().hex}"
        rows = bronze_of(spark, sf_dir, "ach")
        early = F.coalesce(F.col(ACH.event_time) < moment(FIRST_LOAD["ach"]), F.lit(False))
        for part in (early, ~early):
            texts = rows.filter(part).select([F.col(c).cast("string").alias(c) for c in reversed(rows.columns)])
            tables.typed_append(texts, path, ACH.bronze_schema)
        return spark.read.schema(ACH.bronze_schema).parquet(path)

    return {
        "bronze_latest_state": lambda s, d: changelog.latest_state(surrogates.ach_changelog(s, d), ACH.keys),
        "bronze_composite_key": lambda s, d: changelog.latest_state(surrogates.atm_changelog(s, d), ATM.keys),
        "bronze_state_since": lambda s, d: changelog.latest_state_since(
            surrogates.ach_changelog(s, d), ACH.keys, ACH.event_time, "2001-01-01"
        ),
        "brz4_legacy_order": lambda s, d: changelog.latest_by_operation(
            surrogates.ach_changelog(s, d), ACH.keys, ACH.event_time
        ),
        "brz5_not_deleted": lambda s, d: changelog.not_deleted(surrogates.ach_changelog(s, d)),
        "src2_documents": wallet_documents,
        "src2_fitting": fitting_documents,
        "src2_rejects": rejected_documents,
        "src4_topic": decoded,
        "src4_rejects": rejected_records,
        "snk2_stream_upsert": streamed,
        "snk3_targets": targets,
    }


# ---- Silver -------------------------------------------------------------------------------------------


def silver_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in RAILS:
        out[f"silver_{name}"] = lambda s, d, name=name: silver_of(s, d, name)

    def deduplicated(name: str) -> Query:
        rail = RAILS[name]
        return lambda s, d: dedup.latest_per_key(
            bronze_of(s, d, name).select(*rail.source_columns), rail.dedup_keys, [rail.event_time], rail.prefer
        )

    def target(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
        return silver.silver(RAILS[name], first_load(spark, sf_dir, name))

    def back_window(spark: SparkSession, sf_dir: str) -> DataFrame:
        mark = incremental.high_water(target(spark, sf_dir, "ipn"), IPN.high_water)
        return incremental.since_high_water(bronze_of(spark, sf_dir, "ipn"), IPN.event_time, mark)

    def strict(spark: SparkSession, sf_dir: str) -> DataFrame:
        mark = incremental.high_water(target(spark, sf_dir, "ipn"), IPN.high_water)
        return incremental.strictly_since(bronze_of(spark, sf_dir, "ipn"), IPN.event_time, mark)

    def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
        return silver.silver_after_load(IPN, bronze_of(spark, sf_dir, "ipn"), target(spark, sf_dir, "ipn"))

    def moved(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Target and increment are written once, as a load finds and stages them."""
        old = once(target(spark, sf_dir, "ach"), "target")
        new = once(silver.silver_increment(ACH, bronze_of(spark, sf_dir, "ach"), old), "increment")
        return merge.touched_partitions(
            silver.with_event_day(ACH, old), silver.with_event_day(ACH, new), ACH.merge_keys, silver.EVENT_DAY
        )

    def new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
        old = target(spark, sf_dir, "ipn").select("txn_id", "amount_egp", "initiated_at")
        new = silver.silver_increment(IPN, bronze_of(spark, sf_dir, "ipn"), old)
        return merge.merge_upsert(old, new.select("txn_id", "amount_egp", "initiated_at", "met_sla"), IPN.merge_keys)

    def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = surrogates.load(spark, sf_dir, "customer").select(
            F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), hash_pii(F.col("c_name")).alias("digest")
        )
        texts = surrogates.load(spark, sf_dir, "documents").select(
            F.lit("document").alias("source"), F.col("doc_id").alias("id"), hash_pii(F.col("text")).alias("digest")
        )
        return names.unionByName(texts)

    return out | {
        "ded1_latest": deduplicated("ach"),
        "ded2_completed_first": deduplicated("ipn"),
        "ded3_composite_key": deduplicated("atm"),
        "inc1_back_window": back_window,
        "inc2_strict": strict,
        "mrg1_upsert": upsert,
        "mrg1_partition_move": moved,
        "mrg2_new_column": new_column,
        "pii1_hash": hashed,
    }


# ---- Gold and serving ---------------------------------------------------------------------------------


def gold_queries() -> dict[str, Query]:
    return {
        "gold_daily_volume": daily_volume,
        "gold_scheme_performance": lambda s, d: gold.scheme_performance(silvers(s, d)),
        "gold_settlement_summary": lambda s, d: gold.settlement_summary(silver_of(s, d, "ach")),
    }


def serving_queries() -> dict[str, Query]:
    """The state after two runs: a full copy of the first marts, then the window of the second, which the lake has."""

    def two_runs(table: serving.ServingTable, mart: Callable[[dict], DataFrame], as_of: str) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            first = serving.publish(table, mart(first_silvers(spark, sf_dir)), None, as_of)
            return serving.publish(table, Lake(spark, sf_dir).mart(table.mart), first, as_of)

        return run

    return {
        "serving_daily_volume": two_runs(
            serving.DAILY_VOLUME, lambda s: gold.daily_volume(gold.all_rails(s)), SECOND_RUN
        ),
        "serving_scheme_performance": two_runs(serving.SCHEME_PERFORMANCE, gold.scheme_performance, SECOND_RUN),
        "serving_settlement": two_runs(
            serving.SETTLEMENT, lambda s: gold.settlement_summary(s["ach"]), SETTLEMENT_RUN
        ),
    }


# ---- Semantic layer -----------------------------------------------------------------------------------

VOLUME_METRICS = [
    "total_transactions", "total_payment_value_egp", "total_approved_transactions", "total_failed_transactions",
    "payment_approval_rate", "payment_failure_rate", "avg_transaction_value_egp",
]
CHANNEL_METRICS = [
    "total_channel_transaction_volume", "avg_scheme_approval_rate_pct", "avg_payment_processing_latency_ms",
]
SETTLEMENT_METRICS = [
    "total_settled_transactions", "total_failed_settlement_transactions", "total_returned_transactions",
    "total_attempted_settlements", "net_settlement_value_egp", "failed_settlement_value_egp",
    "settlement_success_rate", "settlement_return_rate",
]


def semantic_queries() -> dict[str, Query]:
    def ask(metrics: list[str], group_by: tuple[str, ...] = (), **more: str) -> Query:
        return on_lake(
            lambda lake: semantic.metric_query({m: lake.mart(m) for m in semantic.marts_of(metrics)}, metrics, group_by, **more)
        )

    def spine_gaps(lake: Lake) -> DataFrame:
        """Transactions per calendar day, days without any included; no day of the mart lies outside."""
        marts = {m: lake.mart(m) for m in semantic.marts_of(["total_transactions"])}
        per_day = semantic.metric_query(marts, ["total_transactions"], ["metric_time__day"])
        first, last = per_day.agg(F.min("metric_time__day").cast("string"), F.max("metric_time__day").cast("string")).first()
        days = semantic.time_spine(lake.spark, min(first or semantic.SPINE_START, semantic.SPINE_START), max(last or semantic.SPINE_END, semantic.SPINE_END))
        return days.join(per_day, F.col("date_day") == F.col("metric_time__day"), "left").select(
            "date_day", F.coalesce("total_transactions", F.lit(0)).alias("total_transactions")
        )

    def entity_keys(lake: Lake) -> DataFrame:
        model = semantic.MODELS[1]
        return lake.mart(model.mart).select(model.entity_key().alias("entity_key"), "txn_volume")

    out = {f"metric_{name}": ask([name]) for name in semantic.METRICS}
    return out | {
        "time_spine": on_lake(spine_gaps),
        "sem3_entity_key": on_lake(entity_keys),
        "metrics_by_scheme": ask(VOLUME_METRICS, ("scheme",)),
        "metrics_by_scheme_month": ask(VOLUME_METRICS, ("scheme", "report_date__month")),
        "metrics_by_channel": ask(CHANNEL_METRICS, ("scheme", "channel")),
        "metrics_by_bank_pair": ask(SETTLEMENT_METRICS, ("originating_bank_id", "receiving_bank_id")),
        "metrics_across_marts": ask(
            [VOLUME_METRICS[0], CHANNEL_METRICS[0], SETTLEMENT_METRICS[0]], ("metric_time__year",)
        ),
        "metrics_from_start": ask(VOLUME_METRICS, ("scheme",), start="2024-01-10", end="2024-01-20"),
        "metric_approval_rate_by_scheme_week": ask(["payment_approval_rate"], ("scheme", "report_date__week")),
        "metric_settlement_by_bank": ask(["net_settlement_value_egp"], ("originating_bank_id",)),
        "metric_volume_weighted_rate": on_lake(
            lambda lake: semantic.volume_weighted_approval_rate(lake.mart("mart_scheme_performance"), ["scheme"])
        ),
    }


# ---- Quality, audits, telemetry -----------------------------------------------------------------------


def quality_queries() -> dict[str, Query]:
    def checks(kind: str) -> Query:
        return on_lake(lambda lake: quality.check_tables(lake.published([kind]), CHECKS, [kind]))

    return {
        "dq1_not_null": checks("not_null"),
        "dq2_unique": checks("unique"),
        "dq3_accepted_values": checks("accepted_values"),
        "dq4_accepted_range": checks("accepted_range"),
        "agg9_duplicates": lambda s, d: quality.duplicate_values(bronze_of(s, d, "ach"), "txn_id"),
        "frs1_gate": on_lake(lambda lake: freshness.gate(lake.event_times, AS_OF)),
        "frs2_source": on_lake(lambda lake: freshness.source_freshness(lake.event_times, AS_OF)),
        "frs3_lag_minutes": on_lake(lambda lake: freshness.lag_minutes(lake.event_times, AS_OF)),
    }


def audit_queries() -> dict[str, Query]:
    volume_keys = serving.DAILY_VOLUME.keys

    def by_topic(lake: Lake) -> dict[str, tuple[DataFrame, DataFrame]]:
        return {RAILS[n].topic: (lake.bronze(n), rows) for n, rows in lake.silvers.items()}

    def metrics(lake: Lake) -> DataFrame:
        return audit.pipeline_metrics(by_topic(lake), "run-1", AS_OF[:10], AS_OF)

    def drift(lake: Lake) -> DataFrame:
        """Two recorded runs of one day: before any silver load and after it."""
        before = {t: (b, s.filter(F.lit(False))) for t, (b, s) in by_topic(lake).items()}
        runs = audit.pipeline_metrics(before, "run-0", AS_OF[:10], f"{AS_OF[:10]} 02:00:00").unionByName(metrics(lake))
        return audit.drift_report(runs, AS_OF[:10])

    def stamps(lake: Lake) -> DataFrame:
        """Silver is stamped here, the marts are the bare aggregates."""
        pairs = {RAILS[n].silver_table: (contracts.stamped(df, "silver"), "_silver_loaded_at") for n, df in lake.silvers.items()}
        return audit.stamp_coverage(pairs | {n: (df, "_gold_loaded_at") for n, df in lake.marts.items()})

    def partitions(lake: Lake) -> DataFrame:
        return audit.partition_presence({t.mart: (lake.mart(t.mart), t.date) for t in serving.TABLES})

    def after_deletes(lake: Lake) -> DataFrame:
        return changelog.latest_state(surrogates.ach_changelog(lake.spark, lake.sf_dir), ACH.keys)

    def conservation(lake: Lake) -> DataFrame:
        """Transfers were deleted at the source after silver had loaded them."""
        pairs = {RAILS[n].bronze_table: (lake.bronze(n), rows) for n, rows in lake.silvers.items()}
        pairs[ACH.bronze_table] = (after_deletes(lake), lake.silver(ACH.name))
        return audit.conservation(pairs)

    def orphans(lake: Lake) -> DataFrame:
        return audit.orphan_keys(lake.silver(ACH.name), after_deletes(lake), ACH.merge_keys, ACH.keys)

    def stale_serving(lake: Lake) -> DataFrame:
        """Serving as published after the first load and not refreshed since. Asked for before the tables of now, it
        leaves those of the rails that are dear to read to be had from the same pass."""
        rows = gold.daily_volume(gold.all_rails(lake.first_silvers))
        return serving.typed(serving.DAILY_VOLUME, rows)

    def reconcile(lake: Lake) -> DataFrame:
        """Gold now without the wallet rail, serving still with it: both directions differ."""
        stale = stale_serving(lake)
        now = lake.mart("mart_daily_txn_volume").filter(F.col("scheme") != WALLET.scheme)
        return audit.reconcile_keys(now, stale, volume_keys, "txn_count", "report_date", STALE_WINDOW)

    def values(lake: Lake) -> DataFrame:
        stale = stale_serving(lake)
        return audit.reconcile_values(lake.mart("mart_daily_txn_volume"), stale, volume_keys, "txn_count")

    def ages(lake: Lake) -> DataFrame:
        return audit.write_age({RAILS[n].silver_table: (rows, RAILS[n].high_water) for n, rows in lake.silvers.items()}, AS_OF)

    def recorded(lake: Lake) -> DataFrame:
        """Telemetry of two runs as it is stored; the first broke off before silver and was repeated."""
        path = f"{shared_dir(lake.spark).rstrip('/')}/railyard-telemetry/{uuid.uuid4().hex}"
        before = {t: (b, s.filter(F.lit(False))) for t, (b, s) in by_topic(lake).items()}
        early = f"{AS_OF[:10]} 02:00:00"
        chain.append_run(audit.pipeline_metrics(before, "run-1", AS_OF[:10], early), path)
        chain.append_run(audit.pipeline_metrics(by_topic(lake), "run-1", AS_OF[:10], early), path)
        chain.append_run(audit.pipeline_metrics(by_topic(lake), "run-2", AS_OF[:10], AS_OF), path)
        rows = lake.spark.read.parquet(path).select(*contracts.PIPELINE_METRICS.names)
        return rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))

    def layer_tables(lake: Lake) -> dict[str, DataFrame]:
        out = {f"bronze.{r.bronze_table}": lake.bronze(r.name) for r in RAILS.values()}
        return out | {f"silver.{RAILS[n].silver_table}": rows for n, rows in lake.silvers.items()}

    def empties(lake: Lake) -> DataFrame:
        """Wallet withdrawals that were refunded: none exist, so that table is empty."""
        found = layer_tables(lake)
        found["silver.refunds"] = lake.silver(WALLET.name).filter(F.col("txn_type") == "REFUND")
        return audit.empty_tables(found)

    return {
        "tel1_counts": on_lake(metrics),
        "tel2_drift": on_lake(drift),
        "snk4_telemetry": on_lake(recorded),
        "aud2_stamps": on_lake(stamps),
        "aud3_partitions": on_lake(partitions),
        "aud4_conservation": on_lake(conservation),
        "aud5_reconcile": on_lake(reconcile),
        "aud6_empty": on_lake(empties),
        "aud7_age": on_lake(ages),
        "aud9_alignment": on_lake(lambda lake: audit.row_counts(layer_tables(lake))),
        "joi1_value_reconcile": on_lake(values),
        "joi3_orphan_keys": on_lake(orphans),
    }


# ---- Reports ------------------------------------------------------------------------------------------


def report_queries() -> dict[str, Query]:
    volume, settlement = serving.DAILY_VOLUME, serving.SETTLEMENT
    return {
        "qry1": on_lake(lambda lake: reports.last_days(lake.mart(volume.mart), AS_OF)),
        "qry2": on_lake(lambda lake: reports.ipn_sla(lake.silver("ipn"))),
        "qry3": on_lake(lambda lake: reports.scheme_totals(lake.serving(volume))),
        "qry4": on_lake(lambda lake: reports.recent_volume(lake.serving(volume), AS_OF)),
        "qry5": on_lake(lambda lake: reports.sessions_by_network(lake.bronze("atm"))),
        "qry6": on_lake(lambda lake: reports.top_positions(lake.serving(settlement), POSITIONS_DAY)),
        "qry7": on_lake(lambda lake: reports.wallet_status(lake.silver("wallet"))),
        "qry8": on_lake(lambda lake: reports.volume_in_millions(lake.mart(volume.mart))),
        "qry9": on_lake(lambda lake: reports.top_bank_pairs(lake.mart(settlement.mart))),
        "qry10": on_lake(lambda lake: reports.serving_sample(lake.serving(volume))),
        "qry11": on_lake(lambda lake: reports.card_sessions(lake.bronze("atm"), "tok_5", "1996-01-01", "1999-12-31")),
    }


# ---- Profiles, lineage, file layout -------------------------------------------------------------------

PROFILED = ("customer", "orders", "lineitem", "events", "documents")


def other_queries() -> dict[str, Query]:
    def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = [profile.profile(surrogates.load(spark, sf_dir, t), t) for t in PROFILED]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def events(spark: SparkSession, sf_dir: str) -> DataFrame:
        return lineage.parse_events(surrogates.lineage_events(spark, sf_dir))

    def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = lineage.rejected_events(surrogates.damaged_lineage_events(spark, sf_dir))
        return rows.select("event_id", rejects.REASON, F.array_join(rejects.FIELDS, ",").alias("fields"))

    def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tables.file_layout(surrogates.load(spark, sf_dir, "lineitem"))

    def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Wallet silver written in many small files per day, then compacted."""
        path = f"{shared_dir(spark).rstrip('/')}/railyard-compact/{uuid.uuid4().hex}"
        rows = silver.with_event_day(WALLET, silver_of(spark, sf_dir, "wallet"))
        rows.repartition(4).write.partitionBy(silver.EVENT_DAY).parquet(path)
        done = merge.compact(spark, path, silver.EVENT_DAY)
        return done.select("partition_value", "files", "row_count")

    return {
        "pro1_profile": profiles,
        "pro3_fields": lambda s, d: documents.document_fields(surrogates.wallet_documents(s, d), "document"),
        "pro3_schema": lambda s, d: documents.document_schema(surrogates.wallet_documents(s, d), "document"),
        "lin1_edges": lambda s, d: lineage.distinct_edges(events(s, d)),
        "lin2_status": lambda s, d: lineage.run_status(events(s, d), ["event_time", "event_id"]),
        "lin_rejects": rejected_events,
        "scn4_layout": layout,
        "mnt1_compaction": compacted,
    }


def queries() -> dict[str, Query]:
    return (
        bronze_queries()
        | silver_queries()
        | gold_queries()
        | serving_queries()
        | semantic_queries()
        | quality_queries()
        | audit_queries()
        | report_queries()
        | other_queries()
    )
