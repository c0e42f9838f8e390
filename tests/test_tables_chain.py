"""Written tables, compaction, snapshot ranges, documents, reports, and the whole chain."""

from __future__ import annotations

import datetime as dt
from functools import partial
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import DAY, TS, all_bronze, as_dicts, bronze

from railyard import contracts
from railyard.operators import audit, merge
from railyard.plans import chain, gold, reports, rollup, serving, silver
from railyard.rails import ACH, RAILS
from railyard.session import shared_dir
from railyard.sources import documents, jdbc, tables

NOW = TS + dt.timedelta(hours=2)


def test_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.create_if_absent(spark, path, contracts.PIPELINE_METRICS) is True
    assert tables.create_if_absent(spark, path, contracts.PIPELINE_METRICS) is False
    assert spark.read.parquet(path).schema == contracts.PIPELINE_METRICS


def test_append_and_full_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in (DAY, DAY + dt.timedelta(days=1)):
        tables.append_rows(bronze(spark, "ach", {"settlement_date": day}), path, ["settlement_date"])
    assert spark.read.parquet(path).count() == 2
    tables.full_refresh(bronze(spark, "ach"), path, "settlement_date")
    assert [r.settlement_date for r in spark.read.parquet(path).collect()] == [DAY]


def test_value_beyond_the_contract_raises(spark):
    rows = spark.range(1).select(F.lit(Decimal("1e20")).cast("decimal(38,2)").alias("total_amount_egp"))
    wide = contracts.SERVING["daily_txn_volume"]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        contracts.conform(rows, type(wide)([wide["total_amount_egp"]])).collect()


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4000).selectExpr("id", "date_add(DATE '2024-01-01', int(id % 3)) AS d").withColumn(
        "d", F.when(F.col("id") % 10 != 0, F.col("d")))
    rows.repartition(5, "id").write.partitionBy("d").parquet(path)
    before = as_dicts(spark.read.parquet(path), "id")
    assert {r.files for r in tables.file_layout(spark.read.parquet(path), "d").collect()} == {5}
    report = merge.compact(spark, path, "d")
    assert [r.files for r in report.collect()] == [1] * 4
    assert as_dicts(spark.read.parquet(path), "id") == before
    assert merge.compact(spark, path, "d").count() == 0  # nothing is due any more
    bigger = merge.compact(spark, path, "d", target_bytes=10**9)
    assert bigger.count() == 0


def test_large_partition_keeps_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).selectExpr("sha2(string(id), 256) AS k", "DATE '2024-01-01' AS d")
    rows.repartition(40).write.partitionBy("d").parquet(path)
    report = merge.compact(spark, path, "d", target_bytes=300_000).first()
    assert 1 < report.files <= report.wanted < 40
    assert spark.read.parquet(path).count() == 20_000


def test_file_layout_matches_the_disk(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(1000).repartition(3).write.parquet(str(path))
    files = [p for p in path.iterdir() if p.suffix == ".parquet"]
    row = tables.file_layout(spark.read.parquet(str(path))).first()
    assert (row.files, row.bytes, row.row_count) == (3, sum(p.stat().st_size for p in files), 1000)


def test_time_ranges_cover_every_row_once(spark):
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = spark.range(-5, 40).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, int(id)) AS ts")
    rows = rows.unionByName(spark.range(99, 100).selectExpr("id", "CAST(NULL AS TIMESTAMP_NTZ) AS ts"))
    for parts in (1, 2, 5):
        ranges = jdbc.time_ranges("ts", start, end, parts)
        assert len(ranges) == parts
        found = [r.id for p in ranges for r in rows.filter(p).collect()]
        assert sorted(found) == sorted(r.id for r in rows.collect())
    with pytest.raises(ValueError, match="at least one part"):
        jdbc.time_ranges("ts", end, start, 2)


def test_snapshot_precedes_changes(spark):
    from railyard.operators.changelog import latest_state

    snapshot = jdbc.snapshot_as_changes(bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b"}))
    changes = bronze(spark, "ach", {"txn_id": "a", "batch_id": "new"}).selectExpr("*", "'u' AS op", "1L AS seq")
    got = {r.txn_id: r.batch_id for r in latest_state(snapshot.unionByName(changes), ACH.keys).collect()}
    assert got == {"a": "new", "b": "b1"}


def test_documents_of_varying_shape(spark):
    docs = spark.createDataFrame(
        [('{"_id":"1","amount_egp":12.5,"event_ts":"2024-03-10T12:00:00Z","merchant_id":"M"}',),
         ('{"_id":"2","event_ts":"2024-03-10T12:00:00.123Z","nested":{"a":1}}',)], "doc string")
    rows = as_dicts(documents.project_documents(docs, "doc"), "_id")
    assert [(r["_id"], r["amount_egp"], r["wallet_id"]) for r in rows] == [("1", Decimal("12.50"), None), ("2", None, None)]
    assert rows[1]["event_ts"] is not None
    kinds = {(r.field, r.type): r.documents for r in documents.document_fields(docs, "doc").collect()}
    assert kinds == {("_id", "STRING"): 2, ("amount_egp", "DECIMAL"): 1, ("event_ts", "STRING"): 2,
                     ("merchant_id", "STRING"): 1, ("nested", "OBJECT"): 1}
    assert "merchant_id: STRING" in documents.document_schema(docs, "doc").first()[0]


def test_card_lookup_reads_few_rows_of_the_sorted_layout(spark, tmp_path):
    path = str(tmp_path / "atm")
    rows = bronze(spark, "atm", *[{"card_token": f"tok{i % 7}", "session_id": str(i)} for i in range(70)])
    reports.lookup_layout(rows).write.parquet(path)
    found = reports.card_sessions(spark.read.parquet(path), "tok3", DAY, DAY)
    assert found.count() == 10
    pushed = found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    assert "EqualTo(card_token,tok3)" in pushed and "session_date" in pushed


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def run(spark, rows, root, at, run_id="r1", **options):
    report = chain.run_chain(spark, rows, root, at, run_id, **options)
    return {r.table_name: r.row_count for r in report.collect()}


def test_chain_end_to_end_and_next_hour(spark, tmp_path):
    root = str(tmp_path)
    first = all_bronze(spark, ach=[{"txn_id": "a"}, {"txn_id": "old", "created_at": TS - dt.timedelta(hours=3)}])
    counts = run(spark, first, root, NOW)
    assert counts["stg_ach_transactions"] == 2 and counts["mart_daily_txn_volume"] == counts["daily_txn_volume"] == 5

    later = TS + dt.timedelta(hours=1)
    changed = [
        {"txn_id": "a", "txn_status": "FAILED", "created_at": later},
        {"txn_id": "b", "created_at": later},
        {"txn_id": "old", "txn_status": "FAILED", "created_at": TS - dt.timedelta(hours=3)},  # older than the back window
    ]
    second = all_bronze(spark, ach=changed)
    counts = run(spark, second, root, NOW, "r2")
    assert counts["stg_ach_transactions"] == 3
    status = {r.txn_id: r.txn_status for r in silver.read_silver(spark, ACH, root).collect()}
    assert status == {"a": "FAILED", "b": "SETTLED", "old": "SETTLED"}

    volume = tables.read_table(spark, root, "serving", "daily_txn_volume")
    gold_mart = tables.read_table(spark, root, "gold", "mart_daily_txn_volume")
    keys = serving.DAILY_VOLUME.keys
    assert audit.reconcile_keys(gold_mart, volume, keys, "txn_count", "report_date", NOW.date()).count() == 0
    assert audit.reconcile_values(gold_mart, volume, keys, "txn_count").count() == 0
    metrics = tables.read_table(spark, root, "serving", "pipeline_metrics")
    assert {r.run_id for r in metrics.collect()} == {"r1", "r2"} and metrics.count() == 10

    silver.load_silver(ACH, second["ach"], root, full_refresh=True)  # the repair path
    status = {r.txn_id: r.txn_status for r in silver.read_silver(spark, ACH, root).collect()}
    assert status["old"] == "FAILED"


def test_stale_bronze_stops_the_chain_before_any_write(spark, tmp_path):
    with pytest.raises(chain.ChainStopped, match="ach_transactions: STALE"):
        run(spark, all_bronze(spark), str(tmp_path), TS + dt.timedelta(hours=7))
    assert not (tmp_path / "silver").exists()


def test_failing_test_stops_gold(spark, tmp_path):
    rows = all_bronze(spark, ach=[{"txn_status": "LOST"}])
    with pytest.raises(chain.ChainStopped, match="txn_status accepted_values: 1"):
        run(spark, rows, str(tmp_path), NOW)
    assert (tmp_path / "silver").exists() and not (tmp_path / "gold").exists()
    assert run(spark, rows, str(tmp_path), NOW, "r2", block_on_tests=False)["mart_daily_txn_volume"] == 5


def test_every_rail_declares_its_silver_table():
    assert [r.silver_table for r in RAILS.values()] == [
        "stg_ach_transactions", "stg_meeza_authorisations", "stg_ipn_transactions", "stg_meeza_digital_wallet",
        "stg_atm_sessions",
    ]


def marts_of(spark, root) -> dict[str, list[dict]]:
    names = {t.mart: t.keys for t in serving.TABLES}
    return {
        n: as_dicts(tables.read_table(spark, root, "gold", n).drop("_gold_loaded_at"), *keys) for n, keys in names.items()
    }


def full_marts(spark, root) -> dict[str, list[dict]]:
    rows = {n: silver.read_silver(spark, r, root) for n, r in RAILS.items()}
    built = {
        "mart_daily_txn_volume": gold.daily_volume(gold.all_rails(rows)),
        "mart_scheme_performance": gold.scheme_performance(rows),
        "mart_settlement_summary": gold.settlement_summary(rows["ach"]),
    }
    return {
        t.mart: as_dicts(built[t.mart].withColumn("report_month", F.trunc(t.date, "month")), *t.keys) for t in serving.TABLES
    }


def test_incremental_rollups_equal_a_full_rebuild(spark, tmp_path):
    """Second load: a row moves to another day, empties its old one, and changes its settlement date."""
    root = str(tmp_path)
    day = dt.timedelta(days=1)
    first = [{"txn_id": "a", "created_at": TS - day}, {"txn_id": "b"}, {"txn_id": "c", "settlement_date": DAY - day}]
    run(spark, all_bronze(spark, ach=first), root, NOW, block_on_tests=False)
    assert marts_of(spark, root) == full_marts(spark, root)
    second = [
        {"txn_id": "a", "created_at": TS + dt.timedelta(hours=1), "txn_status": "FAILED", "settlement_date": DAY + day},
        {"txn_id": "d", "created_at": TS + dt.timedelta(hours=1), "settlement_date": None},
    ]
    run(spark, all_bronze(spark, ach=first + second), root, NOW, "r2", block_on_tests=False)
    assert marts_of(spark, root) == full_marts(spark, root)
    assert not (tmp_path / "silver" / rollup.NOTES).exists()


def test_run_broken_off_before_gold_is_caught_up(spark, tmp_path):
    root = str(tmp_path)
    run(spark, all_bronze(spark), root, NOW)
    changed = all_bronze(spark, ach=[{"txn_id": "z", "txn_status": "FAILED"}])
    silver.load_silver(ACH, changed["ach"], root, before_change=partial(rollup.note_changes, spark, root, ACH))
    assert marts_of(spark, root) != full_marts(spark, root)  # silver is ahead
    chain.build_gold(spark, root, list(RAILS.values()))
    assert marts_of(spark, root) == full_marts(spark, root)
    silver.load_silver(
        ACH, changed["ach"], root, full_refresh=True, before_change=partial(rollup.note_changes, spark, root, ACH)
    )
    chain.build_gold(spark, root, list(RAILS.values()))
    assert marts_of(spark, root) == full_marts(spark, root)


def test_mart_without_rows(spark, tmp_path):
    """No transfer has a settlement date: the settlement mart and its copy are empty, the rest is built."""
    rows = all_bronze(spark, ach=[{"settlement_date": None}])
    counts = run(spark, rows, str(tmp_path), NOW, block_on_tests=False)
    assert (counts["mart_settlement_summary"], counts["settlement_summary"]) == (0, 0)
    assert counts["mart_daily_txn_volume"] == counts["daily_txn_volume"] == 4


def test_load_that_broke_off_after_the_newest_day(spark, tmp_path):
    """Of three new days only the newest is in place; the noted mark lets the next load bring the others."""
    root = str(tmp_path)
    day = dt.timedelta(days=1)
    first = all_bronze(spark, ach=[{"txn_id": "a"}])["ach"]
    silver.load_silver(ACH, first, root)
    column = ACH.event_time
    start = first.first()[column]
    rows = [{"txn_id": "a"}, {"txn_id": "b", column: start + day}, {"txn_id": "c", column: start + 4 * day}]
    bronze = all_bronze(spark, ach=rows)["ach"]
    path = tables.table_path(root, "silver", ACH.silver_table)
    tables.note_mark(spark, path, start)
    newest = silver.with_event_day(ACH, contracts.stamped(silver.silver(ACH, bronze.filter("txn_id = 'c'")), "silver"))
    newest.write.mode("append").partitionBy(silver.EVENT_DAY).parquet(path)
    silver.load_silver(ACH, bronze, root)
    assert sorted(r.txn_id for r in silver.read_silver(spark, ACH, root).collect()) == ["a", "b", "c"]
    assert tables.pending_mark(spark, path) is None


def test_nothing_is_loaded_without_ansi(spark, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            silver.load_silver(ACH, all_bronze(spark)["ach"], str(tmp_path))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
