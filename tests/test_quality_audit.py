"""Column tests, freshness, audits, telemetry, profile and lineage: each with a failing fixture."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from rows import TS, as_dicts, bronze

from railyard.checks import CHECKS
from railyard.operators import audit, freshness, lineage, profile, quality
from railyard.operators.quality import Check, accepted_range, accepted_values, not_null, unique

NOW = dt.datetime(2024, 3, 11, 12, 0, 0)


def violations(df, *checks: Check) -> list[int]:
    return [r.violations for r in quality.check_table(df, "t", checks).collect()]


def test_each_rule_finds_its_rows_and_null_passes_where_it_should(spark):
    df = spark.createDataFrame([(None, None), ("A", 0.0), ("B", 100.0), ("C", 100.5), ("C", -1.0)], "c string, n double")
    assert violations(df, *not_null("c", "n")) == [1, 1]
    assert violations(df, accepted_values("c", "A", "B")) == [2]
    assert violations(df, accepted_range("n", 0, 100)) == [2]
    assert violations(df, accepted_range("n", 0, inclusive=False)) == [2]
    assert violations(df, unique("c")) == [1]


def test_row_rules_of_a_table_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    bronze(spark, "meeza").write.parquet(path)
    df = spark.read.parquet(path)
    result = quality.check_table(df, "t", (*not_null("auth_id", "channel"), accepted_values("channel", "POS")))
    assert result._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_only_blocking_failures_block(spark):
    df = spark.createDataFrame([(None,)], "c string")
    checks = {"t": (*not_null("c"),), "u": (Check("c", "not_null", severity=quality.WARN),)}
    result = quality.check_tables({"t": df, "u": df}, checks)
    assert [r.table_name for r in quality.blocking(result).collect()] == ["t"]


def test_number_of_declared_checks():
    kinds = [c.kind for checks in CHECKS.values() for c in checks]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 52, "unique": 4, "accepted_values": 8, "accepted_range": 14,
    }


@pytest.mark.parametrize(
    ("lag", "status", "outcome"),
    [
        (dt.timedelta(hours=6), "FRESH", "pass"),
        (dt.timedelta(hours=6, seconds=1), "STALE", "fail"),
        (dt.timedelta(hours=24), "STALE", "fail"),
        (dt.timedelta(hours=24, seconds=1), "HISTORICAL", "warn"),
        (dt.timedelta(hours=-1), "FRESH", "pass"),
    ],
)
def test_gate_limits(spark, lag, status, outcome):
    row = freshness.gate({"t": (bronze(spark, "ach", {"created_at": NOW - lag}), "created_at")}, NOW).first()
    assert (row.status, row.outcome, row.lag_hours) == (status, outcome, lag.total_seconds() / 3600)


def test_gate_fails_empty_and_undated_tables(spark):
    tables = {"empty": (bronze(spark, "ach", None), "created_at"), "undated": (bronze(spark, "ach", {"created_at": None}), "created_at")}
    got = {r.table_name: (r.status, r.outcome) for r in freshness.gate(tables, NOW).collect()}
    assert got == {"empty": ("EMPTY", "fail"), "undated": ("NULL_TIMESTAMP", "fail")}


def test_zoned_event_time_counts_in_utc(spark):
    row = freshness.gate({"w": (bronze(spark, "wallet"), "event_ts")}, TS + dt.timedelta(hours=3)).first()
    assert row.lag_hours == 3.0


def test_source_freshness_and_lag_report(spark):
    table = {"t": (bronze(spark, "ach", {"created_at": NOW - dt.timedelta(hours=2, seconds=1)}), "created_at")}
    assert freshness.source_freshness(table, NOW).first().status == "warn"
    assert freshness.source_freshness(table, NOW + dt.timedelta(days=1)).first().status == "error"
    assert freshness.source_freshness(table, NOW - dt.timedelta(seconds=1)).first().status == "pass"
    assert freshness.lag_minutes(table, NOW).first().lag_min == 7201 / 60


def test_conservation_fires_after_deletes(spark):
    two, one = bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b"}), bronze(spark, "ach", {"txn_id": "a"})
    assert as_dicts(audit.conservation({"bad": (one, two), "good": (two, two), "fewer": (two, one)})) == [
        {"pair_name": "bad", "bronze_count": 1, "silver_count": 2}
    ]
    assert [r.txn_id for r in audit.orphan_keys(two, one, ["txn_id"], ["txn_id"]).collect()] == ["b"]


def mart(spark, *rows):
    return spark.createDataFrame(list(rows), "report_date date, scheme string, txn_count bigint")


def test_reconciliation_both_directions_and_values(spark):
    today, keys = NOW.date(), ["report_date", "scheme"]
    gold = mart(spark, (today, "A", 1), (today, "B", 2), (today - dt.timedelta(days=8), "A", 1))
    copy = mart(spark, (today, "A", 9), (today, "C", 3))
    got = as_dicts(audit.reconcile_keys(gold, copy, keys, "txn_count", "report_date", today), "direction")
    assert [(r["direction"], r["scheme"], r["gold_value"], r["serving_value"]) for r in got] == [
        ("gold_minus_serving", "B", 2, None), ("serving_minus_gold", "C", None, 3),
    ]
    assert as_dicts(audit.reconcile_values(gold, copy, keys, "txn_count")) == [
        {"report_date": today, "scheme": "A", "gold_value": 1, "serving_value": 9}
    ]
    assert audit.reconcile_keys(gold, gold, keys, "txn_count", "report_date", today).count() == 0


def test_stamps_partitions_and_empty_tables(spark):
    rows = spark.createDataFrame([(None,), (NOW,)], "stamp timestamp_ntz")
    got = {r.table_name: r.unstamped_rows for r in audit.stamp_coverage({"has": (rows, "stamp"), "lacks": (rows, "other")}).collect()}
    assert got == {"has": 1, "lacks": 2}
    empty = mart(spark).limit(0)
    presence = audit.partition_presence({"m": (mart(spark, (NOW.date(), "A", 1)), "report_date"), "e": (empty, "report_date")})
    assert {r.table_name: (r.partition_count, r.is_issue) for r in presence.collect()} == {"m": (1, False), "e": (0, True)}
    assert [r.table_name for r in audit.empty_tables({"m": mart(spark, (NOW.date(), "A", 1)), "e": empty}).collect()] == ["e"]


@pytest.mark.parametrize(("age", "listed"), [(dt.timedelta(hours=4, minutes=59), False), (dt.timedelta(hours=5), True)])
def test_write_age_counts_whole_hours(spark, age, listed):
    rows = spark.createDataFrame([(NOW - age,)], "ts timestamp_ntz")
    assert (audit.write_age({"t": (rows, "ts")}, NOW).count() == 1) is listed


def test_telemetry_and_drift(spark):
    one, two = bronze(spark, "ach"), bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b"})
    runs = audit.pipeline_metrics({"topic": (two, one)}, "r1", NOW.date(), NOW).unionByName(
        audit.pipeline_metrics({"topic": (two, two)}, "r2", NOW.date(), NOW + dt.timedelta(hours=1))
    )
    row = audit.drift_report(runs, NOW.date()).first()
    assert (row.bronze, row.silver, row.drift, row.last_run) == (2, 2, 0, NOW + dt.timedelta(hours=1))
    assert audit.drift_report(runs, NOW.date() + dt.timedelta(days=1)).count() == 0


def test_profile(spark):
    long_text = "x" * 200
    df = spark.createDataFrame([("a", 1), (None, 1), (long_text, None), (long_text, 2), (long_text + "y", 2)], "s string, n int")
    want = {"s": (5, 1, 3), "n": (5, 1, 2)}
    for exact in (True, False):
        got = {r.column_name: (r.row_count, r.null_count, r.distinct_count) for r in profile.profile(df, "t", exact).collect()}
        assert got == want
    nothing = profile.profile(df.limit(0), "t").collect()
    assert [(r.row_count, r.null_count, r.distinct_count) for r in nothing] == [(0, 0, 0)] * 2


def lineage_frame(spark, *events):
    rows = [(json.dumps(e), NOW + dt.timedelta(seconds=i)) for i, e in enumerate(events)]
    return lineage.parse_events(spark.createDataFrame(rows, "value string, at timestamp_ntz"))


def dataset(namespace, name):
    return {"namespace": namespace, "name": name}


def test_lineage_edges(spark):
    event = {
        "eventType": "COMPLETE", "run": {"runId": "r"},
        "inputs": [dataset("kafka://b", "x.y"), dataset("postgresql://db", "p")],
        "outputs": [dataset("iceberg://c", "a.b.c"), {"name": "z"}],
    }
    skipped = [event | {"eventType": t} for t in ("START", "FAIL")] + [event | {"inputs": []}, {"eventType": "COMPLETE"}]
    got = {(r.downstream, r.upstream) for r in lineage.edges(lineage_frame(spark, event, *skipped)).collect()}

    def urn(platform, name):
        return f"urn:li:dataset:(urn:li:dataPlatform:{platform},{name},PROD)"

    downs, ups = (urn("iceberg", "a/b/c"), urn("clickhouse", "z")), (urn("kafka", "x/y"), urn("postgres", "p"))
    assert got == {(d, u) for d in downs for u in ups}


def test_run_status(spark):
    def ev(kind, run):
        return {"eventType": kind, "run": {"runId": run}}

    frame = lineage_frame(
        spark, ev("START", "a"), ev("COMPLETE", "a"), ev("COMPLETE", "b"), ev("FAIL", "b"), ev("START", "c"), ev("ABORT", "d"),
        ev("START", ""), {"eventType": "START"},
    )
    got = {r.run_id: r.run_state for r in lineage.run_status(frame, ["at"]).collect()}
    assert got == {"a": "COMPLETE", "b": "FAILED", "c": "STARTED", "d": "COMPLETE"}
