"""Marts and their published copies on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from rows import DAY, TS, all_bronze, as_dicts, bronze

from railyard.plans import gold, serving
from railyard.plans.silver import silver
from railyard.rails import RAILS

PAIR = {"originating_bank_id": "AAA", "receiving_bank_id": "BBB"}


def silvers(spark, **changes):
    return {n: silver(RAILS[n], df) for n, df in all_bronze(spark, **changes).items()}


def test_every_rail_counts_its_own_statuses(spark):
    rows = silvers(
        spark,
        ach=[{"txn_id": s, "txn_status": s} for s in ("SETTLED", "FAILED", "RETURNED", "PENDING")],
        meeza=[
            {"auth_id": "1", "auth_status": "REVERSED", "response_code": "00"},
            {"auth_id": "2", "auth_status": None, "response_code": "05"},
            {"auth_id": "3", "auth_status": "DECLINED", "response_code": "51"},
        ],
        ipn=[{"txn_id": s, "txn_status": s} for s in ("COMPLETED", "FAILED", "REVERSED", "PROCESSING")],
        wallet=[{"_id": s, "status": s} for s in ("COMPLETED", "FAILED", "REJECTED", "PENDING")],
        atm=[{"session_id": s, "status": s} for s in ("APPROVED", "FAILED", "DECLINED", "REJECTED", "OPEN")],
    )
    got = {r.scheme: (r.txn_count, r.approved_count, r.failed_count) for r in gold.daily_volume(gold.all_rails(rows)).collect()}
    assert got == {
        "EG-ACH": (4, 1, 2), "MEEZA": (3, 1, 1), "IPN-INSTAPAY": (4, 1, 2), "MEEZA-DIGITAL": (4, 1, 2),
        "123-ATM-NETWORK": (5, 1, 3),
    }


def test_rows_without_report_date_are_left_out(spark):
    rows = silvers(spark, ach=[{"txn_id": "a", "settlement_date": None}])
    assert "EG-ACH" not in {r.scheme for r in gold.daily_volume(gold.all_rails(rows)).collect()}


def test_average_and_sum(spark):
    rows = silvers(spark, ipn=[{"txn_id": str(i), "amount_egp": a} for i, a in enumerate((0.1, 0.2, 0.4))])
    mart = gold.daily_volume(gold.all_rails(rows)).filter("scheme = 'IPN-INSTAPAY'").first()
    assert (mart.total_amount_egp, mart.avg_txn_amount_egp) == (Decimal("0.70"), Decimal("0.23"))


def test_both_marts_from_one_rollup(spark):
    rows = silvers(
        spark,
        ipn=[{"txn_id": str(i), "initiation_channel": c, "processing_time_ms": i} for i, c in enumerate(["A", "A", "B", None])],
    )
    rollup = gold.channel_rollup(gold.all_rails(rows))
    assert as_dicts(gold.daily_volume_from_rollup(rollup)) == as_dicts(gold.daily_volume(gold.all_rails(rows)))
    direct = gold.scheme_performance(rows)
    assert as_dicts(gold.scheme_performance_from_rollup(rollup)) == as_dicts(direct)
    ipn = {r.channel: (r.txn_volume, r.avg_processing_ms) for r in direct.filter("scheme = 'IPN-INSTAPAY'").collect()}
    assert ipn == {"A": (2, 1.0), "B": (1, 2.0), "UNKNOWN": (1, 3.0)}
    assert direct.filter("scheme = 'EG-ACH'").count() == 0
    assert [r.channel for r in direct.filter("scheme = '123-ATM-NETWORK'").collect()] == ["ATM_TERMINAL"]


@pytest.mark.parametrize(("scale", "rate"), [(None, "66.667"), (1, "66.700")])
def test_rate_scale(spark, scale, rate):
    rows = silvers(spark, atm=[{"session_id": str(i), "status": s} for i, s in enumerate(("APPROVED", "APPROVED", "FAILED"))])
    mart = gold.scheme_performance(rows, scale).filter("scheme = '123-ATM-NETWORK'").first()
    assert mart.approval_rate_pct == Decimal(rate)


def test_settlement_sums_stay_null_without_rows(spark):
    rows = bronze(
        spark, "ach",
        {"txn_id": "1", "txn_status": "PENDING"},
        {"txn_id": "2", "txn_status": "FAILED", "receiving_bank_id": "CCC"},
        {"txn_id": "3", "txn_status": "SETTLED", "receiving_bank_id": "CCC"},
        {"txn_id": "4", "txn_status": "RETURNED", "receiving_bank_id": "CCC"},
    )
    got = {r.receiving_bank_id: r for r in gold.settlement_summary(silver(RAILS["ach"], rows)).collect()}
    pending, mixed = got["BBB"], got["CCC"]
    assert (pending.net_settled_egp, pending.failed_amount_egp, pending.settlement_rate_pct) == (None, None, Decimal("0.00"))
    assert (mixed.settled_count, mixed.failed_count, mixed.returned_count) == (1, 1, 1)
    assert (mixed.net_settled_egp, mixed.settlement_rate_pct) == (Decimal("10.00"), Decimal("33.33"))


def volume(spark, *rows):
    return spark.createDataFrame(
        [(d, "MEEZA", n, Decimal(n), n, 0, Decimal(1)) for d, n in rows],
        "report_date date, scheme string, txn_count bigint, total_amount_egp decimal(38,2), approved_count bigint, "
        "failed_count bigint, avg_txn_amount_egp decimal(38,2)",
    )


def test_window_edges(spark):
    as_of = dt.date(2024, 3, 10)
    in_window, outside = as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=8)
    table = serving.DAILY_VOLUME
    first = serving.publish(table, volume(spark, (in_window, 1), (outside, 1)), None, as_of)
    second = serving.publish(table, volume(spark, (in_window, 2), (outside, 2), (as_of, 2)), first, as_of)
    assert {r.report_date: r.txn_count for r in second.collect()} == {in_window: 2, outside: 1, as_of: 2}
    assert dict(second.dtypes)["total_amount_egp"] == "decimal(18,2)"


def test_key_missing_from_gold_stays_in_serving(spark):
    table, as_of = serving.DAILY_VOLUME, dt.date(2024, 3, 10)
    first = serving.publish(table, volume(spark, (as_of, 1)), None, as_of)
    assert serving.publish(table, volume(spark).limit(0), first, as_of).count() == 1


def test_load_serving_twice(spark, tmp_path):
    root, table, as_of = str(tmp_path), serving.DAILY_VOLUME, dt.date(2024, 3, 10)
    old = as_of - dt.timedelta(days=40)
    serving.load_serving(table, volume(spark, (old, 1), (as_of, 1)), root, as_of)
    serving.load_serving(table, volume(spark, (old, 2), (as_of, 2)), root, as_of)
    rows = spark.read.parquet(f"{root}/serving/{table.name}").collect()
    assert {r.report_date: r.txn_count for r in rows} == {old: 1, as_of: 2}
    assert all(r.refreshed_at is not None and r.report_month.day == 1 for r in rows)


def test_healthy_rows_make_one_line_per_rail(spark):
    mart = gold.daily_volume(gold.all_rails(silvers(spark)))
    assert {r.scheme: r.report_date for r in mart.collect()} == dict.fromkeys(
        ("EG-ACH", "MEEZA", "IPN-INSTAPAY", "MEEZA-DIGITAL", "123-ATM-NETWORK"), DAY
    )
    assert TS.date() == DAY
