"""Silver rules on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows import DAY, TS, as_dicts, bronze

from railyard.functions.cleanse import hash_pii
from railyard.operators import incremental
from railyard.plans.silver import silver, silver_increment
from railyard.rails import ACH, ATM, IPN, MEEZA, RAILS, WALLET, met_sla


def one(df) -> dict:
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_codes_are_trimmed_and_upper(spark):
    row = one(silver(ACH, bronze(spark, "ach", {"txn_status": " \tsettled\n ", "txn_type": "credit ", "originating_bank_id": " aaa"})))
    assert (row["txn_status"], row["txn_type"], row["originating_bank_id"]) == ("SETTLED", "CREDIT", "AAA")


def test_nulls_get_their_defaults(spark):
    ach = one(silver(ACH, bronze(spark, "ach", {"amount_egp": None, "currency_code": None, "txn_status": None})))
    assert (ach["amount_egp"], ach["currency_code"], ach["txn_status"]) == (Decimal("0.00"), "EGP", None)
    blank = {f: None for f in ("sender_proxy", "receiver_bank_id", "payment_purpose", "txn_status", "initiation_channel", "amount_egp")}
    ipn = one(silver(IPN, bronze(spark, "ipn", blank)))
    assert [ipn[f] for f in blank] == ["UNKNOWN", "", "P2P", "UNKNOWN", "UNKNOWN", 0.0]
    blank = {f.name: None for f in ATM.bronze_schema.fields}
    atm = one(silver(ATM, bronze(spark, "atm", blank)))
    epoch = dt.datetime(1970, 1, 1)
    assert atm == {
        "atm_id": "UNKNOWN", "session_id": "UNKNOWN", "session_date": epoch.date(), "session_timestamp": epoch,
        "card_token": "UNKNOWN", "issuing_bank_id": "UNKNOWN", "txn_type": "UNKNOWN", "amount_egp": Decimal("0.00"),
        "currency_code": "EGP", "response_code": "UNKNOWN", "txn_status": "UNKNOWN", "processing_ms": 0,
        "created_ts": epoch, "updated_ts": epoch,
    }
    wallet = one(silver(WALLET, bronze(spark, "wallet", {"wallet_id": None, "channel": None, "status": None})))
    assert (wallet["wallet_id"], wallet["channel"], wallet["txn_status"]) == ("N/A", None, None)


def test_latest_version_wins_and_null_time_loses(spark):
    rows = bronze(
        spark, "ach",
        {"created_at": TS, "batch_id": "old"},
        {"created_at": TS + dt.timedelta(seconds=1), "batch_id": "new"},
        {"created_at": None, "batch_id": "undated"},
    )
    assert one(silver(ACH, rows))["batch_id"] == "new"


def test_equal_times_are_decided_by_the_other_columns(spark):
    a, b = {"batch_id": "a"}, {"batch_id": "b"}
    for order in ((a, b), (b, a)):
        assert one(silver(ACH, bronze(spark, "ach", *order)))["batch_id"] == "b"


def test_null_key_is_dropped_except_for_atm(spark):
    assert silver(ACH, bronze(spark, "ach", {"txn_id": None})).count() == 0
    assert silver(MEEZA, bronze(spark, "meeza", {"auth_id": None})).count() == 0
    assert silver(WALLET, bronze(spark, "wallet", {"_id": None})).count() == 0
    rows = bronze(spark, "atm", {"atm_id": None}, {"atm_id": None, "updated_at": TS + dt.timedelta(hours=1)})
    assert one(silver(ATM, rows))["updated_ts"] == TS + dt.timedelta(hours=1)


def test_completed_version_beats_a_newer_incomplete_one(spark):
    rows = bronze(
        spark, "ipn",
        {"completed_at": TS, "payment_ref": "done"},
        {"completed_at": None, "initiated_at": TS + dt.timedelta(hours=5), "payment_ref": "open"},
    )
    assert one(silver(IPN, rows))["payment_ref"] == "done"


def test_incomplete_payment_takes_its_start_as_end(spark):
    assert one(silver(IPN, bronze(spark, "ipn", {"completed_at": None})))["completed_at"] == TS


@pytest.mark.parametrize(
    ("status", "code", "approved"),
    [("APPROVED", "05", True), ("DECLINED", "00", True), ("REVERSED", "00", True), (None, "00", True),
     (None, "05", None), ("DECLINED", None, None), ("DECLINED", "05", False)],
)
def test_approval_is_three_valued(spark, status, code, approved):
    rows = bronze(spark, "meeza", {"auth_status": status, "response_code": code})
    assert one(silver(MEEZA, rows))["is_approved"] is approved


@pytest.mark.parametrize(("millis", "met"), [(2000, True), (2001, False), (None, True)])
def test_sla_limit(spark, millis, met):
    assert one(silver(IPN, bronze(spark, "ipn", {"processing_time_ms": millis})))["met_sla"] is met


def test_sla_limit_is_a_parameter(spark):
    rows = bronze(spark, "ipn", {"processing_time_ms": 9000})
    assert rows.select(met_sla(10_000)).first()[0] is True


def test_settlement_date_falls_back_to_the_authorisation(spark):
    assert one(silver(MEEZA, bronze(spark, "meeza", {"settlement_date": None})))["settlement_date"] == DAY


def test_atm_session_on_two_days_is_one_silver_row(spark):
    rows = bronze(
        spark, "atm", {"session_date": DAY}, {"session_date": DAY + dt.timedelta(days=1), "updated_at": TS + dt.timedelta(days=1)}
    )
    assert one(silver(ATM, rows))["session_date"] == DAY + dt.timedelta(days=1)


def test_back_window_is_strict(spark):
    target = silver(ACH, bronze(spark, "ach", {"txn_id": "t0", "created_at": TS}))
    edge = TS - dt.timedelta(hours=1)
    rows = bronze(
        spark, "ach",
        {"txn_id": "at", "created_at": edge},
        {"txn_id": "after", "created_at": edge + dt.timedelta(microseconds=1)},
        {"txn_id": "before", "created_at": edge - dt.timedelta(days=1)},
    )
    assert [r.txn_id for r in silver_increment(ACH, rows, target).collect()] == ["after"]


def test_empty_target_counts_as_the_epoch(spark):
    empty = silver(ACH, bronze(spark, "ach", None))
    rows = bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b", "created_at": dt.datetime(1969, 1, 1)})
    assert [r.txn_id for r in silver_increment(ACH, rows, empty).collect()] == ["a"]


def test_strict_filter(spark):
    rows = bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b", "created_at": TS + dt.timedelta(seconds=1)})
    assert [r.txn_id for r in incremental.strictly_since(rows, "created_at", TS).collect()] == ["b"]
    assert incremental.strictly_since(rows, "created_at", None).count() == 0
    assert incremental.strictly_since(rows, "created_at", None, full_refresh=True).count() == 2


def test_hash_is_upper_hex_and_keeps_null(spark):
    rows = spark.createDataFrame([("abc",), (None,)], "v string").select(hash_pii(F.col("v")).alias("h"))
    assert as_dicts(rows) == [
        {"h": "BA7816BF8F01CFEA414140DE5DAE2223B00361A396177A9CB410FF61F20015AD"},
        {"h": None},
    ]


def test_back_window_reaches_the_parquet_scan(spark, tmp_path):
    for rail in RAILS.values():
        path = str(tmp_path / rail.name)
        bronze(spark, rail.name).write.parquet(path)
        rows = incremental.since_high_water(spark.read.parquet(path), rail.event_time, TS)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThan({rail.event_time}" in plan.split("PushedFilters")[1], rail.name
