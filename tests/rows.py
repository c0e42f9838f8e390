"""Small literal bronze rows. Every helper starts from a healthy row and changes what a test names."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from railyard.rails import RAILS

TS = dt.datetime(2024, 3, 10, 12, 0, 0)
DAY = TS.date()

HEALTHY = {
    "ach": dict(
        txn_id="t1", batch_id="b1", txn_type="CREDIT", originating_bank_id="AAA", receiving_bank_id="BBB",
        originator_account="1", receiver_account="2", amount_egp=Decimal("10.00"), currency_code="EGP",
        txn_status="SETTLED", created_at=TS, settlement_date=DAY,
    ),
    "meeza": dict(
        auth_id="a1", card_token="tok", merchant_id="m", merchant_category="FUEL", terminal_id="t", txn_type="PURCHASE",
        channel="POS", amount_egp=Decimal("20.00"), currency_code="EGP", response_code="00", auth_status="APPROVED",
        issuing_bank_id="AAA", acquiring_bank_id="BBB", is_international=False, auth_timestamp=TS, settlement_date=DAY,
    ),
    "ipn": dict(
        txn_id="p1", payment_ref="r", sender_proxy="s", receiver_proxy="q", sender_bank_id="AAA", receiver_bank_id="BBB",
        amount_egp=30.0, payment_purpose="P2P", txn_status="COMPLETED", failure_reason=None,
        initiation_channel="USSD", processing_time_ms=500, initiated_at=TS, completed_at=TS,
    ),
    "wallet": dict(
        _id="w1", wallet_id="WLT1", event_type="TOP_UP", channel="USSD", issuing_bank_id="AAA",
        amount_egp=Decimal("40.00"), status="COMPLETED", event_ts=TS.replace(tzinfo=dt.timezone.utc),
    ),
    "atm": dict(
        atm_id="atm1", session_date=DAY, session_id="s1", session_ts=TS, card_token="tok", issuing_bank_id="AAA",
        txn_type="WITHDRAWAL", amount_egp=Decimal("50.00"), currency_code="EGP", response_code="00", status="APPROVED",
        atm_location="L", governorate="G", network_id="123", processing_ms=100, error_code=None, created_at=TS,
        updated_at=TS,
    ),
}


def bronze(spark, rail: str, *changes: dict):
    """One row per change set; no change sets give one healthy row, ``None`` gives an empty table."""
    schema = RAILS[rail].bronze_schema
    if changes == (None,):
        return spark.createDataFrame([], schema)
    rows = [HEALTHY[rail] | c for c in (changes or ({},))]
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


def all_bronze(spark, **changes):
    """Bronze rows of all rails; ``ach=[{...}]`` replaces one rail's rows."""
    return {name: bronze(spark, name, *changes.get(name, ({},))) for name in RAILS}


def as_dicts(df, *keys: str) -> list[dict]:
    return sorted((r.asDict() for r in df.collect()), key=lambda r: [str(r[k]) for k in (keys or df.columns)])
