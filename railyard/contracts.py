"""Table contracts: the columns and types of every layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "moment": T.TimestampNTZType(),
    "instant": T.TimestampType(),
    "money": T.DecimalType(18, 2),
    "wide_money": T.DecimalType(38, 2),
    "pct2": T.DecimalType(6, 2),
    "pct3": T.DecimalType(6, 3),
}


def contract(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Column names, order and types of the bronze tables.
BRONZE = {
    "ach_transactions": contract(
        txn_id="string", batch_id="string", txn_type="string", originating_bank_id="string",
        receiving_bank_id="string", originator_account="string", receiver_account="string", amount_egp="money",
        currency_code="string", txn_status="string", created_at="moment", settlement_date="date",
    ),
    "meeza_authorisations": contract(
        auth_id="string", card_token="string", merchant_id="string", merchant_category="string",
        terminal_id="string", txn_type="string", channel="string", amount_egp="money", currency_code="string",
        response_code="string", auth_status="string", issuing_bank_id="string", acquiring_bank_id="string",
        is_international="boolean", auth_timestamp="moment", settlement_date="date",
    ),
    "ipn_transactions": contract(
        txn_id="string", payment_ref="string", sender_proxy="string", receiver_proxy="string",
        sender_bank_id="string", receiver_bank_id="string", amount_egp="double", payment_purpose="string",
        txn_status="string", failure_reason="string", initiation_channel="string", processing_time_ms="bigint",
        initiated_at="moment", completed_at="moment",
    ),
    "meeza_digital_wallet_events": contract(
        _id="string", wallet_id="string", event_type="string", channel="string", issuing_bank_id="string",
        amount_egp="money", status="string", event_ts="instant",
    ),
    "atm_sessions": contract(
        atm_id="string", session_date="date", session_id="string", session_ts="moment", card_token="string",
        issuing_bank_id="string", txn_type="string", amount_egp="money", currency_code="string",
        response_code="string", status="string", atm_location="string", governorate="string", network_id="string",
        processing_ms="int", error_code="string", created_at="moment", updated_at="moment",
    ),
}

# The published marts and the operational tables.
DAILY_VOLUME = contract(
    report_date="date", scheme="string", txn_count="bigint", total_amount_egp="wide_money",
    approved_count="bigint", failed_count="bigint", avg_txn_amount_egp="wide_money",
)
SCHEME_PERFORMANCE = contract(
    report_date="date", scheme="string", channel="string", txn_volume="bigint", approval_rate_pct="pct3",
    avg_processing_ms="double",
)
SETTLEMENT_SUMMARY = contract(
    settlement_date="date", originating_bank_id="string", receiving_bank_id="string", settled_count="bigint",
    failed_count="bigint", returned_count="bigint", net_settled_egp="wide_money", failed_amount_egp="wide_money",
    settlement_rate_pct="pct2",
)
SERVING = {
    "daily_txn_volume": contract(
        report_date="date", scheme="string", txn_count="bigint", total_amount_egp="money",
        approved_count="bigint", failed_count="bigint", avg_txn_amount_egp="money",
    ),
    "scheme_performance": contract(
        report_date="date", scheme="string", channel="string", approval_rate_pct="pct3",
        avg_processing_ms="double", txn_volume="bigint",
    ),
    "settlement_summary": contract(
        settlement_date="date", originating_bank_id="string", receiving_bank_id="string", settled_count="bigint",
        failed_count="bigint", returned_count="bigint", net_settled_egp="money", failed_amount_egp="money",
        settlement_rate_pct="pct2",
    ),
}
PIPELINE_METRICS = contract(
    run_id="string", source_topic="string", kafka_offset="bigint", bronze_row_count="bigint",
    silver_row_count="bigint", sink_lag_seconds="double", batch_date="date", recorded_at="instant",
)
TIME_SPINE = contract(date_day="date")

# The load stamp each layer's writer adds.
LOAD_STAMP = {"silver": "_silver_loaded_at", "gold": "_gold_loaded_at", "serving": "refreshed_at"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a contract. A value that does not fit its declared type raises; it is never dropped."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stamped(df: DataFrame, layer: str, at: dt.datetime | None = None) -> DataFrame:
    """Add the layer's load stamp (UTC, now by default); done only when a table is written."""
    now = F.current_timestamp() if at is None else F.lit(str(at)).cast("timestamp_ntz").cast("timestamp")
    return df.withColumn(LOAD_STAMP[layer], now)
