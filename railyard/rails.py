"""The five payment rails, as data.

One ``Rail`` says how a rail is keyed, cleansed and counted. Every operator takes a rail (or plain column
names), so a sixth rail is one more entry here and no new code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard import contracts
from railyard.functions import cleanse as c


@dataclass(frozen=True)
class Field:
    """One silver column: a cleansing rule on a bronze column, then a default for NULL."""

    name: str
    rule: Callable[[Column], Column]
    source: str | None = None
    default: object = None

    def column(self) -> Column:
        cleaned = self.rule(F.col(self.source or self.name))
        if self.default is not None:
            cleaned = F.coalesce(cleaned, _literal(self.default))
        return cleaned.alias(self.name)


@dataclass(frozen=True)
class Derived:
    """One silver column computed from several bronze columns."""

    name: str
    build: Callable[[], Column]

    def column(self) -> Column:
        return self.build().alias(self.name)


@dataclass(frozen=True)
class Rail:
    name: str
    scheme: str
    topic: str
    bronze_table: str
    silver_table: str
    keys: tuple[str, ...]  # bronze primary key
    dedup_keys: tuple[str, ...]  # bronze columns that identify a silver row
    merge_keys: tuple[str, ...]  # the same columns under their silver names
    event_time: str  # bronze event-time column
    watermark: str
    high_water: str  # silver column holding the event time
    event_day: str  # silver date or timestamp column the table is partitioned by
    fields: tuple[Field | Derived, ...]
    report_date: str
    channel: Callable[[], Column]
    approved: Callable[[], Column]
    failed: Callable[[], Column]
    latency: str | None = None
    drop_null_key: bool = True
    prefer: tuple[str, ...] = ()  # a version with these bronze columns filled beats any without

    @property
    def bronze_schema(self) -> T.StructType:
        return contracts.BRONZE[self.bronze_table]

    @property
    def source_columns(self) -> list[str]:
        """Bronze columns silver reads; the rest never leave the scan."""
        return [f.name for f in self.bronze_schema.fields if f.name not in UNUSED_AT_SILVER.get(self.name, ())]


def _literal(value: object) -> Column:
    if value == EPOCH:
        return F.lit(EPOCH).cast("timestamp_ntz")
    if value == EPOCH_DAY:
        return F.lit(EPOCH_DAY).cast("date")
    return F.lit(value)


# ---- Fixed values -------------------------------------------------------------------------------------
# Scheme labels, code lists, defaults, thresholds and watermark delays that results depend on.
EPOCH = "1970-01-01 00:00:00"
EPOCH_DAY = "1970-01-01"
SCHEMES = ("EG-ACH", "MEEZA", "IPN-INSTAPAY", "MEEZA-DIGITAL", "123-ATM-NETWORK")
WATERMARKS = {
    "ach": "30 seconds",
    "meeza": "20 seconds",
    "ipn": "60 seconds",
    "wallet": "10 seconds",
    "atm": "5 minutes",
}
APPROVED_STATUS = {"ach": "SETTLED", "ipn": "COMPLETED", "wallet": "COMPLETED", "atm": "APPROVED"}
FAILED_STATUS = {
    "ach": ("FAILED", "RETURNED"),
    "ipn": ("FAILED", "REVERSED"),
    "wallet": ("FAILED", "REJECTED"),
    "atm": ("FAILED", "DECLINED", "REJECTED"),
}
APPROVED_AUTH_STATUS = "APPROVED"
APPROVED_RESPONSE_CODE = "00"
SLA_MILLIS = 2000
ATM_CHANNEL = "ATM_TERMINAL"
CURRENCY = "EGP"
UNKNOWN = "UNKNOWN"
UNUSED_AT_SILVER = {"atm": ("atm_location", "governorate", "network_id", "error_code")}
# -------------------------------------------------------------------------------------------------------


def _status_in(rail: str) -> dict[str, Callable[[], Column]]:
    return {
        "approved": lambda: F.col("txn_status") == APPROVED_STATUS[rail],
        "failed": lambda: F.col("txn_status").isin(*FAILED_STATUS[rail]),
    }


def is_approved() -> Column:
    """Approved by status or by response code. Three-valued: NULL when neither side decides."""
    by_status = c.code(F.col("auth_status")) == APPROVED_AUTH_STATUS
    by_code = c.text(F.col("response_code")) == APPROVED_RESPONSE_CODE
    return by_status | by_code


def met_sla(limit_millis: int = SLA_MILLIS) -> Column:
    return F.coalesce(c.whole(F.col("processing_time_ms")), F.lit(0)) <= limit_millis


ACH = Rail(
    name="ach",
    scheme=SCHEMES[0],
    topic="public.ach_transactions",
    bronze_table="ach_transactions",
    silver_table="stg_ach_transactions",
    keys=("txn_id",),
    dedup_keys=("txn_id",),
    merge_keys=("txn_id",),
    event_time="created_at",
    watermark=WATERMARKS["ach"],
    high_water="source_created_at",
    event_day="source_created_at",
    fields=(
        Field("txn_id", c.text),
        Field("batch_id", c.text),
        Field("txn_type", c.code),
        Field("originating_bank_id", c.code),
        Field("receiving_bank_id", c.code),
        Field("originator_account", c.text),
        Field("receiver_account", c.text),
        Field("amount_egp", c.money),
        Field("currency_code", c.text, default=CURRENCY),
        Field("txn_status", c.code),
        Field("source_created_at", c.moment, source="created_at"),
        Field("created_date", c.day, source="created_at"),
        Field("settlement_date", c.day),
    ),
    report_date="settlement_date",
    channel=lambda: F.lit(None).cast("string"),
    **_status_in("ach"),
)

MEEZA = Rail(
    name="meeza",
    scheme=SCHEMES[1],
    topic="public.meeza_authorisations",
    bronze_table="meeza_authorisations",
    silver_table="stg_meeza_authorisations",
    keys=("auth_id",),
    dedup_keys=("auth_id",),
    merge_keys=("auth_id",),
    event_time="auth_timestamp",
    watermark=WATERMARKS["meeza"],
    high_water="auth_timestamp",
    event_day="auth_timestamp",
    fields=(
        Field("auth_id", c.text),
        Field("card_token", c.text, default=""),
        Field("merchant_id", c.text, default=UNKNOWN),
        Field("merchant_category", c.text, default="OTHER"),
        Field("terminal_id", c.text, default=""),
        Field("txn_type", c.upper),
        Field("channel", c.code),
        Field("auth_status", c.code),
        Derived("is_approved", is_approved),
        Field("response_code", c.text),
        Field("amount_egp", c.money),
        Field("currency_code", c.text, default=CURRENCY),
        Field("issuing_bank_id", c.text),
        Field("acquiring_bank_id", c.text, default=""),
        Field("is_international", c.flag, default=False),
        Field("auth_timestamp", c.moment),
        Field("auth_date", c.day, source="auth_timestamp"),
        Derived("settlement_date", lambda: F.coalesce(F.col("settlement_date"), c.day(F.col("auth_timestamp")))),
    ),
    report_date="settlement_date",
    channel=lambda: F.col("channel"),
    approved=lambda: F.col("is_approved"),
    failed=lambda: ~F.col("is_approved"),
)

IPN = Rail(
    name="ipn",
    scheme=SCHEMES[2],
    topic="public.ipn_transactions",
    bronze_table="ipn_transactions",
    silver_table="stg_ipn_transactions",
    keys=("txn_id",),
    dedup_keys=("txn_id",),
    merge_keys=("txn_id",),
    event_time="initiated_at",
    watermark=WATERMARKS["ipn"],
    high_water="initiated_at",
    event_day="initiated_at",
    prefer=("completed_at",),
    fields=(
        Field("txn_id", c.text),
        Field("payment_ref", c.trimmed, default=""),
        Field("sender_proxy", c.text, default=UNKNOWN),
        Field("receiver_proxy", c.text, default=UNKNOWN),
        Field("sender_bank_id", c.code, default=""),
        Field("receiver_bank_id", c.code, default=""),
        Field("amount_egp", c.real, default=0.0),
        Field("payment_purpose", c.code, default="P2P"),
        Field("txn_status", c.code, default=UNKNOWN),
        Field("failure_reason", c.trimmed, default=""),
        Field("initiation_channel", c.code, default=UNKNOWN),
        Field("processing_time_ms", c.whole, default=0),
        Derived("met_sla", met_sla),
        Field("initiated_date", c.day, source="initiated_at"),
        Field("initiated_at", c.moment),
        Derived("completed_at", lambda: F.coalesce(c.moment(F.col("completed_at")), c.moment(F.col("initiated_at")))),
    ),
    report_date="initiated_date",
    channel=lambda: F.col("initiation_channel"),
    latency="processing_time_ms",
    **_status_in("ipn"),
)

WALLET = Rail(
    name="wallet",
    scheme=SCHEMES[3],
    topic="meeza_digital.wallet_events",
    bronze_table="meeza_digital_wallet_events",
    silver_table="stg_meeza_digital_wallet",
    keys=("_id",),
    dedup_keys=("_id",),
    merge_keys=("document_id",),
    event_time="event_ts",
    watermark=WATERMARKS["wallet"],
    high_water="event_timestamp",
    event_day="event_timestamp",
    fields=(
        Field("document_id", c.text, source="_id"),
        Field("wallet_id", c.text, default="N/A"),
        Field("txn_type", c.upper, source="event_type"),
        Field("channel", c.upper),
        Field("issuing_bank_id", c.text),
        Field("amount_egp", c.money),
        Field("txn_status", c.upper, source="status"),
        Field("event_timestamp", c.moment, source="event_ts"),
        Field("event_date", c.day, source="event_ts"),
    ),
    report_date="event_date",
    channel=lambda: F.col("channel"),
    **_status_in("wallet"),
)

ATM = Rail(
    name="atm",
    scheme=SCHEMES[4],
    topic="dbo.atm_sessions",
    bronze_table="atm_sessions",
    silver_table="stg_atm_sessions",
    keys=("atm_id", "session_date", "session_id"),
    dedup_keys=("atm_id", "session_id"),
    merge_keys=("atm_id", "session_id"),
    event_time="updated_at",
    watermark=WATERMARKS["atm"],
    high_water="updated_ts",
    event_day="session_date",
    drop_null_key=False,
    fields=(
        Field("atm_id", c.text, default=UNKNOWN),
        Field("session_id", c.text, default=UNKNOWN),
        Field("session_date", c.day, default=EPOCH_DAY),
        Field("session_timestamp", c.moment, source="session_ts", default=EPOCH),
        Field("card_token", c.text, default=UNKNOWN),
        Field("issuing_bank_id", c.text, default=UNKNOWN),
        Field("txn_type", c.upper, default=UNKNOWN),
        Field("amount_egp", c.money),
        Field("currency_code", c.text, default=CURRENCY),
        Field("response_code", c.text, default=UNKNOWN),
        Field("txn_status", c.upper, source="status", default=UNKNOWN),
        Field("processing_ms", c.whole, default=0),
        Field("created_ts", c.moment, source="created_at", default=EPOCH),
        Field("updated_ts", c.moment, source="updated_at", default=EPOCH),
    ),
    report_date="session_date",
    channel=lambda: F.lit(ATM_CHANNEL),
    latency="processing_ms",
    **_status_in("atm"),
)

RAILS: dict[str, Rail] = {r.name: r for r in (ACH, MEEZA, IPN, WALLET, ATM)}
