"""The published analytical queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railyard.functions.clock import as_date
from railyard.functions.measures import count_true, percent, round_half_up

# Window and list lengths of the reports.
WINDOW_DAYS = 7
TOP_POSITIONS, TOP_DAYS, TOP_PAIRS, SAMPLE_ROWS = 20, 21, 10, 10


def last_days(mart: DataFrame, as_of: str | dt.date, days: int = WINDOW_DAYS) -> DataFrame:
    """Executive overview: the mart's rows of the last days."""
    return mart.filter(F.col("report_date") >= F.date_sub(as_date(as_of), days))


def ipn_sla(ipn_silver: DataFrame) -> DataFrame:
    """Payments, mean latency and share within the SLA."""
    met = count_true(F.col("met_sla"))
    return ipn_silver.agg(
        F.count("*").alias("total_txns"),
        F.avg("processing_time_ms").alias("avg_ms"),
        met.alias("met"),
        percent(met, F.count("*"), 2).alias("pct"),
    )


def scheme_totals(serving_volume: DataFrame) -> DataFrame:
    return (
        serving_volume.groupBy("scheme")
        .agg(F.sum("txn_count").alias("total_txns"), F.sum("approved_count").alias("approved"))
        .orderBy("scheme")
    )


def recent_volume(serving_volume: DataFrame, as_of: str | dt.date, days: int = WINDOW_DAYS) -> DataFrame:
    return (
        last_days(serving_volume, as_of, days)
        .select("report_date", "scheme", "txn_count", "total_amount_egp")
        .orderBy(F.col("report_date").desc(), "scheme")
    )


def sessions_by_network(atm_bronze: DataFrame) -> DataFrame:
    """Sessions and approvals per network. Only bronze still has the network."""
    return atm_bronze.groupBy("network_id").agg(
        F.count("*").alias("sessions"), count_true(F.upper("status") == "APPROVED").alias("approved")
    )


def _by_net(mart: DataFrame, limit: int, *ties: str) -> DataFrame:
    order: list[Column] = [F.col("net_settled_egp").desc_nulls_last()]
    return mart.orderBy(*order, *[F.col(c).asc_nulls_last() for c in ties]).limit(limit)


def top_positions(serving_settlement: DataFrame, as_of: str | dt.date, limit: int = TOP_POSITIONS) -> DataFrame:
    """Greatest net positions of the day before ``as_of``."""
    day = serving_settlement.filter(F.col("settlement_date") == F.date_sub(as_date(as_of), 1))
    return _by_net(day, limit, "originating_bank_id", "receiving_bank_id").select(
        "originating_bank_id", "receiving_bank_id", "net_settled_egp", "settlement_rate_pct"
    )


def wallet_status(wallet_silver: DataFrame) -> DataFrame:
    millions = round_half_up(F.sum("amount_egp").cast("double") / 1e6, 2)
    return (
        wallet_silver.groupBy("txn_status")
        .agg(F.count("*").alias("cnt"), millions.alias("total_egp_millions"))
        .orderBy(F.col("cnt").desc(), "txn_status")
    )


def volume_in_millions(mart: DataFrame, limit: int = TOP_DAYS) -> DataFrame:
    rate = F.col("approved_count").cast("double") * 100.0 / F.nullif("txn_count", F.lit(0))
    return (
        mart.orderBy(F.col("report_date").desc(), "scheme")
        .limit(limit)
        .select(
            "report_date",
            "scheme",
            F.col("txn_count").alias("txns"),
            round_half_up(F.col("total_amount_egp").cast("double") / 1e6, 2).alias("egp_millions"),
            round_half_up(rate, 1).alias("approval_pct"),
        )
    )


def top_bank_pairs(mart: DataFrame, limit: int = TOP_PAIRS) -> DataFrame:
    top = _by_net(mart, limit, "settlement_date", "originating_bank_id", "receiving_bank_id")
    return top.select(
        "originating_bank_id",
        "receiving_bank_id",
        "settled_count",
        round_half_up(F.col("net_settled_egp").cast("double") / 1e6, 2).alias("net_egp_millions"),
        "settlement_rate_pct",
    )


def serving_sample(serving_volume: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """First rows by key."""
    return serving_volume.orderBy("report_date", "scheme").limit(limit)


def card_sessions(atm_bronze: DataFrame, card_token: str, first: str | dt.date, last: str | dt.date) -> DataFrame:
    """Dispute lookup: sessions of one card in a date range. Both filters reach the scan."""
    dates = F.col("session_date").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return atm_bronze.filter((F.col("card_token") == card_token) & dates).select(
        "card_token", "session_date", "atm_id", "session_id", "txn_type", "amount_egp", "status", "updated_at"
    )


def lookup_layout(atm_bronze: DataFrame) -> DataFrame:
    """Rows range-partitioned and sorted by card and date, for writing: a lookup then skips nearly all
    row groups. A busy card is split over several files because the date is part of the range."""
    return atm_bronze.repartitionByRange("card_token", "session_date", "session_id").sortWithinPartitions(
        "card_token", "session_date", "session_id"
    )
