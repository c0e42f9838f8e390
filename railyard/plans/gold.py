"""Gold: daily volume, scheme performance and settlement marts.

All rails are first projected to one narrow shape. A mart is then a single aggregation over the union, so
five rails cost one shuffle of partial sums, not five.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.functions.measures import count_true, percent, round_half_up, sum_where
from railyard.rails import ACH, RAILS, Rail

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def unified(rail: Rail, silver: DataFrame, *keep: str) -> DataFrame:
    """One rail's silver rows in the shape the marts share. Rows without a report date are left out.

    Amounts are DECIMAL here, the double ones included, so sums are exact and do not depend on the order
    in which tasks finish.
    """
    latency = F.col(rail.latency).cast("bigint") if rail.latency else F.lit(0).cast("bigint")
    return silver.filter(F.col(rail.report_date).isNotNull()).select(
        F.col(rail.report_date).alias("report_date"),
        F.lit(rail.scheme).alias("scheme"),
        rail.channel().alias("channel"),
        F.col("amount_egp").cast(MONEY).alias("amount_egp"),
        rail.approved().alias("approved"),
        rail.failed().alias("failed"),
        latency.alias("latency_ms"),
        *keep,
    )


def all_rails(silvers: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [unified(RAILS[name], df) for name, df in silvers.items()])


def channel_rollup(rows: DataFrame, *also_by: str) -> DataFrame:
    """Sums and counts per date, scheme and channel: enough to derive both scheme marts in one scan."""
    return rows.groupBy("report_date", "scheme", "channel", *also_by).agg(
        F.count("*").alias("txn_count"),
        F.sum("amount_egp").cast(MONEY_SUM).alias("amount_egp"),
        count_true(F.col("approved")).alias("approved_count"),
        count_true(F.col("failed")).alias("failed_count"),
        F.sum("latency_ms").alias("latency_ms"),
    )


def _finish_volume(sums: DataFrame) -> DataFrame:
    average = round_half_up(F.col("total_amount_egp").cast("double") / F.nullif("txn_count", F.lit(0)), 2)
    return sums.select(
        "report_date",
        "scheme",
        "txn_count",
        "total_amount_egp",
        "approved_count",
        "failed_count",
        average.cast(MONEY_SUM).alias("avg_txn_amount_egp"),
    )


def daily_volume(rows: DataFrame) -> DataFrame:
    """Per date and scheme: count, value, approved, failed, average value."""
    return _finish_volume(
        rows.groupBy("report_date", "scheme").agg(
            F.count("*").alias("txn_count"),
            F.sum("amount_egp").cast(MONEY_SUM).alias("total_amount_egp"),
            count_true(F.col("approved")).alias("approved_count"),
            count_true(F.col("failed")).alias("failed_count"),
        )
    )


def daily_volume_from_rollup(rollup: DataFrame) -> DataFrame:
    return _finish_volume(
        rollup.groupBy("report_date", "scheme").agg(
            F.sum("txn_count").alias("txn_count"),
            F.sum("amount_egp").cast(MONEY_SUM).alias("total_amount_egp"),
            F.sum("approved_count").alias("approved_count"),
            F.sum("failed_count").alias("failed_count"),
        )
    )


def merged_rollup(rollup: DataFrame) -> DataFrame:
    """Rollup rows of one group added up."""
    sums = [
        F.sum(c).cast(rollup.schema[c].dataType).alias(c)
        for c in ("txn_count", "amount_egp", "approved_count", "failed_count", "latency_ms")
    ]
    return rollup.groupBy("report_date", "scheme", "channel").agg(*sums)


def scheme_performance_from_rollup(rollup: DataFrame, rate_scale: int | None = None) -> DataFrame:
    """Per date, scheme and channel: volume, approval rate, mean latency. Clearing transfers have no
    channel and are not part of this mart."""
    rate = percent(F.col("approved_count"), F.col("txn_count"), 3, rate_scale)
    latency = round_half_up(F.col("latency_ms").cast("double") / F.col("txn_count"), 0)
    return rollup.filter(F.col("scheme") != ACH.scheme).select(
        "report_date",
        "scheme",
        "channel",
        F.col("txn_count").alias("txn_volume"),
        rate.alias("approval_rate_pct"),
        latency.alias("avg_processing_ms"),
    )


def scheme_performance(silvers: Mapping[str, DataFrame], rate_scale: int | None = None) -> DataFrame:
    with_channel = {name: df for name, df in silvers.items() if name != ACH.name}
    return scheme_performance_from_rollup(channel_rollup(all_rails(with_channel)), rate_scale)


def settlement_rollup(ach_silver: DataFrame, *also_by: str) -> DataFrame:
    """Counts and sums per settlement date and bank pair."""
    status, amount = F.col("txn_status"), F.col("amount_egp")
    return (
        ach_silver.filter(F.col("settlement_date").isNotNull())
        .groupBy("settlement_date", "originating_bank_id", "receiving_bank_id", *also_by)
        .agg(
            F.count("*").alias("txn_count"),
            count_true(status == "SETTLED").alias("settled_count"),
            count_true(status == "FAILED").alias("failed_count"),
            count_true(status == "RETURNED").alias("returned_count"),
            sum_where(amount, status == "SETTLED").cast(MONEY_SUM).alias("net_settled_egp"),
            sum_where(amount, status == "FAILED").cast(MONEY_SUM).alias("failed_amount_egp"),
        )
    )


def merged_settlement_rollup(rollup: DataFrame) -> DataFrame:
    """Rollup rows of one bank pair and date added up; a sum without any value stays NULL."""
    sums = [
        F.sum(c).cast(rollup.schema[c].dataType).alias(c)
        for c in ("txn_count", "settled_count", "failed_count", "returned_count", "net_settled_egp", "failed_amount_egp")
    ]
    return rollup.groupBy("settlement_date", "originating_bank_id", "receiving_bank_id").agg(*sums)


def settlement_from_rollup(rollup: DataFrame, rate_scale: int | None = None) -> DataFrame:
    rate = percent(F.col("settled_count"), F.col("txn_count"), 2, rate_scale)
    return rollup.select(*[c for c in rollup.columns if c != "txn_count"], rate.alias("settlement_rate_pct"))


def settlement_summary(ach_silver: DataFrame, rate_scale: int | None = None) -> DataFrame:
    """Per settlement date and bank pair: settled, failed and returned counts, values, settlement rate."""
    return settlement_from_rollup(settlement_rollup(ach_silver), rate_scale)
