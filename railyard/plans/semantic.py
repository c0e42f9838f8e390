"""Semantic layer: measures and metrics as data, answered by one grouped aggregation per mart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.measures import safe_ratio

AGGREGATES = {"sum": F.sum, "average": F.avg}
GRAINS = ("day", "week", "month", "quarter", "year")
METRIC_TIME = "metric_time"


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str
    columns: tuple[str, ...]  # several columns are added up

    def column(self) -> Column:
        value = reduce(lambda a, b: a + b, [F.col(c) for c in self.columns])
        return AGGREGATES[self.agg](value)


@dataclass(frozen=True)
class SemanticModel:
    name: str
    mart: str
    time: str
    dimensions: tuple[str, ...]
    entity: str
    entity_columns: tuple[str, ...]
    measures: tuple[Measure, ...] = field(default=())

    def entity_key(self) -> Column:
        """Synthetic primary key; NULL when any part is NULL."""
        parts: list[Column] = []
        for name in self.entity_columns:
            parts += [F.lit("||"), F.col(name).cast("string")]
        return F.concat(*parts[1:])


# Semantic models, measures, metric names and the calendar's bounds.
MODELS = (
    SemanticModel(
        "transactions_daily",
        "mart_daily_txn_volume",
        "report_date",
        ("scheme",),
        "txn_day_scheme",
        ("report_date", "scheme"),
        (
            Measure("transaction_count", "sum", ("txn_count",)),
            Measure("total_amount_egp", "sum", ("total_amount_egp",)),
            Measure("approved_transaction_count", "sum", ("approved_count",)),
            Measure("failed_transaction_count", "sum", ("failed_count",)),
        ),
    ),
    SemanticModel(
        "scheme_performance_daily",
        "mart_scheme_performance",
        "report_date",
        ("scheme", "channel"),
        "perf_day_scheme_channel",
        ("report_date", "scheme", "channel"),
        (
            Measure("scheme_channel_txn_volume", "sum", ("txn_volume",)),
            Measure("weighted_approval_rate_pct", "average", ("approval_rate_pct",)),
            Measure("avg_processing_latency_ms", "average", ("avg_processing_ms",)),
        ),
    ),
    SemanticModel(
        "settlement_daily",
        "mart_settlement_summary",
        "settlement_date",
        ("originating_bank_id", "receiving_bank_id"),
        "settlement_day_bank_pair",
        ("settlement_date", "originating_bank_id", "receiving_bank_id"),
        (
            Measure("settled_transaction_count", "sum", ("settled_count",)),
            Measure("failed_settlement_count", "sum", ("failed_count",)),
            Measure("returned_transaction_count", "sum", ("returned_count",)),
            Measure("net_settlement_amount_egp", "sum", ("net_settled_egp",)),
            Measure("failed_settlement_amount_egp", "sum", ("failed_amount_egp",)),
            Measure("total_attempted_settlements", "sum", ("settled_count", "failed_count", "returned_count")),
        ),
    ),
)
SIMPLE_METRICS = {
    "total_transactions": "transaction_count",
    "total_payment_value_egp": "total_amount_egp",
    "total_approved_transactions": "approved_transaction_count",
    "total_failed_transactions": "failed_transaction_count",
    "total_settled_transactions": "settled_transaction_count",
    "total_failed_settlement_transactions": "failed_settlement_count",
    "total_returned_transactions": "returned_transaction_count",
    "total_attempted_settlements": "total_attempted_settlements",
    "net_settlement_value_egp": "net_settlement_amount_egp",
    "failed_settlement_value_egp": "failed_settlement_amount_egp",
    "total_channel_transaction_volume": "scheme_channel_txn_volume",
    "avg_scheme_approval_rate_pct": "weighted_approval_rate_pct",
    "avg_payment_processing_latency_ms": "avg_processing_latency_ms",
}
RATIO_METRICS = {
    "payment_approval_rate": ("total_approved_transactions", "total_transactions"),
    "payment_failure_rate": ("total_failed_transactions", "total_transactions"),
    "avg_transaction_value_egp": ("total_payment_value_egp", "total_transactions"),
    "settlement_success_rate": ("total_settled_transactions", "total_attempted_settlements"),
    "settlement_return_rate": ("total_returned_transactions", "total_attempted_settlements"),
}
SPINE_START, SPINE_END = "2020-01-01", "2030-12-31"

METRICS = (*SIMPLE_METRICS, *RATIO_METRICS)
_MEASURE_HOME = {m.name: (model, m) for model in MODELS for m in model.measures}


def time_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per calendar day, both ends included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_day"))


def _inputs(metric: str) -> tuple[str, ...]:
    """Simple metrics a metric is made of."""
    if metric in SIMPLE_METRICS:
        return (metric,)
    if metric in RATIO_METRICS:
        return RATIO_METRICS[metric]
    raise KeyError(f"unknown metric {metric!r}")


def marts_of(metrics: Sequence[str]) -> list[str]:
    """The marts that some metrics are computed from."""
    return list(dict.fromkeys(_MEASURE_HOME[SIMPLE_METRICS[i]][0].mart for m in metrics for i in _inputs(m)))


def _group_column(model: SemanticModel, name: str) -> Column:
    """``scheme``, ``report_date``, ``report_date__week`` or ``metric_time__week``."""
    base, _, grain = name.partition("__")
    if base in (model.time, METRIC_TIME):
        grain = grain or "day"
        if grain not in GRAINS:
            raise ValueError(f"unknown grain {grain!r} in {name!r}")
        return F.date_trunc(grain, F.col(model.time)).cast("date").alias(name)
    if base in model.dimensions and not grain:
        return F.col(base).alias(name)
    if base == model.entity and not grain:
        return model.entity_key().alias(name)
    raise ValueError(f"{model.name} cannot be grouped by {name!r}")


def metric_query(
    marts: Mapping[str, DataFrame],
    metrics: Sequence[str],
    group_by: Sequence[str] = (),
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Named metrics, grouped. ``start`` and ``end`` are inclusive dates; ``where`` filters mart rows.

    One aggregation per mart involved. Marts are then lined up on the group columns by a union and a
    second, tiny aggregation, so a NULL group value lines up too and no mart's groups are lost.
    """
    needed = list(dict.fromkeys(i for m in metrics for i in _inputs(m)))
    per_model: dict[str, list[str]] = {}
    for name in needed:
        model, _ = _MEASURE_HOME[SIMPLE_METRICS[name]]
        per_model.setdefault(model.name, []).append(name)

    parts = []
    for model in MODELS:
        names = per_model.get(model.name)
        if not names:
            continue
        rows = marts[model.mart]
        if start is not None:
            rows = rows.filter(F.col(model.time) >= F.lit(str(start)).cast("date"))
        if end is not None:
            rows = rows.filter(F.col(model.time) <= F.lit(str(end)).cast("date"))
        if where is not None:
            rows = rows.filter(where)
        groups = [_group_column(model, g) for g in group_by]
        values = [_MEASURE_HOME[SIMPLE_METRICS[n]][1].column().alias(n) for n in names]
        parts.append(rows.groupBy(*groups).agg(*values))

    if len(parts) == 1:
        joined = parts[0]
    else:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        joined = stacked.groupBy(*group_by).agg(*[F.max(n).alias(n) for n in needed])
    return joined.select(*group_by, *[_metric_column(m).alias(m) for m in metrics])


def _metric_column(metric: str) -> Column:
    if metric in SIMPLE_METRICS:
        return F.col(metric)
    numerator, denominator = RATIO_METRICS[metric]
    return safe_ratio(F.col(numerator), F.col(denominator))


def volume_weighted_approval_rate(scheme_performance: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Approval rate weighted by volume (the metric ``avg_scheme_approval_rate_pct`` is a plain mean)."""
    weighted = F.sum(F.col("approval_rate_pct") * F.col("txn_volume"))
    return scheme_performance.groupBy(*group_by).agg(
        safe_ratio(weighted, F.sum("txn_volume")).alias("volume_weighted_approval_rate_pct")
    )
