"""All 18 metrics, ungrouped, by one dimension and by week, against plain arithmetic."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

import pytest

from railyard.plans import semantic

DAYS = [dt.date(2024, 1, 5) + dt.timedelta(days=i) for i in range(6)]  # spans two weeks
VOLUME = [
    (d, s, 10 * i + j, Decimal(100 * i + j), 5 * i, i, Decimal(1))
    for i, d in enumerate(DAYS) for j, s in enumerate(["MEEZA", "EG-ACH"])
]
PERFORMANCE = [
    (d, "MEEZA", c, 10 * i + j + 1, Decimal(50 + i + j), float(100 * i + j))
    for i, d in enumerate(DAYS) for j, c in enumerate(["POS", None])
]
SETTLEMENT = [
    (d, o, "ZZZ", i, j, 1, Decimal(7 * i) if i else None, Decimal(j), Decimal(50))
    for i, d in enumerate(DAYS) for j, o in enumerate(["AAA", None])
]


@pytest.fixture(scope="module")
def marts(spark):
    return {
        "mart_daily_txn_volume": spark.createDataFrame(
            VOLUME, "report_date date, scheme string, txn_count bigint, total_amount_egp decimal(38,2), approved_count bigint, "
            "failed_count bigint, avg_txn_amount_egp decimal(38,2)"),
        "mart_scheme_performance": spark.createDataFrame(
            PERFORMANCE, "report_date date, scheme string, channel string, txn_volume bigint, approval_rate_pct decimal(6,3), "
            "avg_processing_ms double"),
        "mart_settlement_summary": spark.createDataFrame(
            SETTLEMENT, "settlement_date date, originating_bank_id string, receiving_bank_id string, settled_count bigint, "
            "failed_count bigint, returned_count bigint, net_settled_egp decimal(38,2), failed_amount_egp decimal(38,2), "
            "settlement_rate_pct decimal(6,2)"),
    }


# metric -> (rows, position of the one dimension, value of a row)
SIMPLE = {
    "total_transactions": (VOLUME, 1, lambda r: r[2]),
    "total_payment_value_egp": (VOLUME, 1, lambda r: r[3]),
    "total_approved_transactions": (VOLUME, 1, lambda r: r[4]),
    "total_failed_transactions": (VOLUME, 1, lambda r: r[5]),
    "total_settled_transactions": (SETTLEMENT, 1, lambda r: r[3]),
    "total_failed_settlement_transactions": (SETTLEMENT, 1, lambda r: r[4]),
    "total_returned_transactions": (SETTLEMENT, 1, lambda r: r[5]),
    "total_attempted_settlements": (SETTLEMENT, 1, lambda r: r[3] + r[4] + r[5]),
    "net_settlement_value_egp": (SETTLEMENT, 1, lambda r: r[6]),
    "failed_settlement_value_egp": (SETTLEMENT, 1, lambda r: r[7]),
    "total_channel_transaction_volume": (PERFORMANCE, 2, lambda r: r[3]),
    "avg_scheme_approval_rate_pct": (PERFORMANCE, 2, lambda r: r[4]),
    "avg_payment_processing_latency_ms": (PERFORMANCE, 2, lambda r: r[5]),
}
DIMENSION = {id(VOLUME): "scheme", id(SETTLEMENT): "originating_bank_id", id(PERFORMANCE): "channel"}


def simple(name, group):
    rows, _, value = SIMPLE[name]
    out = defaultdict(list)
    for r in rows:
        if value(r) is not None:
            out[group(r)].append(value(r))
    if name.startswith("avg_"):
        return {g: float(sum(v)) / len(v) for g, v in out.items()}
    return {g: float(sum(v)) for g, v in out.items()}


def expected(name, group):
    if name in SIMPLE:
        return simple(name, group)
    top, bottom = (simple(m, group) for m in semantic.RATIO_METRICS[name])
    return {g: (top.get(g, 0.0) / bottom[g] if bottom[g] else None) for g in bottom}


def monday(day):
    return day - dt.timedelta(days=day.weekday())


@pytest.mark.parametrize("name", semantic.METRICS)
@pytest.mark.parametrize("by", ["nothing", "dimension", "week"])
def test_metric(spark, marts, name, by):
    base = name if name in SIMPLE else semantic.RATIO_METRICS[name][0]
    rows, position, _ = SIMPLE[base]
    if by == "nothing":
        groups, group = [], lambda r: ()
    elif by == "dimension":
        groups, group = [DIMENSION[id(rows)]], lambda r: (r[position],)
    else:
        groups, group = ["metric_time__week"], lambda r: (monday(r[0]),)
    got = {tuple(r)[:-1]: r[-1] for r in semantic.metric_query(marts, [name], groups).collect()}
    want = expected(name, group)
    assert set(got) == set(want)
    for key, value in want.items():
        assert float(got[key]) == pytest.approx(value) if value is not None else got[key] is None


def test_metrics_of_several_marts_line_up(spark, marts):
    got = semantic.metric_query(
        marts, ["total_transactions", "settlement_success_rate", "total_channel_transaction_volume"], ["metric_time"]
    )
    assert got.columns == [
        "metric_time", "total_transactions", "settlement_success_rate", "total_channel_transaction_volume",
    ]
    assert sorted(r.metric_time for r in got.collect()) == DAYS


def test_time_range_is_inclusive(spark, marts):
    got = semantic.metric_query(marts, ["total_transactions"], ["report_date"], start=DAYS[1], end=DAYS[3])
    assert sorted(r.report_date for r in got.collect()) == DAYS[1:4]


def test_unknown_names_are_refused(spark, marts):
    with pytest.raises(KeyError):
        semantic.metric_query(marts, ["profit"])
    for group in ("colour", "scheme__week"):
        with pytest.raises(ValueError, match="grouped by"):
            semantic.metric_query(marts, ["total_transactions"], [group])
    with pytest.raises(ValueError, match="grain"):
        semantic.metric_query(marts, ["total_transactions"], ["report_date__decade"])


def test_entity_key_is_null_when_a_part_is(spark, marts):
    model = semantic.MODELS[1]
    keys = {r[0] for r in marts[model.mart].limit(2).select(model.entity_key()).collect()}
    assert keys == {f"{DAYS[0]}||MEEZA||POS", None}


def test_time_spine(spark):
    days = semantic.time_spine(spark)
    first, last, n = days.selectExpr("min(date_day)", "max(date_day)", "count(*)").first()
    assert (first, last, n) == (dt.date(2020, 1, 1), dt.date(2030, 12, 31), 4018)


def test_weighted_rate_differs_from_the_mean(spark, marts):
    got = semantic.volume_weighted_approval_rate(marts["mart_scheme_performance"]).first()[0]
    total = sum(r[3] for r in PERFORMANCE)
    assert got == pytest.approx(float(sum(r[4] * r[3] for r in PERFORMANCE)) / total)
