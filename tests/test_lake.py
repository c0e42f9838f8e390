"""A query derives the tables it asks for, and no others."""

from __future__ import annotations

import pytest

import registered_queries as rq

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    ("query", "written"),
    [
        ("frs3_lag_minutes", set()),
        ("metric_total_settled_transactions", {"silver/stg_ach_transactions", "gold/mart_settlement_summary"}),
        ("joi3_orphan_keys", {"silver/stg_ach_transactions"}),
        ("qry7", {"silver/stg_meeza_digital_wallet"}),
    ],
)
def test_query_derives_what_it_asks_for(spark, monkeypatch, query, written):
    monkeypatch.setattr(rq, "_LAKES", {})
    assert rq.queries()[query](spark, SF_DIR).count() >= 0
    [(root, paths, _)] = rq._LAKES.values()
    assert {p.removeprefix(f"{root}/") for p in paths} == written


def test_tables_are_written_once_and_all_by_build(spark, monkeypatch):
    monkeypatch.setattr(rq, "_LAKES", {})
    lake = rq.Lake(spark, SF_DIR)
    lake.build()
    [(_, paths, _)] = rq._LAKES.values()
    assert len(paths) == 5 + 1 + 3
    monkeypatch.setattr(rq.tables, "full_refresh", None)  # nothing is written a second time
    rq.Lake(spark, SF_DIR).build()


def test_first_load_and_now_come_from_one_pass_over_a_rail_that_is_dear_to_read(spark, monkeypatch):
    monkeypatch.setattr(rq, "_LAKES", {})
    read = []
    bronze_of = rq.bronze_of
    monkeypatch.setattr(rq, "bronze_of", lambda s, d, rail: read.append(rail) or bronze_of(s, d, rail))
    lake = rq.Lake(spark, SF_DIR)
    rq.queries()["aud5_reconcile"](spark, SF_DIR).count()
    assert all(read.count(rail) == 1 for rail in ("ach", "wallet", "atm", "meeza"))
    for rail in ("ach", "wallet", "ipn"):
        first = rq.silver_from(rail, rq.first_load(spark, SF_DIR, rail))
        for got, wanted in ((lake.first_silvers[rail], first), (lake.silver(rail), rq.silver_of(spark, SF_DIR, rail))):
            assert got.columns == wanted.columns and got.count() == wanted.count()
            assert got.exceptAll(wanted).count() == 0
