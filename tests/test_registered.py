"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == [
        "report_date", "scheme", "txn_count", "total_amount_egp", "approved_count", "failed_count", "avg_txn_amount_egp",
    ]
    assert result.select("scheme").distinct().count() == 5
