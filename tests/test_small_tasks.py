"""Passes over whole tables: how often they read, and how large their tasks are."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import registered_queries
from railyard.operators import dedup
from railyard.session import SMALL_TASKS, small_tasks
from railyard.sources import surrogates

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unset(spark):
    found = {key: spark.conf.get(key) for key in SMALL_TASKS}
    for key in SMALL_TASKS:
        spark.conf.unset(key)
    yield
    for key, value in found.items():
        spark.conf.set(key, value)


def test_a_pass_over_a_table_takes_small_tasks(spark, unset):
    surrogates.load(spark, SF, "lineitem")
    assert {key: spark.conf.get(key) for key in SMALL_TASKS} == {key: value for key, (_, value) in SMALL_TASKS.items()}


def test_a_session_keeps_values_of_its_own(spark, unset):
    for key in SMALL_TASKS:
        spark.conf.set(key, "1g")
    small_tasks(spark)
    assert {spark.conf.get(key) for key in SMALL_TASKS} == {"1g"}


def test_a_changelog_reads_events_and_reinserts_in_one_pass(spark):
    assert plan_of(surrogates.atm_changelog(spark, SF)).count("FileScan") == 2


def test_changelog_rows(spark):
    rows = spark.createDataFrame([(str(n), 1.0) for n in (1, 17, 34)] + [(None, None)], "id string, amount_egp double")
    rows = rows.withColumn("at", F.lit("1970-01-02 00:00:00").cast("timestamp_ntz"))
    found = surrogates.changelog(rows, ("id",), "at", "id").select("id", "amount_egp", "op", "seq")
    day, gone, back = surrogates.SEQ_PER_DAY, surrogates.DELETE_SEQ, surrogates.REINSERT_SEQ
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, None, "c", day), *((n, 1.0, "c", day + 100) for n in ("1", "17", "34"))]
        + [("17", None, "d", gone), ("34", None, "d", gone), ("34", 1.0, "c", back + day + 100)],
        key=str,
    )


@pytest.fixture
def kept(tmp_path):
    def write(df, label):
        df.write.parquet(f"{tmp_path}/{label}")
        return df.sparkSession.read.parquet(f"{tmp_path}/{label}")

    return write


@pytest.mark.parametrize("most", [dedup.MOST_REPEATED, 0])
def test_rows_read_again_give_the_same_latest(spark, kept, monkeypatch, most):
    monkeypatch.setattr(dedup, "MOST_REPEATED", most)
    dice = random.Random(5)
    rows = [(dice.choice([None, *"abcdefgh"]), dice.choice([None, *range(12)]), dice.choice([None, 1, 2]), dice.choice([None, "x", "y"]), n % 7) for n in range(120)]
    df = spark.createDataFrame(rows, "k string, l int, at int, filled string, rest int")
    asked = (df, ["k", "l"], ["at"], ["filled"])
    found, wanted = dedup.latest_read_again(*asked, kept=kept), dedup.latest_per_key(*asked)
    assert found.columns == wanted.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_rows_of_a_key_of_their_own_are_not_shuffled(spark, kept):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("text").alias("payload"), F.col("id").alias("at"))
    found = dedup.latest_read_again(df.union(df.filter("k < 3")), ["k"], ["at"], kept=kept)
    assert found.count() == 1000
    first = plan_of(found).split("WindowGroupLimit")[0].split("LeftAnti")[1]
    assert "Exchange hashpartitioning" not in first


def test_floating_point_keys_are_ranked_as_always(spark, kept):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "k double, at int")
    assert [r["at"] for r in dedup.latest_read_again(df, ["k"], ["at"], kept=kept).collect()] == [2]


def test_first_loads_shuffle_only_repeated_keys(spark):
    found = registered_queries.first_silvers(spark, SF)
    assert {rail for rail, rows in found.items() if "LeftAnti" in plan_of(rows)} == set(surrogates.CHEAP_TO_READ)
