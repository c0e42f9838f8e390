"""Latest per key against brute force, and its plan."""

from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railyard.operators import dedup
from railyard.operators.dedup import latest_per_key

maybe = st.one_of(st.none(), st.integers(0, 3))
ROWS = st.lists(st.tuples(maybe, maybe, maybe, maybe), max_size=25)
QUICK = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def low(v):
    return (v is not None, v if v is not None else 0)


@QUICK
@given(ROWS)
def test_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, done int, x int")
    best: dict = {}
    for k, ts, done, x in rows:
        rank = (done is not None, low(ts), low(done), low(x))
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, ts, done, x))
    got = latest_per_key(df, ["k"], ["ts"], prefer=["done"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted((v[1] for v in best.values()), key=str)


def test_rows_are_reduced_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS ts")
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_latest_of_early_rows_and_of_all_in_one_pass(spark):
    """As ``latest_per_key`` of all rows and of the early ones: ties, NULLs in key and order, keys with rows on one side."""
    random_numbers = random.Random(7)

    def some(values):
        return random_numbers.choice([None, *values])

    rows = [(some("abcdefgh"), some(range(6)), some(["x", "y"]), some([1.5, -2.0])) for _ in range(300)]
    rows += [("late", 5, "x", None), ("late", 4, "x", 1.0), ("early", 1, "y", None), ("none", None, None, None), (None, 5, None, None)]
    df = spark.createDataFrame(rows, "k string, t int, done string, amount double").repartition(5)
    early = F.col("t") < 3
    for prefer in ((), ("done",)):
        found = dedup.latest_at(df, ["k"], ["t"], prefer, early=early)
        for flag, source in ((dedup.LATEST, df), (dedup.EARLY, df.filter(early))):
            wanted = dedup.latest_per_key(source, ["k"], ["t"], prefer)
            got = found.filter(flag).drop(dedup.LATEST, dedup.EARLY)
            assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
        both = found.groupBy("k").agg(F.count("*").alias("n"), F.count_if(dedup.EARLY).alias("e")).collect()
        assert all(r.n <= 2 and r.e <= 1 for r in both)
