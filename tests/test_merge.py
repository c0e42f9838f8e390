"""Merge: as an expression and on partitioned Parquet."""

from __future__ import annotations

import datetime as dt
import shutil

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from rows import as_dicts

from railyard.operators.merge import merge_into_parquet, merge_upsert, touched_partitions, write_partitions
from railyard.sources.tables import beside, full_refresh

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
SCHEMA = "k string, v int, d date"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def table(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).collect()), key=str)


def test_updates_and_inserts(spark):
    merged = merge_upsert(frame(spark, ("a", 1, D1), ("b", 1, D1)), frame(spark, ("b", 2, D1), ("c", 2, D2)), ["k"])
    assert sorted(map(tuple, merged.collect())) == [("a", 1, D1), ("b", 2, D1), ("c", 2, D2)]


def test_null_keys_match_unless_strict(spark):
    target, source = frame(spark, (None, 1, D1)), frame(spark, (None, 2, D1))
    assert [r.v for r in merge_upsert(target, source, ["k"]).collect()] == [2]
    assert sorted(r.v for r in merge_upsert(target, source, ["k"], strict_sql_nulls=True).collect()) == [1, 2]


def test_new_column_is_null_for_old_rows(spark):
    source = frame(spark, ("b", 2, D1)).selectExpr("*", "true AS fresh")
    merged = merge_upsert(frame(spark, ("a", 1, D1)), source, ["k"])
    assert {(r.k, r.fresh) for r in merged.collect()} == {("a", None), ("b", True)}


def test_touched_partitions(spark):
    old = frame(spark, ("a", 1, D1), ("b", 1, D1), ("c", 1, D2), ("x", 1, None))
    new = frame(spark, ("a", 2, D1), ("c", 2, D3), ("x", 2, D3))
    got = {r.d: (r.replaced, r.remaining, r.arriving, r.emptied) for r in touched_partitions(old, new, ["k"], "d").collect()}
    assert got == {D1: (1, 1, 1, False), D2: (1, 0, 0, True), D3: (0, 0, 2, False), None: (1, 0, 0, True)}


def test_moved_row_exists_once_and_emptied_partition_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_parquet(spark, path, frame(spark, ("a", 1, D1), ("b", 1, D2), ("n", 1, None)), ["k"], "d")
    merge_into_parquet(spark, path, frame(spark, ("a", 2, D2), ("n", 2, D3)), ["k"], "d")
    assert table(spark, path) == [("a", 2, D2), ("b", 1, D2), ("n", 2, D3)]
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["d=2024-01-02", "d=2024-01-03"]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_parquet(spark, path, frame(spark, ("a", 1, D1), ("b", 1, D2)), ["k"], "d")
    files = {p.name for p in (tmp_path / "t" / "d=2024-01-01").iterdir()}
    merge_into_parquet(spark, path, frame(spark, ("b", 2, D2)), ["k"], "d")
    assert {p.name for p in (tmp_path / "t" / "d=2024-01-01").iterdir()} == files


def test_duplicate_source_key_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="not unique"):
        merge_into_parquet(spark, str(tmp_path / "t"), frame(spark, ("a", 1, D1), ("a", 2, D1)), ["k"], "d")


def test_broken_merge_is_repaired_by_running_it_again(spark, tmp_path):
    """The worst stop is between removing emptied partitions and writing: rows are missing, none is stale."""
    from railyard.operators import merge as module

    path = str(tmp_path / "t")
    merge_into_parquet(spark, path, frame(spark, ("a", 1, D1), ("b", 1, D2)), ["k"], "d")
    source = frame(spark, ("a", 2, D2))
    real, module.write_partitions = module.write_partitions, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError, match="lost"):
            merge_into_parquet(spark, path, source, ["k"], "d")
    finally:
        module.write_partitions = real
    assert table(spark, path) == [("b", 1, D2)]
    merge_into_parquet(spark, path, source, ["k"], "d")
    assert table(spark, path) == [("a", 2, D2), ("b", 1, D2)]


def test_first_load_that_broke_off_is_replaced(spark, tmp_path):
    """Some partitions were moved into place, then the driver was lost: the load is noted as begun only."""
    path = str(tmp_path / "t")
    frame(spark, ("a", 1, D1), ("ghost", 1, D3)).write.partitionBy("d").parquet(path)
    (tmp_path / "t" / "_SUCCESS").unlink()
    (tmp_path / ".begun-t").touch()
    merge_into_parquet(spark, path, frame(spark, ("a", 2, D1), ("b", 2, D2)), ["k"], "d")
    assert table(spark, path) == [("a", 2, D1), ("b", 2, D2)]


def test_data_without_a_record_is_not_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, ("a", 1, D1)).write.partitionBy("d").parquet(path)
    (tmp_path / "t" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="no load is recorded"):
        merge_into_parquet(spark, path, frame(spark, ("b", 2, D2)), ["k"], "d")
    assert table(spark, path) == [("a", 1, D1)]


def test_merges_do_not_need_success_markers(spark, tmp_path):
    path = str(tmp_path / "t")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        merge_into_parquet(spark, path, frame(spark, ("a", 1, D1)), ["k"], "d")
        merge_into_parquet(spark, path, frame(spark, ("b", 1, D1)), ["k"], "d")
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert table(spark, path) == [("a", 1, D1), ("b", 1, D1)]


def test_stop_between_delete_and_rename_keeps_rows(spark, tmp_path):
    """The day's old folder is gone and the new one not yet in place; the recorded rewrite brings both rows back."""
    path = str(tmp_path / "t")
    merge_into_parquet(spark, path, frame(spark, ("kept", 1, D1), ("c", 1, D2)), ["k"], "d")
    full_refresh(frame(spark, ("kept", 1, D1), ("new", 2, D1)), beside(path, "rewrite"), "d")
    shutil.rmtree(tmp_path / "t" / "d=2024-01-01")
    merge_into_parquet(spark, path, frame(spark, ("new", 2, D1)), ["k"], "d")
    assert table(spark, path) == [("c", 1, D2), ("kept", 1, D1), ("new", 2, D1)]
    assert not (tmp_path / ".rewrite-t").exists()


def test_unfinished_rewrite_is_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_parquet(spark, path, frame(spark, ("a", 1, D1)), ["k"], "d")
    frame(spark, ("half", 1, D1)).write.partitionBy("d").parquet(beside(path, "rewrite"))
    (tmp_path / ".rewrite-t" / "_SUCCESS").unlink()
    (tmp_path / ".begun-.rewrite-t").touch()
    merge_into_parquet(spark, path, frame(spark, ("b", 1, D1)), ["k"], "d")
    assert table(spark, path) == [("a", 1, D1), ("b", 1, D1)]


def test_refused_first_load_leaves_nothing(spark, tmp_path):
    told = []
    with pytest.raises(ValueError, match="not unique"):
        merge_into_parquet(
            spark, str(tmp_path / "t"), frame(spark, ("a", 1, D1), ("a", 2, D1)), ["k"], "d", before_change=told.append
        )
    assert told == [None] and not (tmp_path / "t").exists()


def test_new_column_on_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_into_parquet(spark, path, frame(spark, ("a", 1, D1), ("b", 1, D2)), ["k"], "d")
    merge_into_parquet(spark, path, frame(spark, ("b", 2, D2)).selectExpr("*", "7 AS extra"), ["k"], "d")
    merge_into_parquet(spark, path, frame(spark, ("c", 3, D2)), ["k"], "d")
    rows = as_dicts(spark.read.option("mergeSchema", "true").parquet(path), "k")
    assert [(r["k"], r["extra"]) for r in rows] == [("a", None), ("b", 7), ("c", None)]


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(60_000).selectExpr("sha2(string(id), 256) AS k", "int(id) AS v", "DATE '2024-01-01' AS d")
        write_partitions(rows, str(tmp_path / "t"), "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [p for p in (tmp_path / "t" / "d=2024-01-01").iterdir() if p.suffix == ".parquet"]
    assert len(files) > 4


KEYS, DAYS = st.sampled_from(["a", "b", "c", None]), st.sampled_from([D1, D2, D3])
LOAD = st.dictionaries(KEYS, st.tuples(st.integers(0, 9), DAYS), max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LOAD, min_size=1, max_size=3))
def test_any_sequence_of_loads(spark, tmp_path_factory, loads):
    path = str(tmp_path_factory.mktemp("m") / "t")
    state: dict = {}
    for load in loads:
        state |= load
        if not load:
            continue
        rows = frame(spark, *[(k, v, d) for k, (v, d) in load.items()])
        merge_into_parquet(spark, path, rows, ["k"], "d")
        merge_into_parquet(spark, path, rows, ["k"], "d")  # twice is the same as once
        assert table(spark, path) == sorted([(k, v, d) for k, (v, d) in state.items()], key=str)
