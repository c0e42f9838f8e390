"""What loads keep beside their tables: key directories, statistics, taken-in chunks. All equal a full pass."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from rows import HEALTHY, TS, all_bronze, as_dicts, bronze
from test_changelog import event, events
from test_merge import D1, D2, D3, frame, table

from railyard import contracts
from railyard.checks import CHECKS
from railyard.operators import audit, changelog, freshness, merge, quality
from railyard.operators.directory import BUCKET, KeyDirectory
from railyard.plans import chain, serving, silver, streamed
from railyard.rails import ACH, ATM, RAILS
from railyard.sources import statistics, tables, topic
from railyard.streaming import bronze as stream

NOW = TS + dt.timedelta(hours=2)
KEY = T.StructType([T.StructField("k", T.StringType()), T.StructField("d", T.DateType())])


def directory_of(spark, path, rows_per_bucket=7):
    return KeyDirectory.beside(spark, path, ["k"], KEY, rows_per_bucket)


def places(directory):
    return {r.k: r.d for r in directory.read().collect()}


def test_directory_follows_its_keys(spark, tmp_path):
    found = directory_of(spark, str(tmp_path / "t"))
    assert not found.complete and found.count() == -1
    found.rebuild(frame(spark, *[(f"k{i}", 0, D1) for i in range(50)], (None, 0, D2)), "t")
    assert found.complete and found.count() == 51 and found.buckets == 8
    changed = found.put(frame(spark, ("k3", 0, D3), ("new", 0, D2), (None, 0, D3)))
    assert len(changed) <= 3 and (places(found)["k3"], places(found)["new"], places(found)[None]) == (D3, D2, D3)
    assert found.count() == 52 and found.put(frame(spark)) == []
    asked = found.find(frame(spark, ("k3", 9, None), ("absent", 0, None), (None, 0, None)))
    assert {(r.k, r.d) for r in asked.collect()} == {("k3", D3), (None, D3)}
    assert found.find(frame(spark)).count() == 0
    found.invalidate()
    assert not found.complete
    found.confirm()
    more = found.put(frame(spark, *[(f"m{i}", 0, D1) for i in range(190)]))
    assert found.count() == 242 and found.buckets == 35 and more == list(range(35))  # made anew
    assert {k: d for k, d in places(found).items() if k in ("k3", "m7", None)} == {"k3": D3, "m7": D1, None: D3}
    with pytest.raises(ValueError, match="not unique"):
        found.rebuild(frame(spark, ("a", 0, D1), ("a", 0, D2)), "t")
    assert not found.complete


def test_lookups_read_their_buckets_only(spark, tmp_path):
    found = directory_of(spark, str(tmp_path / "t"))
    found.rebuild(frame(spark, *[(f"k{i}", 0, D1) for i in range(200)]), "t")
    asked = frame(spark, ("k3", 0, None))
    assert [r.k for r in found.find(asked).collect()] == ["k3"] and len(found.touched(asked)) == 1
    plan = found.read(found.touched(asked))._jdf.queryExecution().executedPlan().toString()
    assert BUCKET in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_by_directory_equals_merge_by_scan(spark, tmp_path, seed, monkeypatch):
    """Random loads, some broken off while partitions are put in place and then repeated."""
    rng = random.Random(seed)
    path, plain = str(tmp_path / "t"), {}
    found = directory_of(spark, path, 2)

    def load(rows):
        def complete(batch, days):
            if batch is None:
                found.rebuild(spark.read.parquet(path), path)
            else:
                found.put(batch)
                found.confirm()

        def locate(batch):
            if not found.complete:
                found.rebuild(spark.read.parquet(path), path)
            return found.find(batch)

        merge.merge_into_parquet(
            spark, path, rows, ["k"], "d", before_change=lambda _: found.invalidate(), locate=locate, after_change=complete
        )

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(merge, "touched_partitions", lost)  # the table's keys are never scanned for a merge
    for n in range(5):
        rows = {rng.choice("abcdefgh"): (n, rng.choice([D1, D2, D3])) for _ in range(rng.randint(1, 5))}
        plain |= rows
        batch = frame(spark, *[(k, v, d) for k, (v, d) in rows.items()])
        if n and rng.random() < 0.6:
            with monkeypatch.context() as patch:
                patch.setattr(merge, "write_partitions", lost)
                with pytest.raises(RuntimeError, match="lost"):
                    load(batch)
            assert not found.complete
        load(batch)
        assert table(spark, path) == sorted(((k, v, d) for k, (v, d) in plain.items()), key=str)
        assert places(found) == {k: d for k, (_, d) in plain.items()} and found.complete


def test_older_rows_lose(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_into_parquet(spark, path, frame(spark, ("a", 5, D1), ("b", 1, D1)), ["k"], "d")
    told = []
    merge.merge_into_parquet(
        spark, path, frame(spark, ("a", 4, D2), ("b", 1, D2), ("c", 0, D2)), ["k"], "d", newer_by="v",
        locate=lambda batch: spark.read.parquet(path).join(batch.select("k"), "k", "left_semi"),
        after_change=lambda batch, days: told.append((sorted(r.k for r in batch.collect()), sorted(days))),
    )
    assert table(spark, path) == [("a", 5, D1), ("b", 1, D2), ("c", 0, D2)] and told == [(["b", "c"], [D1, D2])]


# ---- Statistics ---------------------------------------------------------------------------------------


def full_pass(spark, root, rail):
    rows = silver.read_silver(spark, rail, root)
    last = freshness.last_events({"t": (rows, rail.high_water)}).first()
    tests = {(r.column_name, r.check_name): r.violations for r in quality.check_table(rows, rail.silver_table, CHECKS[rail.silver_table]).collect()}
    return last.row_count, last.last_event, tests


def kept(spark, root, rail):
    totals = silver.silver_statistics(spark, rail, root)
    tests = {(r.column_name, r.check_name): r.violations for r in chain.silver_tests(spark, rail, root).collect()}
    return totals.row_count, totals.last_event, tests


def test_kept_statistics_equal_a_full_pass(spark, tmp_path):
    root, rng = str(tmp_path), random.Random(6)
    for n in range(3):
        rows = [
            {"txn_id": f"t{rng.randint(0, 12)}", "created_at": TS + dt.timedelta(hours=rng.randint(0, 80)), "amount_egp": rng.choice([None, HEALTHY["ach"]["amount_egp"]])}
            for _ in range(8)
        ]
        silver.load_silver(ACH, bronze(spark, "ach", *rows), root)
        assert kept(spark, root, ACH) == full_pass(spark, root, ACH)
    path = silver.silver_path(ACH, root)
    before = statistics.read(spark, path)
    statistics.invalidate(spark, path)  # as a run that broke off leaves it
    assert statistics.read(spark, path) is None
    assert kept(spark, root, ACH) == full_pass(spark, root, ACH)
    assert sorted(statistics.read(spark, path), key=str) == sorted(before, key=str)


def test_unchanged_days_are_not_measured(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    day = dt.timedelta(days=1)
    silver.load_silver(ACH, bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b", "created_at": TS + 2 * day}), root)
    seen = []
    real = statistics.measured

    def spy(rows, *args, **more):
        seen.append(sorted({str(r[silver.EVENT_DAY]) for r in rows.select(silver.EVENT_DAY).distinct().collect()}))
        return real(rows, *args, **more)

    monkeypatch.setattr(statistics, "measured", spy)
    silver.load_silver(ACH, bronze(spark, "ach", {"txn_id": "c", "created_at": TS + 3 * day}), root)
    assert seen == [[str((TS + 3 * day).date())]]
    assert silver.silver_statistics(spark, ACH, root).row_count == 3


def test_repeated_keys_are_found_without_a_scan_for_them(spark, tmp_path):
    root = str(tmp_path)
    silver.load_silver(ACH, bronze(spark, "ach", {"txn_id": "a"}, {"txn_id": "b"}), root)
    assert kept(spark, root, ACH)[2]["txn_id", "unique"] == 0
    path = silver.silver_path(ACH, root)
    silver.read_silver(spark, ACH, root).filter("txn_id = 'a'").write.mode("append").partitionBy(silver.EVENT_DAY).parquet(path)
    statistics.invalidate(spark, path)
    assert kept(spark, root, ACH) == full_pass(spark, root, ACH) and kept(spark, root, ACH)[2]["txn_id", "unique"] == 1


def test_first_load_refuses_repeated_keys(spark, tmp_path):
    rows = silver.silver(ACH, bronze(spark, "ach", {"txn_id": "a"}))
    with pytest.raises(ValueError, match="not unique"):
        silver.merge_silver(ACH, rows.unionByName(rows), str(tmp_path))
    assert not (tmp_path / "silver" / ACH.silver_table).exists()


# ---- Streamed bronze to silver ------------------------------------------------------------------------


def atm_event(session, seq, date, hour, status="APPROVED"):
    row = HEALTHY["atm"] | {
        "session_id": session, "session_date": date, "updated_at": TS + dt.timedelta(hours=hour), "status": status, "processing_ms": seq
    }
    return (*[row[f] for f in ATM.bronze_schema.names], "u", seq)


def silver_rows(spark, rail, root):
    drop = [contracts.LOAD_STAMP["silver"], silver.EVENT_DAY]
    return as_dicts(silver.read_silver(spark, rail, root).drop(*drop), *rail.merge_keys)


@pytest.mark.parametrize("name", ["ach", "atm"])
def test_streamed_loads_equal_the_batch(spark, tmp_path, name):
    rail, rng = RAILS[name], random.Random(4)
    path, root = str(tmp_path / "bronze"), str(tmp_path)
    source, everything, seq = streamed.StreamedBronze(rail, path), [], 0
    for n in range(3):
        rows = []
        for _ in range(rng.randint(1, 6)):
            seq += 1
            if name == "ach":
                hours = rng.randint(0, 70)
                rows.append(event(rng.choice("abcdef"), seq, created_at=TS + dt.timedelta(hours=hours)))
            else:
                rows.append(atm_event(rng.choice("xyz"), seq, rng.choice([TS.date(), TS.date() + dt.timedelta(days=1)]), seq + rng.choice([0, 0.5])))
        everything += rows
        changes = spark.createDataFrame(rows, topic.changelog_schema(rail))
        stream.add_chunk(changes, rail, path, f"s-{n:03d}")
        streamed.load_streamed(spark, source, root)
        whole = spark.createDataFrame(everything, topic.changelog_schema(rail))
        state = changelog.latest_state(whole, rail.keys)
        assert silver_rows(spark, rail, root) == as_dicts(silver.silver(rail, state), *rail.merge_keys)
        totals = streamed.bronze_totals(spark, source, root)
        last = freshness.last_events({"t": (state, rail.event_time)}).first()
        assert (totals.row_count, totals.last_event) == (last.row_count, last.last_event)
    assert kept(spark, root, rail) == full_pass(spark, root, rail)


def test_late_and_replayed_events_change_nothing(spark, tmp_path):
    path, root = str(tmp_path / "bronze"), str(tmp_path)
    source = streamed.StreamedBronze(ACH, path)
    stream.add_chunk(events(spark, event("a", 5), event("b", 5), event("c", 1)), ACH, path, "s-1")
    streamed.load_streamed(spark, source, root)
    before = silver_rows(spark, ACH, root)
    stream.add_chunk(events(spark, event("a", 4, txn_status="FAILED"), event("b", 5)), ACH, path, "s-2")  # older; again
    streamed.load_streamed(spark, source, root)
    assert silver_rows(spark, ACH, root) == before and streamed.taken(spark, source, root) == ["s-1", "s-2"]
    tables.full_refresh(spark.createDataFrame([], "chunk string"), streamed._taken_path(source, root))  # the note is lost
    streamed.load_streamed(spark, source, root)
    assert silver_rows(spark, ACH, root) == before and streamed.taken(spark, source, root) == ["s-1", "s-2"]
    streamed.applied(spark, source, root).invalidate()  # and now the directory
    stream.add_chunk(events(spark, event("c", 2, "d"), event("d", 1)), ACH, path, "s-3")
    streamed.load_streamed(spark, source, root)
    assert [r["txn_id"] for r in silver_rows(spark, ACH, root)] == ["a", "b", "c", "d"]  # a delete leaves bronze only
    assert streamed.bronze_totals(spark, source, root).row_count == 3
    assert audit.conservation({"t": (stream.read_state(spark, ACH, path), silver.read_silver(spark, ACH, root))}).count() == 1


def test_chunks_stay_few(spark, tmp_path):
    path, root = str(tmp_path / "bronze"), str(tmp_path)
    source = streamed.StreamedBronze(ACH, path)
    for n in range(8):
        stream.add_chunk(events(spark, event(f"k{n % 7}", n + 1), event(f"n{n}", 1)), ACH, path, f"s-{n:03d}")
        if n % 2:
            streamed.load_streamed(spark, source, root)
            streamed.fold_taken(spark, source, root, fan=2)
            assert len(stream.chunks(spark, path)) <= 5
    assert stream.chunk_facts(spark, ACH, path).count() == len(stream.chunks(spark, path))
    want = as_dicts(silver.silver(ACH, stream.read_state(spark, ACH, path)), "txn_id")
    assert silver_rows(spark, ACH, root) == want and len(want) == 15
    assert set(stream.chunks(spark, path)) <= set(streamed.taken(spark, source, root))


def test_folding_that_broke_off_is_taken_up_again(spark, tmp_path, monkeypatch):
    path, root = str(tmp_path / "bronze"), str(tmp_path)
    source = streamed.StreamedBronze(ACH, path)
    for n in range(3):
        stream.add_chunk(events(spark, event(f"k{n}", 1)), ACH, path, f"s-{n}")
    streamed.load_streamed(spark, source, root)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stream, "drop_path", lost)
        with pytest.raises(RuntimeError, match="lost"):
            streamed.fold_taken(spark, source, root, fan=3)
    assert len(stream.chunks(spark, path)) == 4  # the folded copy and the three
    assert streamed.fold_taken(spark, source, root, fan=3) >= 3
    streamed.load_streamed(spark, source, root)
    assert sorted(r.txn_id for r in stream.read_state(spark, ACH, path).collect()) == ["k0", "k1", "k2"]
    assert len(silver_rows(spark, ACH, root)) == 3


def test_late_rows_are_counted(spark, tmp_path):
    path = str(tmp_path / "bronze")
    stream.add_chunk(events(spark, event("a", 1, created_at=TS), event("gone", 2, "d")), ACH, path, "s-1")
    rows = [event("b", 3, created_at=TS - dt.timedelta(seconds=29)), event("c", 4, created_at=TS - dt.timedelta(seconds=31)), event("d", 5, created_at=TS - dt.timedelta(days=9))]
    stream.add_chunk(events(spark, *rows), ACH, path, "s-2")
    facts = {r.chunk: (r.events, r.deletes, r.late, r.last_event) for r in stream.chunk_facts(spark, ACH, path).collect()}
    assert facts == {"s-1": (2, 1, 0, TS), "s-2": (3, 0, 2, TS - dt.timedelta(seconds=29))}
    stream.fold_chunks(spark, ACH, path, "all")
    assert [(r.events, r.deletes, r.late, r.last_event) for r in stream.chunk_facts(spark, ACH, path).collect()] == [(5, 1, 2, TS)]
    merge.drop_path(spark, tables.beside(path, "facts"))  # facts that were never noted
    assert [(r.events, r.deletes, r.last_event) for r in stream.chunk_facts(spark, ACH, path).collect()] == [(5, 1, TS)]
    assert stream.chunk_facts(spark, ACH, str(tmp_path / "none")).count() == 0


def test_chain_over_a_stream_equals_the_chain_over_its_state(spark, tmp_path):
    path, root, plain = str(tmp_path / "bronze"), str(tmp_path / "a"), str(tmp_path / "b")
    source = streamed.StreamedBronze(ACH, path)
    others = {"wallet": all_bronze(spark)["wallet"]}
    for n, rows in enumerate(([event("a", 1), event("b", 1)], [event("b", 2, txn_status="FAILED"), event("c", 2)])):
        stream.add_chunk(events(spark, *rows), ACH, path, f"s-{n}")
        found = chain.run_chain(spark, others | {"ach": source}, root, NOW, f"r{n}", block_on_tests=False)
        counts = {r.table_name: r.row_count for r in found.collect()}
        state = stream.read_state(spark, ACH, path)
        want = chain.run_chain(spark, others | {"ach": state}, plain, NOW, f"r{n}", block_on_tests=False)
        assert counts == {r.table_name: r.row_count for r in want.collect()}
    for t in serving.TABLES:
        one, two = (as_dicts(tables.read_table(spark, r, "serving", t.name), *t.keys) for r in (root, plain))
        assert one == two and one
    one, two = (as_dicts(tables.read_table(spark, r, "serving", "pipeline_metrics"), "run_id", "source_topic") for r in (root, plain))
    assert one == two


def test_stale_stream_stops_the_chain(spark, tmp_path):
    path = str(tmp_path / "bronze")
    stream.add_chunk(events(spark, event("a", 1, created_at=NOW - dt.timedelta(hours=9))), ACH, path, "s-1")
    with pytest.raises(chain.ChainStopped, match="ach_transactions: STALE"):
        chain.run_chain(spark, {"ach": streamed.StreamedBronze(ACH, path)}, str(tmp_path / "r"), NOW, "r1")


# ---- Typed and run-keyed appends, refreshes and compaction --------------------------------------------


def test_typed_append(spark, tmp_path):
    path, contract = str(tmp_path / "t"), contracts.contract(a="bigint", m="money")
    tables.typed_append(spark.sql("SELECT 1.256 AS m, 7 AS a"), path, contract)
    tables.typed_append(spark.sql("SELECT '8' AS a, '2' AS m"), path, contract)
    assert [(r.a, str(r.m)) for r in spark.read.schema(contract).parquet(path).orderBy("a").collect()] == [(7, "1.26"), (8, "2.00")]
    for wrong in ("SELECT 1 AS a", "SELECT 1 AS a, 2 AS m, 3 AS x"):
        with pytest.raises(ValueError, match="not the target's columns"):
            tables.typed_append(spark.sql(wrong), path, contract)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.typed_append(spark.sql("SELECT 'x' AS a, 1 AS m"), path, contract)
    for other in (contracts.contract(a="string", m="money"), contracts.contract(a="bigint", m="money", z="int")):
        rows = spark.createDataFrame([], other)
        with pytest.raises(ValueError, match="column|no columns"):
            tables.typed_append(rows, path, other)
    assert spark.read.schema(contract).parquet(path).count() == 2


def test_a_repeated_run_leaves_its_telemetry_once(spark, tmp_path):
    path = str(tmp_path / "m")

    def run(run_id, bronze_rows, at=NOW):
        counts = spark.createDataFrame([("x", bronze_rows, 1), ("y", 2, 2)], "pair_name string, bronze_count bigint, silver_count bigint")
        chain.append_run(audit.metrics_of(counts, run_id, at.date(), at), path)
        return sorted((r.run_id, r.source_topic, r.bronze_row_count) for r in spark.read.parquet(path).collect())

    run("r1", 5)
    assert run("r1", 6) == [("r1", "x", 6), ("r1", "y", 2)]
    assert len(run("r2", 6)) == 4
    assert len(run("r2", 6, NOW + dt.timedelta(days=60))) == 4  # repeated in another month
    found = audit.drift_report(spark.read.parquet(path), NOW.date()).collect()
    assert {(r.source_topic, r.drift) for r in found} == {("x", -5), ("y", 0)}


def test_a_refresh_never_leaves_an_empty_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge.replace_partitions(frame(spark, ("a", 1, D1), ("b", 1, D2)), path, "d")
    seen = []
    real = merge.write_partitions

    def spy(*args):
        seen.append(table(spark, path))
        real(*args)
        seen.append(table(spark, path))

    monkeypatch.setattr(merge, "write_partitions", spy)
    merge.replace_partitions(frame(spark, ("b", 2, D2), ("c", 2, D3)), path, "d")
    assert seen[0] == [("a", 1, D1), ("b", 1, D2)] and seen[1] == [("a", 1, D1), ("b", 2, D2), ("c", 2, D3)]
    assert table(spark, path) == [("b", 2, D2), ("c", 2, D3)]
    merge.replace_partitions(frame(spark), path, "d")
    assert table(spark, path) == []
    merge.replace_partitions(frame(spark, ("n", 1, None)), path, "d")
    assert table(spark, path) == [("n", 1, None)]


def test_a_refresh_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge.replace_partitions(frame(spark, ("a", 1, D1), ("b", 1, D2)), path, "d")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "write_partitions", lost)
        with pytest.raises(RuntimeError, match="lost"):
            merge.replace_partitions(frame(spark, ("b", 2, D2)), path, "d")
    assert table(spark, path) == [("a", 1, D1), ("b", 1, D2)]
    merge.finish_rewrite(spark, path, "d")
    assert table(spark, path) == [("b", 2, D2)]


def test_compaction_that_broke_off_loses_no_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(900).selectExpr("string(id) AS k", "int(id) AS v", "DATE '2024-01-01' AS d").repartition(6).write.partitionBy("d").parquet(path)
    before = table(spark, path)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(merge, "write_partitions", lost)
        with pytest.raises(RuntimeError, match="lost"):
            merge.compact(spark, path, "d")
    assert table(spark, path) == before
    import shutil

    shutil.rmtree(tmp_path / "t" / "d=2024-01-01")  # the worst stop: the old files are gone, the new ones not in place
    merge.compact(spark, path, "d")
    assert table(spark, path) == before
    assert {r.files for r in tables.listed_files(spark, path, "d").collect()} == {1}


def test_listed_files_equal_the_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(300).selectExpr("id", "IF(id % 10 = 0, NULL, date_add(DATE '2024-01-01', int(id % 3))) AS d")
    rows.repartition(3).write.partitionBy("d").parquet(path)
    one = as_dicts(tables.listed_files(spark, path, "d"), "partition_value")
    two = as_dicts(tables.file_layout(spark.read.parquet(path), "d").drop("row_count"), "partition_value")
    assert one == two and len(one) == 4
    plan = tables.listed_files(spark, path, "d")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
