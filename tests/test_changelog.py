"""Change streams: batch reduction, file topics, the streaming table, compaction."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from rows import HEALTHY, TS

from railyard.operators import changelog as log
from railyard.rails import ACH, ATM, RAILS
from railyard.sources import topic
from railyard.streaming import bronze as stream

FIELDS = ACH.bronze_schema.names


def event(key: str, seq: int, op: str = "u", **changes) -> tuple:
    row = HEALTHY["ach"] | {"txn_id": key, "batch_id": f"{key}{seq}", "created_at": TS + dt.timedelta(hours=seq)} | changes
    if op == "d":
        row = {f: None for f in FIELDS} | {"txn_id": key}
    return (*[row[f] for f in FIELDS], op, seq)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), topic.changelog_schema(ACH))


def versions(df) -> dict:
    return {r.txn_id: r.batch_id for r in df.collect()}


STORY = [
    event("gone", 1, "c"), event("gone", 2), event("gone", 3, "d"),
    event("back", 1, "c"), event("back", 2, "d"), event("back", 3, "c"),
    event("late", 5, "d"), event("late", 4),  # the update arrives after the delete
    event("kept", 1, "r"), event("kept", 7),
    event("never", 1, "d"),
]
STATE = {"back": "back3", "kept": "kept7"}


def test_latest_state(spark):
    assert versions(log.latest_state(events(spark, *STORY), ACH.keys)) == STATE


def test_composite_key(spark):
    schema = topic.changelog_schema(ATM)
    base = HEALTHY["atm"]
    rows = [
        (*[(base | {"session_date": d, "processing_ms": ms})[f] for f in ATM.bronze_schema.names], "u", seq)
        for d, ms, seq in ((TS.date(), 1, 1), (TS.date(), 2, 2), (TS.date() + dt.timedelta(days=1), 3, 1))
    ]
    got = log.latest_state(spark.createDataFrame(rows, schema), ATM.keys)
    assert sorted(r.processing_ms for r in got.collect()) == [2, 3]


def test_state_since_is_the_filtered_state(spark):
    rng = random.Random(3)
    rows = []
    for key in "abcdefghij":
        for seq in range(1, rng.randint(2, 6)):
            shift = dt.timedelta(hours=rng.randint(-5, 5))
            rows.append(event(key, seq, rng.choice("ucud"), created_at=TS + shift))
    df = events(spark, *rows)
    after = TS + dt.timedelta(hours=1)
    want = versions(log.latest_state(df, ACH.keys).filter(F.col("created_at") > F.lit(after)))
    assert versions(log.latest_state_since(df, ACH.keys, "created_at", after)) == want


def test_legacy_order_prefers_updates(spark):
    rows = events(spark, event("a", 9, "c"), event("a", 1, "u"), event("b", 1, "c"), event("b", 2, "c"))
    assert versions(log.latest_by_operation(rows, ACH.keys, "created_at")) == {"a": "a1", "b": "b2"}


def test_not_deleted(spark):
    assert log.not_deleted(events(spark, *STORY)).filter("op = 'd'").count() == 0


def test_topic_round_trip(spark):
    for rail in RAILS.values():
        row = HEALTHY[rail.name]
        fields = rail.bronze_schema.names
        live = (*[row[f] for f in fields], "u", 5)
        gone = (*[row[f] if f in rail.keys else None for f in fields], "d", 6)
        df = spark.createDataFrame([live, gone], topic.changelog_schema(rail))
        records = topic.encode(df, rail)
        assert [r.value is None for r in records.orderBy("offset").collect()] == [False, True]
        assert sorted(topic.decode(records, rail).collect(), key=str) == sorted(df.collect(), key=str), rail.name


def test_broken_record_raises(spark):
    bad = spark.createDataFrame([('{"txn_id":"a"}', "{not json", "t", 1)], topic.TOPIC_SCHEMA)
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        topic.decode(bad, ACH).collect()


def write_topic(spark, folder, rows) -> None:
    topic.encode(events(spark, *rows), ACH).coalesce(1).write.mode("append").parquet(str(folder))


def drain(spark, tmp_path, name="cp") -> None:
    changes = topic.read_stream(spark, ACH, source="parquet", path=str(tmp_path / "topic"), maxFilesPerTrigger="1")
    query = stream.start_upsert(changes, ACH, str(tmp_path / "bronze"), str(tmp_path / name), interval=None)
    query.awaitTermination()


def state(spark, tmp_path) -> dict:
    return versions(stream.read_state(spark, ACH, str(tmp_path / "bronze")))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_batches_gives_the_same_state(spark, tmp_path, seed):
    rng = random.Random(seed)
    story = STORY[:]
    rng.shuffle(story)
    cuts = sorted(rng.sample(range(1, len(story)), 3))
    (tmp_path / "topic").mkdir()
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(story)])):
        write_topic(spark, tmp_path / "topic", story[a:b])
        if part % 2:
            drain(spark, tmp_path)  # stop and restart from the checkpoint
    drain(spark, tmp_path)
    assert state(spark, tmp_path) == STATE


def test_replay_with_a_new_checkpoint_changes_nothing(spark, tmp_path):
    write_topic(spark, tmp_path / "topic", STORY)
    drain(spark, tmp_path, "first")
    drain(spark, tmp_path, "second")
    assert state(spark, tmp_path) == STATE
    assert len(stream.chunks(spark, str(tmp_path / "bronze"))) >= 2


def test_replayed_batch_replaces_its_chunk(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for _ in range(2):
        stream.add_chunk(events(spark, *STORY), ACH, path, "s-1")
    assert stream.chunks(spark, path) == ["s-1"]
    assert versions(stream.read_state(spark, ACH, path)) == STATE


def test_compaction_keeps_state_and_deletes(spark, tmp_path):
    path = str(tmp_path / "bronze")
    for i, row in enumerate(STORY):
        stream.add_chunk(events(spark, row), ACH, path, f"s-{i:02d}")
    recent = [f"s-{i:02d}" for i in range(6, len(STORY))]
    assert stream.fold_chunks(spark, ACH, path, "tail", only=recent) == len(recent)
    assert versions(stream.read_state(spark, ACH, path)) == STATE
    assert stream.fold_chunks(spark, ACH, path, "all") == 7
    assert stream.chunks(spark, path) == ["all"]
    assert versions(stream.read_state(spark, ACH, path)) == STATE
    stream.add_chunk(events(spark, event("gone", 2)), ACH, path, "late")  # must not resurrect
    assert versions(stream.read_state(spark, ACH, path)) == STATE


def test_interrupted_compaction_is_harmless(spark, tmp_path):
    """Folded copy written, old chunks still there."""
    path = str(tmp_path / "bronze")
    stream.add_chunk(events(spark, *STORY[:6]), ACH, path, "a")
    stream.add_chunk(events(spark, *STORY[6:]), ACH, path, "b")
    log.last_event(stream.read_events(spark, ACH, path), ACH.keys).write.parquet(f"{path}/chunk=folded")
    assert versions(stream.read_state(spark, ACH, path)) == STATE


def test_recent_rows_of_a_streamed_table(spark, tmp_path):
    path = str(tmp_path / "bronze")
    stream.add_chunk(events(spark, *STORY), ACH, path, "a")
    assert versions(stream.read_recent(spark, ACH, path, TS + dt.timedelta(hours=5))) == {"kept": "kept7"}


def test_watermark_is_declared_and_drops_nothing(spark, tmp_path):
    """A row far behind the watermark still arrives."""
    write_topic(spark, tmp_path / "topic", [event("new", 9)])
    drain(spark, tmp_path)
    write_topic(spark, tmp_path / "topic", [event("old", 1, created_at=TS - dt.timedelta(days=400))])
    drain(spark, tmp_path)
    assert set(state(spark, tmp_path)) == {"new", "old"}
    for rail in RAILS.values():
        plan = stream.with_event_time(spark.createDataFrame([], topic.changelog_schema(rail)), rail)
        assert "EventTimeWatermark" in plan._jdf.queryExecution().logical().toString()


def test_stream_to_topic(spark, tmp_path):
    """Topic in, topic out, with the keyed sink."""
    write_topic(spark, tmp_path / "topic", STORY)
    changes = topic.read_stream(spark, ACH, source="parquet", path=str(tmp_path / "topic"))
    query = topic.write_stream(changes, ACH, str(tmp_path / "cp2"), sink="parquet", path=str(tmp_path / "out"))
    query.processAllAvailable()
    query.stop()
    records = spark.read.parquet(str(tmp_path / "out"))
    assert versions(log.latest_state(topic.decode(records, ACH), ACH.keys)) == STATE
