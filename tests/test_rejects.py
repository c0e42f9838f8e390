"""Records that do not fit: each input row is in the result or among the rejects, unchanged."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_changelog import FIELDS, STATE, STORY, event, events, versions

from railyard import contracts
from railyard.operators import lineage
from railyard.rails import ACH
from railyard.sources import documents, rejects, topic
from railyard.streaming import bronze as stream

SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("amount", T.DecimalType(18, 2)), T.StructField("n", T.LongType()),
    T.StructField("rate", T.DoubleType()), T.StructField("ok", T.BooleanType()), T.StructField("day", T.DateType()),
    T.StructField("at", T.TimestampNTZType()), T.StructField("instant", T.TimestampType()), T.StructField("tags", T.ArrayType(T.StringType())),
])

CASES = [
    ('{"id":"a","amount":12.5,"n":3,"rate":0.5,"ok":true,"day":"2024-02-29","at":"2024-01-01T10:00:00.5","instant":"2024-01-01T10:00:00+02:00","tags":["x"]}', None, []),
    ('  {"id":"a"}\n', None, []),
    ("{}", None, []),
    ('{"id":7,"amount":"12.50","n":"3","ok":"false","other":{"x":1}}', None, []),
    ('{"id":{"x":[1]},"amount":null,"tags":null}', None, []),
    ('{"id":"a"', "malformed", []),
    ('{"id":"a"} {"id":"b"}', "malformed", []),
    ('{"id":"a"},{"id":"b"}', "not an object", []),
    ('{"id":"a"}]', "malformed", []),
    ('{"id":"a","id":"b"}', "malformed", []),
    ("gone fishing", "malformed", []),
    ('[{"id":"a"}]', "not an object", []),
    ('"text"', "not an object", []),
    ("5", "not an object", []),
    ("null", "not an object", []),
    ("", "no document", []),
    (" \n", "no document", []),
    (None, "no document", []),
    ('{"id":"a","amount":"12,5"}', "bad value", ["amount"]),
    ('{"amount":"1e30","n":"5x","ok":"yes"}', "bad value", ["amount", "n", "ok"]),
    ('{"n":1.5,"rate":"much"}', "bad value", ["n", "rate"]),
    ('{"rate":1e999}', "bad value", ["rate"]),
    ('{"n":12345678901234567890}', "bad value", ["n"]),
    ('{"day":"2023-02-29","at":"2024-01-01T10:00:00Z"}', "bad value", ["day", "at"]),
    ('{"day":"2024-01","instant":"yesterday"}', "bad value", ["day", "instant"]),
    ('{"amount":[1],"tags":"x"}', "bad value", ["amount", "tags"]),
]


def checked(spark, texts, schema=SCHEMA, **more):
    rows = spark.createDataFrame(list(enumerate(texts)), "no int, text string")
    return rejects.checked(rows, "text", schema, **more)


def test_reasons(spark):
    rows = checked(spark, [c[0] for c in CASES])
    found = {r.no: (r.reject_reason, r.reject_fields) for r in rows.collect()}
    for k, (text, reason, fields) in enumerate(CASES):
        assert found[k] == (reason, fields), text
    assert rejects.accepted(rows).count() + rejects.rejected(rows, ["no"]).count() == len(CASES)
    counts = {(r.reject_reason, r.field): r.records for r in rejects.reject_counts(rows).collect()}
    assert counts["no document", None] == 3 and counts["bad value", "amount"] == 3 and counts["bad value", "n"] == 3


def test_values(spark):
    first, *_, number, nested = (r.typed_record for r in checked(spark, [c[0] for c in CASES[:5]]).orderBy("no").collect())
    assert (str(first.amount), first.n, first.rate, first.ok, str(first.day), first.tags) == ("12.50", 3, 0.5, True, "2024-02-29", ["x"])
    assert str(first.at) == "2024-01-01 10:00:00.500000"
    assert (number.id, str(number.amount), number.n, number.ok) == ("7", "12.50", 3, False)
    assert nested.id == '{"x":[1]}' and nested.amount is None and nested.tags is None


def test_required_fields(spark):
    rows = checked(spark, ['{"id":"a"}', '{"id":null}', "{}", '{"id":"b","n":"x"}'], required=["id"])
    assert [(r.reject_reason, r.reject_fields) for r in rows.orderBy("no").collect()] == [
        (None, []), ("missing", ["id"]), ("missing", ["id"]), ("bad value", ["n"])
    ]


def test_every_document_is_in_one_place(spark):
    """Documents cut anywhere, glued and changed in one character."""
    rng = random.Random(8)
    whole = json.dumps({"_id": "W1", "wallet_id": "w", "amount_egp": 12.5, "status": "ok", "event_ts": "2024-01-20T12:00:00+00:00"})
    texts = [whole[: rng.randint(0, len(whole))] for _ in range(80)] + [whole * 2, whole]
    for _ in range(80):
        at = rng.randrange(len(whole))
        texts.append(whole[:at] + rng.choice('{}[]",:x0 ') + whole[at + 1 :])
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "doc string, no int")
    good, bad = documents.project_documents(docs, "doc"), documents.rejected_documents(docs, "doc")
    assert good.columns == contracts.BRONZE["meeza_digital_wallet_events"].names
    lost = {r.no: r for r in bad.collect()}
    assert good.count() + len(lost) == len(texts) and all(lost[k].doc == texts[k] for k in lost)
    for k, text in enumerate(texts):
        try:
            is_object = isinstance(json.loads(text, object_pairs_hook=lambda p: dict(p) if len(dict(p)) == len(p) else 0), dict)
        except ValueError:
            is_object = False
        assert is_object or k in lost, text


def test_empty_input(spark):
    rows = checked(spark, [])
    assert rejects.accepted(rows).count() == rejects.rejected(rows, ["no"]).count() == rejects.reject_counts(rows).count() == 0


def records(spark, story, *bad):
    good = topic.encode(events(spark, *story), ACH)
    return good.unionByName(spark.createDataFrame(list(bad), topic.TOPIC_SCHEMA)) if bad else good


BAD = [
    ('{"txn_id":"cut"}', '{"txn_id":"cut","amount', "t", 1),
    ('{"txn_id":"comma"}', '{"txn_id":"comma","amount_egp":"12,5"}', "t", 2),
    ('{"txn_id":', None, "t", 3),
    (None, '{"txn_id":"keyless"}', "t", 4),
]


def test_records_are_parted(spark):
    changes, bad = topic.split(records(spark, STORY, *BAD), ACH)
    assert versions(topic_state(changes)) == STATE and changes.columns == topic.changelog_schema(ACH).names
    found = {r.seq: (r.record_key, r.record_value, r.reject_reason, r.reject_fields) for r in bad.collect()}
    assert changes.count() + len(found) == len(STORY) + len(BAD)
    assert found == {
        1: (*BAD[0][:2], "malformed", []), 2: (*BAD[1][:2], "bad value", ["amount_egp"]),
        3: (*BAD[2][:2], "malformed", []), 4: (*BAD[3][:2], "no document", []),
    }
    with pytest.raises(Exception, match=r"does not fit \(bad value\): amount_egp"):
        topic.decode(records(spark, STORY, BAD[1]), ACH).collect()


def topic_state(changes):
    from railyard.operators import changelog

    return changelog.latest_state(changes, ACH.keys)


def test_a_stream_goes_on_past_bad_records(spark, tmp_path):
    folder, bronze, lost = (str(tmp_path / n) for n in ("topic", "bronze", "rejects"))

    def drain(checkpoint):
        changes = topic.read_stream(spark, ACH, source="parquet", path=folder, with_rejects=True, maxFilesPerTrigger="1")
        stream.start_upsert(changes, ACH, bronze, str(tmp_path / checkpoint), interval=None, reject_path=lost).awaitTermination()

    records(spark, STORY[:4], *BAD[:2]).coalesce(1).write.mode("append").parquet(folder)
    records(spark, STORY[4:]).coalesce(1).write.mode("append").parquet(folder)
    drain("cp")
    assert versions(stream.read_state(spark, ACH, bronze)) == STATE
    assert sorted(r.seq for r in stream.read_rejects(spark, lost).collect()) == [1, 2]
    records(spark, [event("more", 9)], *BAD[2:]).coalesce(1).write.mode("append").parquet(folder)
    drain("cp")  # restarted: only the new file
    assert versions(stream.read_state(spark, ACH, bronze)) == STATE | {"more": "more9"}
    assert sorted(r.seq for r in stream.read_rejects(spark, lost).collect()) == [1, 2, 3, 4]


def test_flat_records_are_checked_by_compiled_code(spark):
    """A step with a function over an array's elements, such as a filter, is interpreted row by row."""
    plan = topic.checked(records(spark, STORY), ACH)._jdf.queryExecution().executedPlan().toString()
    steps = [line.split("Generate")[0] for line in plan.splitlines() if "Generate explode" in line]
    assert len(steps) == 10 and all("*(" in step for step in steps)


def test_a_batch_is_kept_without_the_texts_of_records_that_fit(spark):
    rows = topic.checked(records(spark, STORY, *BAD), ACH).withColumn("_event_time", F.current_timestamp())
    setting = "spark.sql.inMemoryColumnarStorage.compressed"
    before = spark.conf.get(setting)
    try:
        kept = stream.parsed_once(rows, ACH)
    finally:
        spark.conf.set(setting, before)
    fit = kept.filter(F.col(rejects.REASON).isNull())
    assert fit.count() == len(STORY) and fit.filter(F.coalesce(topic.RECORD_KEY, topic.RECORD_VALUE).isNotNull()).count() == 0
    assert sorted(map(str, topic.rejected(kept).collect())) == sorted(map(str, topic.rejected(rows).collect()))
    columns = topic.changelog_schema(ACH).names
    assert kept.select(*columns).exceptAll(rows.select(*columns)).count() == 0


def test_a_replayed_batch_replaces_its_rejects(spark, tmp_path):
    lost = str(tmp_path / "rejects")
    rows = topic.checked(records(spark, STORY, *BAD), ACH)
    for _ in range(2):
        topic.rejected(rows).write.mode("overwrite").parquet(f"{lost}/{stream.CHUNK}=s-1")
    assert stream.read_rejects(spark, lost).count() == len(BAD)
    assert len(FIELDS) == len(ACH.bronze_schema)


def test_lineage_events_are_parted(spark):
    whole = '{"eventType":"COMPLETE","run":{"runId":"r"},"inputs":[{"namespace":"kafka://b","name":"a"}],"outputs":[{"namespace":"x","name":"b","facets":{}}]}'
    texts = [whole, whole[:-2], '{"inputs":"none"}', '{"run":7}', "", None, '{"eventType":"START","inputs":[]}', '{"outputs":[7]}', "[]", '{"inputs":[null,{"name":{"x":1}}],"run":{"runId":5}}']
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, no int")
    good, bad = lineage.parse_events(rows), lineage.rejected_events(rows)
    assert {r.no for r in good.collect()} == {0, 6, 9} and good.columns == [*lineage.EVENT_SCHEMA.names, "no"]
    assert {r.no: r.reject_reason for r in bad.collect()} == {
        1: "malformed", 2: "bad value", 3: "bad value", 4: "no document", 5: "no document", 7: "bad value", 8: "not an object",
    }
    odd = good.filter("no = 9").first()
    assert odd.inputs[0] is None and odd.inputs[1].name == '{"x":1}' and odd.run.runId == "5"
    assert lineage.edges(good).count() == 1 and bad.filter(F.col("value") == whole[:-2]).count() == 1


def test_nested_texts_by_one_cast_equal_the_walk(spark, monkeypatch):
    """Arrays and objects of texts: what the one cast gives, or the walk where a part is NULL, is what the walk alone gives."""
    inner = T.StructType([T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())])
    kind = T.StructType([T.StructField("run", inner), T.StructField("inputs", T.ArrayType(inner)), T.StructField("tags", T.ArrayType(T.ArrayType(T.StringType())))])
    item = ['{"namespace":"a","name":"b"}', '{"name":1.50}', '{"name":null}', '{"name":{"x":[1,true]}}', "null", "7", '"t"', "[]", "{}", "[null]", '["a",["b"]]']
    texts = [f'{{"run":{a},"inputs":[{a},{b}],"tags":[[{a}],{b}]}}' for a in item for b in item]
    texts += [f'{{"inputs":{a},"tags":{a},"other":1}}' for a in item]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, value string")

    def found():
        return [(r.id, r.reject_reason, r.reject_fields, r.typed_record) for r in rejects.checked(rows, "value", kind).orderBy("id").collect()]

    quick = found()
    monkeypatch.setattr(rejects, "_of_texts", lambda kind: False)
    assert quick == found()
    assert {reason for _, reason, _, _ in quick} == {None, "bad value"}


def test_batch_size_follows_the_bytes_of_a_topic(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "topic")
    spark.range(0, 4000, 1, 40).selectExpr("CAST(id AS STRING) AS key").write.parquet(path)
    assert topic.files_per_batch(spark, path, at_least=2) == 10  # 40 small files: four batches, not twenty
    size = topic.listed_files(spark, path).first()["bytes"]
    monkeypatch.setattr(topic, "BATCH_BYTES", size // 8)
    assert topic.files_per_batch(spark, path, at_least=2) in (5, 6)
    monkeypatch.setattr(topic, "BATCH_BYTES", 1)
    assert topic.files_per_batch(spark, path, at_least=2) == 2
