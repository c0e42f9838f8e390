"""The factorisation machine: its identity, its features, held-out accuracy and odd rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from railyard.llm import arrays, op13_factors as op13

COLUMNS = "doc_id long, text string, n_chars long, lang string, score string, y int"
SF = "/root/testdata/sf0.01"


def rows_of(texts, chunk_bytes=arrays.CHUNK_BYTES):
    return [op13.features(part, np.full((part.count, 1), 5.0)) for part in arrays.chunks(pa.array(texts), chunk_bytes)]


def test_sum_of_squares_equals_all_pairs():
    rng = np.random.default_rng(1)
    size = op13.width(1)
    machine = op13.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, op13.RANK)))
    for rows in rows_of(["some words and some more words", "", None, "one", "a | b ## C!"]):
        found = machine.margins(rows)[0]
        for t in range(rows.count):
            mine = rows.owner == t
            i, x = rows.index[mine], rows.value[mine].astype(float)
            v = machine.factors[i].astype(float) * x[:, None]
            pairs = sum(v[a] @ v[b] for a in range(len(i)) for b in range(a + 1, len(i)))
            assert found[t] == pytest.approx(0.3 + machine.linear[i] @ x + pairs, rel=1e-4)


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    size = op13.width(1)
    theta = np.concatenate([[0.1], rng.normal(size=size) * 0.1, rng.normal(size=size * op13.RANK) * 0.1])
    rows, y = rows_of(["a b c d", "x ## y", "a x"])[0], np.array([1.0, 0.0, 1.0])

    def loss(at):
        margin = op13.machine_of(at, size).margins(rows)[0].astype(float)
        return float((np.log1p(np.exp(-np.abs(margin))) + np.maximum(margin, 0) - y * margin).sum())

    slope = op13.machine_of(theta, size).gradient(rows, y)
    assert slope[-1] == 3
    used = rows.index[:3]
    for place in [0, *(1 + used), *(1 + size + used * op13.RANK + 2)]:
        step = np.zeros(len(theta))
        step[place] = 1e-2
        assert slope[place] == pytest.approx((loss(theta + step) - loss(theta - step)) / 2e-2, abs=5e-3)


def test_pieces_of_a_long_text_give_the_same_words():
    text = "some words | in Lines!\nthat repeat repeat 12 " * 300
    whole = op13.features(next(arrays.chunks(pa.array([text]))), np.full((1, 1), 5.0))
    parts = list(op13.pieces(next(arrays.chunks(pa.array([text]))), 1000))
    assert len(parts) > 10 and b"".join(p.data.tobytes() for p in parts).decode() == text
    saved = op13.pieces
    try:
        op13.pieces = lambda t, size=1000: saved(t, 1000)
        cut = op13.features(next(arrays.chunks(pa.array([text]))), np.full((1, 1), 5.0))
    finally:
        op13.pieces = saved
    words = whole.index < op13.HASHED
    assert np.array_equal(whole.index[words], cut.index[words]) and np.allclose(whole.value, cut.value)


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    found = op13.score(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels.select("doc_id", "quality"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_odd_rows_and_no_labels(spark):
    odd = [None, "", "   \n\t ", "...", "a", "a", "x" * 60_000, "word " * 300_000]
    rows = [(i if i != 4 else None, t, [None, -1, 5][i % 3], "en", "s", 7) for i, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, COLUMNS)
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, None), (2, 0), (2, 1), (3, 5), (None, 1), (6, 1), (7, 0)], "doc_id long, quality int")
    found = op13.score(docs, labels, folds=1000, steps=3).collect()
    assert len(found) == len(odd) and all(0 <= r.score <= 1 for r in found)
    none = op13.score(docs, labels.limit(0), steps=3).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)} and len(none) == len(odd)
    assert op13.score(docs.limit(0), labels, steps=3).count() == 0
