"""Language spans against a plain Viterbi, long texts in pieces, many languages, and what the pipeline keeps."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from railyard.llm import arrays, op10_language as op10

COLUMNS = "doc_id long, text string, lang string, source string, score string"


def plain(scores, switch):
    """Costs of all paths, one word after the other."""
    best, back = list(scores[0]), []
    for row in scores[1:]:
        top = max(range(len(best)), key=lambda k: best[k])
        back.append([top if best[k] < best[top] - switch else k for k in range(len(best))])
        best = [max(best[k], best[top] - switch) + row[k] for k in range(len(best))]
    path = [max(range(len(best)), key=lambda k: best[k])]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1], max(best)


def total(scores, path, switch):
    return sum(scores[t][k] for t, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_equals_plain():
    rng = np.random.default_rng(3)
    for languages in (1, 2, 5, 300):
        scores = rng.integers(-30, 1, (60, languages)).astype(np.float32)
        bounds = np.array([0, 7, 7, 30, 31, 60])
        found = op10.viterbi(scores, bounds, 12.0)
        for a, b in zip(bounds, bounds[1:]):
            if b > a:
                path, best = plain(scores[a:b].tolist(), 12.0)
                assert total(scores[a:b].tolist(), found[a:b].tolist(), 12.0) == pytest.approx(best) == total(scores[a:b].tolist(), path, 12.0)
        cut = op10.viterbi_in_pieces(iter([scores[:13], scores[13:13], scores[13:14], scores[14:]]), languages, 12.0)
        assert np.concatenate(cut).tolist() == op10.viterbi(scores, np.array([0, 60]), 12.0).tolist()


ENGLISH, GERMAN = "the cat and the dog are in the house with this thing ", "der hund und die katze sind nicht in dem haus mit einem ding "


def model_of(spark, extra=0):
    rows = [(i, ENGLISH * 3, "en", "s", "x") for i in range(20)] + [(20 + i, GERMAN * 3, "de", "s", "x") for i in range(20)]
    for k in range(extra):
        letters = random.Random(k)
        words = ["".join(letters.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(4)]
        rows.append((100 + k, " ".join(words) * 6, f"l{k:03}", "s", "x"))
    docs = spark.createDataFrame(rows, COLUMNS)
    return docs, op10.train(docs)


def test_more_than_127_languages(spark):
    docs, model = model_of(spark, 200)
    found = {r.doc_id: r.lang_pred for r in op10.predict(docs, model).collect()}
    assert len(model.langs) == 202 and sum(found[100 + k] == f"l{k:03}" for k in range(200)) >= 150 and found[0] == "en"


def test_a_long_text_in_pieces_is_labelled_as_a_whole(spark):
    _, model = model_of(spark)
    text = "".join(random.Random(1).choice([ENGLISH * 8, GERMAN * 8]) for _ in range(120)) + "é" * 50 + "\n"
    texts = next(arrays.chunks(pa.array([text])))
    whole = op10.Labelled(model, texts, op10.SWITCH)
    saved, op10.CHUNK = op10.CHUNK, 5000
    try:
        cut = op10.Labelled(model, texts, op10.SWITCH)
    finally:
        op10.CHUNK = saved
    assert cut.labels.tolist() == whole.labels.tolist() and cut.begin.tolist() == whole.begin.tolist() and cut.end.tolist() == whole.end.tolist()
    assert cut.best.tolist() == whole.best.tolist() and cut.share.tolist() == pytest.approx(whole.share.tolist())
    assert b"".join(p.data.tobytes() for p in arrays.pieces(texts, 70)).decode() == text
    glued = next(arrays.chunks(pa.array(["é" * 5000])))
    assert [p.data.tobytes().decode() for p in arrays.pieces(glued, 777)] and len(list(arrays.pieces(glued, 777))) == 13


def test_a_very_long_text(spark):
    rows = [(i, ENGLISH * 3, "en", "s", "x") for i in range(10)] + [(50 + i, GERMAN * 3, "de", "s", "x") for i in range(10)]
    docs = spark.createDataFrame([*rows, (99, GERMAN * 60_000, None, "s", "x")], COLUMNS)
    found = {r.doc_id: r for r in op10.predict(docs, op10.train(docs)).collect()}
    assert found[99].lang_pred == "de" and len(found[99].spans) == 1 and found[99].spans[0].end == len(GERMAN * 60_000) - 1


def test_what_is_kept_follows_the_prediction(spark):
    rows = [(i, ENGLISH * 3, "en", "s", "x") for i in range(20)] + [(20 + i, GERMAN * 3, "de", "s", "x") for i in range(20)]
    rows += [(60, "слово и дело", None, "s", "x"), (61, None, "en", "s", "x"), (62, "12 34", "en", "s", "x"), (63, GERMAN * 2 + ENGLISH, None, "s", "x")]
    docs = spark.createDataFrame(rows, COLUMNS)

    def kept(**options):
        found = op10.keep_identified(docs, **options)
        assert found.columns == docs.columns
        return sorted(r.doc_id for r in found.collect())

    assert kept() == [*range(40), 60, 63] and kept(min_score=0.3) == [*range(40), 63]
    assert kept(min_score=0.95) == [*range(40)] and kept(languages={"de"}, min_score=0.3) == [*range(20, 40), 63]
    assert op10.keep_identified(docs.limit(0)).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "score")
    with pytest.raises(ValueError, match="no language can be identified"):
        op10.keep_identified(unlabelled)
    assert {r.lang_pred for r in op10.identify(unlabelled).collect()} == {"und"}
