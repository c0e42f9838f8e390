"""The pipeline against its stages' decisions worked out by hand, and the library's encoding of what is left."""

from __future__ import annotations

import random


def test_pipeline_on_planted_cases(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(3)

    def prose(n):
        return " ".join("".join(rng.choice("aeiorstnl") for _ in range(rng.randint(2, 8))) for _ in range(n))

    passage, item = prose(40), prose(14)
    near = prose(60).split()
    texts = {
        0: prose(80),  # clean
        1: f"{prose(30)}\n{passage}\n{prose(5)}",  # first place of the passage
        2: None,
        3: "12 !?",
        5: " ".join(near),
        6: " ".join([*near[:59], "other"]),  # a near copy of 5
        7: f"{prose(10)} {item} {prose(10)}",  # holds a benchmark item
        8: prose(3),
    }
    texts[4] = texts[0]  # an exact copy
    texts[9] = f"{passage}\nmine is kept"
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    wanted = {i: texts[i] for i in (0, 1, 5, 8)} | {9: "mine is kept"}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert found == {i: library.encode(t, add_special_tokens=False).ids for i, t in wanted.items()}
