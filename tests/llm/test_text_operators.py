"""Text operators: hand-made rows, brute force, and the SQL of the registered queries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from railyard.llm import arrays, op1_lines, op2_warc, op3_pii, op4_jaccard, op5_quality, op6_lm, op7_toxicity, op8_bpe, op9_decontaminate, op10_language, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars int, score string, _llm_note string"


def docs(spark, texts, langs=None):
    """Documents with columns whose names operators use themselves."""
    rows = [(i, t, (langs or ["en"] * len(texts))[i], "s", len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", "   \n\t ", "...", "a", "a", "ein kurzer text", "x" * 60_000, "\n".join(["same line of some length here"] * 30)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    wanted = con.execute(queries.oracle_sql()[name]).to_arrow_table()
    found = queries.queries()[name](spark, SF)
    rows = sorted(map(tuple, found.select(*wanted.column_names).collect()), key=str)
    assert sorted(found.columns) == sorted(wanted.column_names)
    assert rows == sorted(zip(*wanted.to_pydict().values()), key=str)


def test_word_hashes_depend_on_the_bytes_alone():
    texts = ["Hello wörld", None, "", "  hello\nHELLO  ", "wörld"]
    found = []
    for part in arrays.chunks(pa.array(texts), chunk_bytes=8):
        words = part.words(arrays.PLAIN)
        found += [(part.first + t, h) for t, h in zip(words.text.tolist(), words.hashes().tolist())]
    assert [t for t, _ in found] == [0, 0, 3, 3, 4]
    assert found[0][1] == found[2][1] == found[3][1] and found[1][1] == found[4][1] != found[0][1]


def test_lines_odd_rows(spark):
    run = "a long first line that is repeated " * 4
    rows = op1_lines.dedup(docs(spark, [*ODD, f"{run}\nmine", f"other\n{run}\n{run}"])).select("doc_id", "text").collect()
    text = {r.doc_id: r.text for r in rows}
    assert text[0] is None and text[1] == "" and text[4] == text[5] == "a"
    assert text[9] == f"{run}\nmine" and text[10] == "other"
    kept = op1_lines.without_repeats(docs(spark, [run, run, "b"]))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2] and kept.columns == docs(spark, ["a"]).columns


def test_short_lines_that_many_documents_share(spark):
    line, few = "Read more of our news", "Read more"
    rows = [(i, f"own {i}\n {line}\t\nmid {i}\n{few}\nend {i}") for i in range(3000)]
    rows += [(3000, "x\n你好\nRead  more\nof our\nnews now\ny"), (3001, "z\n你好\nRead  more\nof our\nnews now\nw")]  # a run of short lines
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    left = {r.doc_id: r.text for r in op1_lines.without_repeats(made).collect()}
    assert left[0] == rows[0][1] and left[3000] == rows[3000][1] and left[3001] == "z\nw"
    assert all(left[i] == f"own {i}\nmid {i}\n{few}\nend {i}" for i in range(1, 3000))


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 5000, "<p>a</p>"]
    rows = [(i, None if i == 4 else f"http://x/{i} y", h, "z") for i, h in enumerate(html)] + [(5, "again", "<p>a</p>", "z"), (None, "u", "<p>a</p>", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    op2_warc.write(pages, str(tmp_path / "w"), shard_bytes=64, roll_bytes=300)
    found = sorted(map(tuple, op2_warc.read(spark, str(tmp_path / "w"), with_payload=True).drop("payload_digest", "url").collect()), key=str)
    assert sorted(f[:4] for f in found if f[0] in (0, 3)) == [(0, 8, "revisit", 5), (3, 8, "revisit", 5)]
    assert sorted(f[2] for f in found if f[0] == 5) == ["response", "revisit"]
    assert [f[1:4] for f in found if f[0] in (1, 2)] == [(0, "revisit", 2), (0, "response", None)]
    assert [f[4] for f in found if f[0] == 4] == [("é" * 5000).encode()]
    first = {r.file: r.sha256 for r in spark.read.parquet(str(tmp_path / "w/manifest")).collect()}
    again = op2_warc.write(pages.repartition(3), str(tmp_path / "v"), shard_bytes=64, roll_bytes=300)
    assert len(first) > 1 and {r.file: r.sha256 for r in again.collect()} == first
    empty = op2_warc.write(pages.limit(0), str(tmp_path / "e"))
    assert empty.count() == 0 and op2_warc.read(spark, str(tmp_path / "e")).count() == 0


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def base_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c.isdigit() and c.isascii()]
            luhn = sum((d * 2 - 9 if d > 4 else d * 2) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0
            good = (True, kind != 1 or all(int(p) <= 255 for p in m.group().split(".")), 14 <= len(digits) <= 19 and luhn, 10 <= len(digits) <= 15)[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return ",".join(f"{op3_pii.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))


def test_pii_base_spans_equal_brute_force(spark):
    rng = random.Random(4)
    pool = [*"0123456789" * 3, *"+ -().@ab%_é\n", "1.2.3.4", "+1 (555) 123-4567", "4111 1111 1111 1111", "a@b.co", ".", "255", "999", "😀"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += [*ODD, "7" * 5000, "a@b.c " * 700, "+1 (826) 555-4081 190.137.223.204"]
    found = op3_pii.detect(docs(spark, texts)).select("doc_id", op3_pii.listed(op3_pii.F.col("base")).alias("base"), op3_pii.listed(op3_pii.F.col("spans")).alias("spans")).collect()
    assert all(r.base == base_spans(texts[r.doc_id] or "") for r in found) and len(found) == len(texts)
    assert all(set(filter(None, r.base.split(","))) <= set(r.spans.split(",")) for r in found)


def shingle_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        out.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def test_jaccard_equals_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(3, 150))] + (shared if rng.random() < 0.4 else [])
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += ODD
    sets = shingle_sets(texts)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_jaccard.join(docs(spark, texts)).collect()}
    assert found == {i: (len(sets[i]), find(i)) for i in range(len(texts))}
    kept = {r.doc_id for r in op4_jaccard.keep_one(docs(spark, texts)).collect()}
    assert kept == {find(i) for i in range(len(texts))}


def linked_roots(texts):
    sets = shingle_sets(texts)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


def family(rng, size):
    """Short texts that share most of their words, few of which link: edited copies, cut ones, edits of edits."""
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    texts = [list(base)]
    while len(texts) < size:
        copy = list(rng.choice(texts) if rng.random() < 0.3 else base)
        for _ in range(rng.choice([1, 3, 3, 4, 5])):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(copy[rng.choice([0, 0, 0, 9]) :])
    return [" ".join(t) for t in texts]


def test_jaccard_of_a_family_that_hardly_links(spark, monkeypatch):
    """Every link between the components of a large group is found, without a row for each node and other component."""
    texts = family(random.Random(11), 500)
    written, rows = op4_jaccard.tables.written, {}

    def counted(df, label):
        out = written(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(op4_jaccard.tables, "written", counted)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_jaccard.join(docs(spark, texts)).collect()}
    wanted = linked_roots(texts)
    assert found == wanted and 50 < len({c for _, c in wanted.values()}) < 450
    assert max(rows.get(label, 0) for label in ("queries", "sharing")) < 10 * len(texts)
    assert rows["left"] > 100 and rows["leading"] > 100


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(8)

    def prose():
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(80))

    def near(text):
        return " ".join([*text.split()[:79], "other"])

    a, b, c, d, e, f = (prose() for _ in range(6))
    rows = [(None, a)] * 5 + [(None, near(a))]  # copies and a near copy, all without an id
    rows += [(1, b)] * 4 + [(2, c), (2, near(c))]  # a repeated row; two similar texts under one id
    rows += [(None, d), (7, near(d)), (8, d)]  # an id comes before none
    rows += [(None, e), (None, f), (9, None), (9, None), (None, "...")]  # alone, or without words
    made = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3)
    kept = op4_jaccard.keep_one(made)
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert kept.columns == made.columns
    groups = [{(None, a), (None, near(a))}, {(2, c), (2, near(c))}]
    assert [sum(x in g for x in found) for g in groups] == [1, 1]
    rest = [x for x in found if not any(x in g for g in groups)]
    assert rest == sorted([(1, b), (7, near(d)), (None, e), (None, f), (9, None), (9, None), (None, "...")], key=str)


def test_quality_odd_rows(spark):
    found = {r.doc_id: r for r in op5_quality.judged(docs(spark, ODD)).collect()}
    assert [found[i].n_words for i in range(6)] == [0, 0, 0, 1, 1, 1] and not any(r.kept for r in found.values())
    assert found[8].n_dup_lines == 29 and found[8].n_repeat_words == 180


def test_language_model_base_scores(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("The cat sat ON a mat".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)] + ODD
    rows = {r.doc_id: r for r in op6_lm.score(docs(spark, texts)).collect()}
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), None] for t in texts]
    counts: dict = {}
    for i, words in enumerate(tokens):
        if zlib.crc32(str(i).encode()) % 10:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, words in enumerate(tokens):
        base = sum(np.log10((counts.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert rows[i].base_score == pytest.approx(base) and rows[i].n_tokens == len(words) and rows[i].train_tokens == n
        assert rows[i].n_known == sum(w in counts for w in words)
    gained = sum(r.score - r.base_score for r in rows.values())
    assert gained > 0


def test_language_model_predicts_words_beyond_the_most_frequent(spark):
    """Pairs of words far down the vocabulary: a second word that follows its first is likelier by more than a power of
    ten. (The end after a known pair makes up about a quarter of one.)"""
    frequent = " ".join(f"f{k} f{k} f{k} f{k}" for k in range(op6_lm.HEAD))
    texts = [frequent, frequent] + [f"left{k} right{k}" for k in range(40) for _ in range(3)]
    ids = [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(10_000) if not zlib.crc32(str(i).encode()) % 10]
    asked = [f"left{k} right{k}" for k in range(40)] + [f"left{k} right{(k + 1) % 40}" for k in range(40)]
    data = list(zip(ids, texts)) + list(zip(held, asked))
    found = {r.doc_id: r.score for r in op6_lm.score(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    scores = [found[i] for i in held[:80]]
    assert sum(scores[:40]) > sum(scores[40:]) + 40


def test_language_model_bins_share_out_all_other_words():
    token = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    n = np.sort(np.random.default_rng(2).integers(1, 50, 5000))[::-1]
    in_bins = np.bincount(op6_lm.bin_of(token), weights=n + op6_lm.SMOOTH, minlength=op6_lm.BINS)
    head = op6_lm.Head(token[:2000], n[:2000], int(n.sum()), len(n), in_bins)
    rest = head.of_class[-1] * head.bins
    wanted = np.bincount(op6_lm.bin_of(token[op6_lm.HEAD :]), weights=n[op6_lm.HEAD :] + op6_lm.SMOOTH, minlength=op6_lm.BINS)
    assert np.allclose(rest * head.total, wanted + op6_lm.SMOOTH / op6_lm.BINS)


def test_language_model_predicts_words_by_the_word_before_the_last(spark):
    """The word before is the same everywhere, so only the skipped word, or both together, can tell which one follows."""
    frequent = " ".join(f"f{k} f{k} f{k} f{k}" for k in range(op6_lm.HEAD))
    texts = [frequent, frequent] + [f"left{k} f7 right{k}" for k in range(40) for _ in range(3)]
    ids = [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(10_000) if not zlib.crc32(str(i).encode()) % 10]
    asked = [f"left{k} f7 right{k}" for k in range(40)] + [f"left{k} f7 right{(k + 1) % 40}" for k in range(40)]
    data = list(zip(ids, texts)) + list(zip(held, asked))
    found = {r.doc_id: r.score for r in op6_lm.score(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    scores = [found[i] for i in held[:80]]
    assert sum(scores[:40]) > sum(scores[40:]) + 20


def test_language_model_weights_are_trained_to_their_maximum():
    """At the maximum what is expected of each feature is what was observed, and all cells' probabilities add up to 1."""
    shape = op6_lm.Softmaxes(op6_lm.Grid((2, 2), (1, 2), 5), 1, 3, 0)
    random_numbers = np.random.default_rng(1)
    seen, cells = np.zeros(shape.size), random_numbers.integers(0, 12, 4000) ** 2 // 11
    outcome = np.where(random_numbers.random(4000) < 0.6, cells % 3, random_numbers.integers(0, 3, 4000))
    rows = cells // 3, cells % 3, shape.grid.pair[cells], cells
    for place in shape.places(0, outcome, rows):
        np.add.at(seen, place, 1)
    measure = np.array([0.5, 0.3, 0.2])
    weights = op6_lm.fitted(seen, measure, shape, tolerance=1e-12).astype(float)
    every = [np.repeat(x, 3) for x in (np.arange(12) // 3, np.arange(12) % 3, shape.grid.pair, np.arange(12))]
    places = shape.places(0, np.tile(np.arange(3), 12), every)
    p = np.exp(sum(weights[x] for x in places)).reshape(12, 3) * measure
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    expected = (p * np.bincount(cells, minlength=12)[:, None]).ravel()
    for place, size, start in zip(places, shape.grid.sizes, shape.starts):
        mean, theta = np.zeros(shape.size), weights[start : start + size * 3].reshape(size, 3)
        np.add.at(mean, place, expected)
        own = measure * np.exp(theta) / (measure * np.exp(theta)).sum(1, keepdims=True)
        part = slice(start, start + size * 3)
        assert np.allclose(mean[part] + op6_lm.PRIOR * own.ravel(), seen[part] + op6_lm.PRIOR * np.tile(measure, size), rtol=1e-2, atol=0.2)


def test_toxicity_on_held_out_rows(spark):
    found = queries.queries()["op7_toxicity"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    none = op7_toxicity.score(docs(spark, ODD), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(ODD)


def test_clauses_are_weighed_by_their_context():
    lexicon = op7_toxicity.Lexicon({"fool": 2.0})

    def best(text):
        return op7_toxicity.features(text, lexicon)[0]

    assert best("you are a fool") == 3.0 and best("a fool") == 2.0
    assert best("he is not a fool") < best("a fool") and best('she said "a fool"') < best("a fool") and best("") == 0


def test_quotations_go_on_over_sentence_ends():
    lexicon = op7_toxicity.Lexicon({"fool": 2.0})

    def best(text):
        return op7_toxicity.features(text, lexicon)[0]

    assert best('"Wait. A fool! Fool?"') == 1.0 and best('"Wait." A fool.') == 2.0
    assert best('"Wait.\nA fool.') == 2.0 and best("she said. A fool.") == 2.0 and best("You. A fool.") == 2.0


def test_encoding_equals_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    pool = [*map(chr, range(0x250)), *"   　﻿​٠一\U0001f600́", *" " * 60, *"aeinst'" * 20, "'s", "<|endoftext|>", "\n\n"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(800)] + ODD
    coded = op8_bpe.encode(docs(spark, texts))
    decoded = {r.doc_id: r.text for r in op8_bpe.decode(coded).collect()}
    for r in coded.collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert decoded[r.doc_id] == library.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded[r.doc_id].encode()).hexdigest()


def test_decontamination_keeps_clean_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([("a", item, 1), ("b", "short item", 1), ("c", None, 1), ("d", "", 1)], "item_id string, text string, doc_id int")
    texts = [*ODD, f"x {item.upper()}! y", "one two three four five six seven eight nine", "a Short, ITEM", None]
    found = {r.doc_id: (r.n_hit, r["items"]) for r in op9_decontaminate.find(docs(spark, texts), bench).collect()}
    assert found[9] == (12, ["a"]) and found[10] == (0, []) and found[11] == (2, ["b"])
    kept = op9_decontaminate.clean(docs(spark, texts), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [*range(9), 10, 12]
    assert op9_decontaminate.find(docs(spark, texts), bench.limit(0)).filter("n_hit > 0").count() == 0


def near_brute_force(words, item):
    """Whether 8 of 10 places of the item agree at shifts that differ by 2 at most; shorter items have fewer to miss."""
    size = min(len(item), 10)
    slack = size - min(size, 8)
    for base in range(-len(item) - slack, len(words)):
        same = [any(0 <= p + base + e < len(words) and words[p + base + e] == w for e in range(slack + 1)) for p, w in enumerate(item)]
        if size and any(sum(same[s : s + size]) >= size - slack for s in range(len(item) - size + 1)):
            return True
    return False


def test_proximity_matches_equal_brute_force(spark):
    rng = random.Random(5)
    common = [f"w{i}" for i in range(12)]
    items = [[rng.choice(common) for _ in range(n)] for n in (1, 5, 8, 9, 10, 11, 12, 25)]
    middle = [*common[:6], "rarest", *common[6:11]]  # 12 words, all phrases of which have the rare one
    items += [middle, [*common[:4], "rarer", *common[7:12]]]
    edited = [
        [w if w != "rarest" else "changed" for w in middle], [w if w != "rarer" else "changed" for w in items[-1]],
        [*middle[:5], "inserted", *middle[5:]], [*middle[:3], *middle[4:]], [*items[-1][:2], "x", *items[-1][2:7], "y", *items[-1][7:]],
        [*middle[:2], "x", "y", "z", *middle[5:8], "u", *middle[9:]], middle[::-1],
    ]
    texts = [" ".join([*(rng.choice(common) for _ in range(5)), "p", *x, "q"]) for x in edited]
    for _ in range(120):
        words = [rng.choice([*common, "rarest", "rarer"]) for _ in range(rng.randint(0, 12))]
        part = list(rng.choice(items))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(part) + 1)
            part[at : at + rng.randint(0, 1)] = rng.choice([[], ["new"], [rng.choice(common)]])
        texts.append(" ".join([*words, *part, *words[::-1]]))
    bench = spark.createDataFrame([(f"i{k:02}", " ".join(x)) for k, x in enumerate(items)], "item_id string, text string")
    found = {r.doc_id: r.near_items for r in op9_decontaminate.find(docs(spark, texts), bench).collect()}
    wanted = {i: [f"i{k:02}" for k, x in enumerate(items) if near_brute_force(t.split(), x)] for i, t in enumerate(texts)}
    assert [set(wanted[i]) & {"i08", "i09"} for i in range(4)] == [{"i08"}, {"i09"}, {"i08"}, {"i08"}]
    assert found == wanted


def test_language_spans_and_rejections(spark):
    english, german = "the cat and the dog are in the house with this thing " * 3, "der hund und die katze sind nicht in dem haus mit einem ding " * 3
    texts = [english] * 30 + [german] * 30 + [english + german, None, "", "123 !?", "слово"]
    langs = ["en"] * 30 + ["de"] * 30 + [None] * 5
    rows = {r.doc_id: r for r in op10_language.identify(docs(spark, texts, langs)).collect()}
    assert rows[0].lang_pred == "en" and rows[59].lang_pred == "de"
    assert [s.lang for s in rows[60].spans] == ["en", "de"]
    assert [rows[i].lang_pred for i in (61, 62, 63)] == ["und"] * 3 and rows[64].score == 0
    kept = op10_language.keep_identified(docs(spark, texts, langs))
    assert sorted(r.doc_id for r in kept.collect()) == [*range(61), 64]
    assert {r.lang_pred for r in op10_language.identify(docs(spark, texts, [None] * 65)).collect()} == {"und"}


@pytest.mark.parametrize("run", [
    op1_lines.dedup, op3_pii.detect, op4_jaccard.join, op5_quality.judged, op6_lm.score, op8_bpe.encode, op10_language.identify,
])
def test_empty_table(spark, run):
    assert run(docs(spark, ["a"]).limit(0)).count() == 0


def test_pii_counts_are_by_kind_not_by_place(spark, tmp_path):
    """Spans of one kind in a row, and kinds out of their listed order."""
    texts = ["nothing", "a@b.c_x@d.e", "+1 555 123 4567 then 10.0.0.1 then a@b.co", "4111111111111111; 4111-1111-1111-1111"]
    docs(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = op3_pii.op3_pii(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows} == {
        0: (0, 0, 0, 0), 1: (2, 0, 0, 0), 2: (1, 1, 0, 1), 3: (0, 0, 2, 0),
    }
