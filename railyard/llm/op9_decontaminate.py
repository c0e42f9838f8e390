"""Benchmark decontamination with a distributed positional inverted index.

1. Items become numbered terms (word hashes); every run of ``window`` words of an item is a phrase to look for.
2. One pass over the corpus counts the items' terms. A proximity match may miss some of a phrase's words, its slack;
   of the rarest terms of a phrase, one more than the slack are its anchors, so that one of them is in every match.
3. A second pass stores positional postings (document, position, term) of the items' terms around those anchors in
   whose neighbourhood enough of their item's words are at hand, each within the slack of its place.
4. Postings of anchors, less the anchor's place in its item, give alignments (document, item, shift), taken with the
   shifts up to the slack beside them. The item's other terms are met with the postings, adjusted by their offsets;
   runs of ``window`` matching places in a row are exact phrases.

A proximity match: of a phrase's places, ``near_terms`` or more (all, if the item has no more words) agree at shifts
that differ by the slack at most. Changed words count as missing; inserted and left out words move the shift by one
each. An exact phrase is one too.

Only item terms and their places are broadcast, at most ``MAX_TERMS`` of them: a larger benchmark is taken in groups of items, each
with a pass of its own. An item shorter than the window is one phrase; NULL or an item without words is none.
Documents are told apart by row, so repeated ids and NULL ids each get their own result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railyard.llm import arrays, tables

WINDOW = 10
NEAR_TERMS = 8
MAX_TERMS = 2_000_000
PAIRS = 1_000_000


class Terms:
    """Sorted term hashes with a small bit table that answers most words at once."""

    BITS = 20

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values.astype(np.uint64))
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self._slot(self.values)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that hold a term, and the terms' numbers."""
        places = np.flatnonzero(self.table[self._slot(hashes)])
        if not len(places) or not len(self.values):
            return places[:0], places[:0]
        number = np.minimum(np.searchsorted(self.values, hashes[places]), len(self.values) - 1)
        same = self.values[number] == hashes[places]
        return places[same], number[same]


def item_terms(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, ipos, term): one row per word of an item. ``item`` numbers the rows of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in arrays.chunks(batch.column(2)):
                words = texts.words(arrays.ALNUM)
                rows = pa.array(words.text + texts.first)
                made = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(words.position().astype(np.int32)), arrays.as_long(words.hashes())]
                yield pa.RecordBatch.from_arrays(made, names=["item", "item_id", "ipos", "term"])

    rows = benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").alias("text")
    )
    return rows.mapInArrow(run, "item long, item_id string, ipos int, term long")


def corpus_counts(docs: DataFrame, terms: Terms) -> dict[int, int]:
    """How often each item term occurs in the corpus. One row per term and task is shuffled."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        counts = np.zeros(len(known.values), np.int64)
        for batch in batches:
            for texts in arrays.chunks(batch.column(0)):
                _, number = known.find(texts.words(arrays.ALNUM).hashes())
                counts += np.bincount(number, minlength=len(counts))
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["number", "n"])

    rows = docs.select("text").mapInArrow(run, "number int, n long").groupBy("number").agg(F.sum("n").alias("n"))
    return {r["number"]: r["n"] for r in rows.collect()}  # at most MAX_TERMS rows


def anchors(items: dict[int, np.ndarray], terms: Terms, counts: dict[int, int], window: int, near_terms: int) -> list[tuple[int, int, int]]:
    """(term, item, ipos): each phrase's rarest terms, one more than may be missing; of equally rare ones the first."""
    chosen = set()
    for item, words in items.items():
        number = np.searchsorted(terms.values, words)
        weight = np.array([counts.get(int(n), 0) for n in number])
        size = min(len(words), window)
        for start in range(len(words) - size + 1):
            for at in start + np.argsort(weight[start : start + size], kind="stable")[: size - min(size, near_terms) + 1]:
                chosen.add((int(words[at].view(np.int64)), item, int(at)))
    return sorted(chosen)


class Phrases:
    """The items' term numbers, one item after the other with room between, and the anchors by term number."""

    def __init__(self, items: dict[int, np.ndarray], terms: Terms, chosen: list[tuple[int, int, int]], window: int, near_terms: int):
        self.window, self.slack = window, max(0, window - near_terms)
        lengths = np.array([len(w) for w in items.values()], np.int64)
        starts = window + np.cumsum(lengths + window) - lengths - window
        self.words = np.full(int((lengths + window).sum()) + window, -2, np.int32)
        for start, words in zip(starts, items.values()):
            self.words[start : start + len(words)] = np.searchsorted(terms.values, words)
        first, size = dict(zip(items, starts.tolist())), dict(zip(items, lengths.tolist()))
        number = np.searchsorted(terms.values, np.array([t for t, _, _ in chosen], np.int64).view(np.uint64))
        order = np.argsort(number, kind="stable")
        self.bounds = np.searchsorted(number[order], np.arange(len(terms.values) + 1))
        self.place = np.array([first[i] + at for _, i, at in chosen], np.int64)[order]
        self.needed = np.array([min(size[i], window, near_terms) for _, i, _ in chosen], np.int64)[order]

    def supported(self, number: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Places of ``number`` (the term number of each word, or -1) with an anchor that has enough words around it.

        A bound: a match has no fewer, and those without a match are told apart later.
        """
        room = self.window + self.slack
        spaced = np.arange(len(number)) + room * (text + 1)
        padded = np.full(int(spaced[-1]) + room + 1 if len(spaced) else 0, -1, np.int32)
        padded[spaced] = number
        at = np.flatnonzero(number >= 0)
        often = self.bounds[number[at] + 1] - self.bounds[number[at]]
        at, often = at[often > 0], often[often > 0]
        good = np.zeros(len(at), bool)
        ends = np.cumsum(often)
        begin = 0
        while begin < len(at):  # about PAIRS pairs of a place and an anchor at a time
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - often[begin] + PAIRS, "right")))
            many = often[begin:end]
            owner = np.repeat(np.arange(begin, end), many)
            which = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + self.bounds[number[at[owner]]]
            here, there = spaced[at[owner]], self.place[which]
            found = np.zeros(len(owner), np.int64)
            for offset in range(1 - self.window, self.window):
                word = self.words[there + offset]
                same = np.zeros(len(owner), bool)
                for shift in range(offset - self.slack, offset + self.slack + 1):
                    same |= padded[here + shift] == word
                found += same
            good[owner[found >= self.needed[which]]] = True
            begin = end
        return at[good]


def postings(docs: DataFrame, terms: Terms, phrases: Phrases) -> DataFrame:
    """Per row of ``docs``: its id, number of words, and the terms and positions around its anchors."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, phrases = shared.value
        reach = phrases.window + phrases.slack
        for batch in batches:
            for texts in arrays.chunks(batch.column(2)):
                words = texts.words(arrays.ALNUM)
                hashes, position = words.hashes(), words.position()
                number = np.full(len(hashes), -1, np.int32)
                places, found = known.find(hashes)
                number[places] = found
                near = np.zeros(len(hashes) + 1, np.int32)
                at = phrases.supported(number, words.text)
                low = np.maximum(at - reach + 1, words.bounds[words.text[at]])
                high = np.minimum(at + reach, words.bounds[words.text[at] + 1])
                np.add.at(near, low, 1)
                np.add.at(near, high, -1)
                places = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (number >= 0))
                ends = np.concatenate([[0], np.cumsum(np.bincount(words.text[places], minlength=texts.count))]).astype(np.int32)
                here = slice(texts.first, texts.first + texts.count)
                made = [
                    batch.column(0)[here], batch.column(1)[here], pa.array(words.counts.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), arrays.as_long(hashes[places])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(position[places].astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(made, names=[tables.ROW, "doc_id", "n_words", "terms", "positions"])

    rows = docs.select(F.monotonically_increasing_id().alias(tables.ROW), "doc_id", "text")
    return rows.mapInArrow(run, f"{tables.ROW} long, doc_id {dict(docs.dtypes)['doc_id']}, n_words long, terms array<long>, positions array<int>")


def matches(index: DataFrame, items: DataFrame, anchor_rows: DataFrame, slack: int) -> DataFrame:
    """(row, item, shift, ipos): places where a document agrees with an item at a shift near an anchor's."""
    posted = index.select(tables.ROW, F.explode(F.arrays_zip("terms", "positions")).alias("p")).select(
        tables.ROW, F.col("p.terms").alias("term"), F.col("p.positions").alias("pos")
    )
    aligned = posted.join(anchor_rows, "term").select(tables.ROW, "item", (F.col("pos") - F.col("ipos")).alias("shift")).distinct()
    aligned = aligned.select(tables.ROW, "item", F.explode(F.sequence(F.col("shift") - slack, F.col("shift") + slack)).alias("shift")).distinct()
    wanted = aligned.join(items.select("item", "ipos", "term"), "item").withColumn("pos", F.col("shift") + F.col("ipos"))
    return wanted.join(posted, [tables.ROW, "pos", "term"]).select(tables.ROW, "item", "shift", "ipos")


def proximity(hits: DataFrame, lengths: DataFrame, window: int, near_terms: int) -> DataFrame:
    """(row, item_id) with a proximity match, of places that agree: distinct places count over neighbouring shifts."""
    size = F.least(F.col("length"), F.lit(window))
    sized = lengths.withColumn("needed", F.least(size, F.lit(near_terms))).withColumn("slack", size - F.col("needed"))
    based = hits.join(sized, "item").withColumn("base", F.explode(F.sequence(F.col("shift") - F.col("slack"), F.col("shift"))))
    based = based.groupBy(tables.ROW, "item", "item_id", "needed", "base", "ipos").agg(F.count("*").alias("shifts"))
    by_place = Window.partitionBy(tables.ROW, "item", "base").orderBy("ipos").rangeBetween(0, window - 1)
    return based.withColumn("close", F.count("*").over(by_place)).filter("close >= needed").select(tables.ROW, "item_id").distinct()


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near_terms: int = NEAR_TERMS) -> DataFrame:
    """Exact phrase and proximity matches.

    Returns per row of ``docs``: the row's number, doc_id, n_words, n_hit (words inside exact phrases), items
    (ids with an exact phrase, sorted), near_items (ids with a proximity match, sorted).
    """
    spark = docs.sparkSession
    docs = tables.keyed(docs)
    numbered = tables.written(item_terms(benchmark), "items")
    words = numbered.count()
    groups = max(1, -(-words // MAX_TERMS))
    index, hits = None, None
    for group in range(groups):
        part = numbered.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == group)
        sequences: dict[int, list[tuple[int, int]]] = {}
        for r in part.select("item", "ipos", "term").collect():  # one group: bounded by MAX_TERMS and a longest item
            sequences.setdefault(r["item"], []).append((r["ipos"], r["term"]))
        items = {i: np.array([t for _, t in sorted(s)], np.int64).view(np.uint64) for i, s in sequences.items()}
        terms = Terms(np.concatenate(list(items.values())) if items else np.zeros(0, np.uint64))
        chosen = anchors(items, terms, corpus_counts(docs, terms), window, near_terms)
        phrases = Phrases(items, terms, chosen, window, near_terms)
        anchor_rows = spark.createDataFrame(chosen, "term long, item long, ipos int")
        found = tables.written(postings(docs, terms, phrases), "postings")
        index = found if index is None else index
        agreed = tables.written(matches(found, part, anchor_rows, phrases.slack), "matches")
        hits = agreed if hits is None else hits.union(agreed)
    lengths = numbered.groupBy("item", "item_id").agg(F.count("*").cast("int").alias("length"))
    by_place = Window.partitionBy(tables.ROW, "item", "shift").orderBy("ipos")
    runs = (
        hits.withColumn("island", F.col("ipos") - F.row_number().over(by_place))
        .groupBy(tables.ROW, "item", "shift", "island")
        .agg(F.min("ipos").alias("start"), F.count("*").alias("size"))
        .join(lengths, "item")
        .filter(F.col("size") >= F.least(F.col("length"), F.lit(window)))
    )
    runs = tables.written(runs.select(tables.ROW, "item_id", (F.col("shift") + F.col("start")).alias("begin"), F.col("size").cast("int").alias("size")), "runs")
    hit = (
        runs.select(tables.ROW, F.explode(F.sequence("begin", F.col("begin") + F.col("size") - 1)).alias("pos"))
        .distinct().groupBy(tables.ROW).agg(F.count("*").alias("n_hit"))
    )
    named = runs.groupBy(tables.ROW).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    close = proximity(hits, lengths, window, near_terms).groupBy(tables.ROW).agg(F.sort_array(F.collect_set("item_id")).alias("near_items"))
    none = F.array().cast("array<string>")
    return (
        index.select(tables.ROW, "doc_id", "n_words")
        .join(hit, tables.ROW, "left").join(named, tables.ROW, "left").join(close, tables.ROW, "left")
        .select(tables.ROW, "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"))
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark")))


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a proximity match, exact phrases included; a query beside ``op9_decontaminate``, whose SQL has none."""
    found = find(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", F.size("near_items").cast("long").alias("n_near"), "near_items")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a phrase of the benchmark; rows are known by id and text digest."""
    mark = F.struct(F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("digest"))
    found = find(docs.select(mark.alias("doc_id"), "text"), benchmark)
    dirty = found.filter("n_hit > 0").select(F.col("doc_id.doc_id").alias("_llm_id"), F.col("doc_id.digest").alias("_llm_digest")).distinct()
    same = docs["doc_id"].eqNullSafe(dirty["_llm_id"]) & (F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")) == dirty["_llm_digest"])
    return docs.join(dirty, same, "left_anti")


#: The same from plain joins of whole phrases.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM phrase),
place AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS p
  FROM (SELECT d.r, d.w, z.n, unnest(generate_series(1, len(d.w) - z.n + 1)) AS s FROM d, sizes z WHERE len(d.w) >= z.n)),
found AS (SELECT place.r, place.s, place.n, item_id FROM place JOIN phrase ON place.n = phrase.n AND place.p = phrase.p),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS pos FROM found) GROUP BY r),
named AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items FROM found GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
