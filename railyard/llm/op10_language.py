"""Language identification by words: script ranges, n-gram scores, and Viterbi with a switching penalty.

A word's script leaves the languages that were seen in that script as candidates. Each candidate scores the word by
its letter n-grams (1 to 3, with word edges). Viterbi then labels all words of a text, paying ``SWITCH`` for each
change of language, so that spans of a mixed text are found and single odd words are not. The prediction is the
language with most letters; its share of the letters that any language could score is the score.

The model is fitted on at most about ``TRAIN_DOCS`` labelled rows of each language (an even choice by a hash of the
id); its table is bounded by ``BUCKETS`` times the number of languages.

NULL text or a text without a letter: ``und``, score 0. Letters of scripts that no language has: the most frequent
language, score 0. No labelled rows at all: ``und`` everywhere (``keep_identified`` raises). Of languages with equal
letters the first by name is taken. Repeated rows get one result each. A text beyond ``CHUNK`` bytes is read whole, in
pieces that end at white space; the Viterbi state is carried from one to the next.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import arrays, tables

FOLDS = 5
TRAIN_DOCS = 2000
BUCKETS = 1 << 16
ORDERS = 3
SWITCH = 12.0
SMOOTH = 0.5
UNKNOWN = "und"
CHUNK = 1 << 20

# First and last code points of scripts, after the public block list.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF), ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = sorted({name for name, _, _ in SCRIPTS})
OTHER = len(SCRIPT_NAMES)


@lru_cache(1)
def letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is a letter, belongs to a word, its lower case, its script."""
    size = 0x110000
    letter, member, script = np.zeros(size, bool), np.zeros(size, bool), np.full(size, OTHER, np.int8)
    lower = np.arange(size, dtype=np.uint32)
    for c in range(size):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            letter[c], member[c] = kind == "L", True
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
    for name, low, high in SCRIPTS:
        script[low : high + 1] = SCRIPT_NAMES.index(name)
    return letter, member, lower, script


class LetterWords:
    """Words (letters and marks) of some texts: code points, word bounds, script of the first letter."""

    def __init__(self, texts: arrays.Texts):
        letter, member, lower, script = letter_tables()
        code = np.frombuffer(texts.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
        self.bounds = lead[texts.bounds]
        inside = member[code]
        edge = np.zeros(len(code) + 1, bool)
        edge[self.bounds] = True
        before, after = np.zeros(len(code), bool), np.zeros(len(code), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.code = lower[code]
        self.word_bounds = np.searchsorted(self.starts, self.bounds)
        self.count = texts.count
        letters = np.concatenate([[0], np.cumsum(letter[code])])
        self.letters = letters[self.ends] - letters[self.starts]  # letters of a word
        self.script = script[code[self.starts]] if len(self.starts) else np.zeros(0, np.int8)

    def ngrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all n-grams and the words they belong to, in the order of the words.

        A word's code points are laid out between two edge marks; an n-gram ends at each place.
        """
        length = self.ends - self.starts + 2
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        owner = np.repeat(np.arange(len(length)), length)
        offset = np.arange(total) - np.repeat(ends - length, length)
        code = np.full(total, 0x110000, np.uint64)
        inner = (offset > 0) & (offset < np.repeat(length - 1, length))
        code[inner] = self.code[(np.repeat(self.starts, length) + offset - 1)[inner]]
        found = np.empty((total, ORDERS), np.int32)
        value = np.zeros(total, np.uint64)
        for order in range(ORDERS):
            shifted = np.zeros(total, np.uint64)
            shifted[order:] = code[: total - order]
            value = np.where(offset >= order, value * np.uint64(0x1000193) + shifted + np.uint64(1), 0)
            mixed = (value + np.uint64(order << 40)) * np.uint64(0x9E3779B97F4A7C15)
            # an n-gram that would begin before its word goes to the bucket of its order's edge
            found[:, order] = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
        return found, owner


class Model:
    """Log-probabilities of n-gram buckets by language, and the scripts of each language."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        share = (counts + SMOOTH) / (counts.sum(0, keepdims=True) + SMOOTH * BUCKETS)
        self.log = np.log(share).astype(np.float32)
        self.allowed = scripts > 0.005 * scripts.sum(0, keepdims=True)  # (script, language)
        self.frequent = int(np.argmax(counts.sum(0))) if len(langs) else 0

    def scores(self, words: LetterWords) -> np.ndarray:
        """(word, language): log-probability less that of the best candidate, 0 for all where none is one."""
        found, owner = words.ngrams()
        out = np.zeros((len(words.starts), len(self.langs)), np.float32)
        if not len(owner):
            return out
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for order in range(ORDERS):
            out += np.add.reduceat(self.log[found[:, order]], first, axis=0)
        allowed = self.allowed[words.script]
        out[~allowed] = -1e9
        out -= out.max(1, keepdims=True)
        np.maximum(out, -60, out=out)
        out[~allowed.any(1)] = 0
        return out


class Trail:
    """What the way back needs of some words: the best language of the word before, and whether a change pays."""

    def __init__(self, words: int, languages: int):
        self.stay = np.zeros(words, np.int32)
        self.changed = np.zeros((words, languages), bool)


def _forward(scores: np.ndarray, begin: np.ndarray, live: np.ndarray, best: np.ndarray, switch: float, trail: Trail, first: bool) -> None:
    """Steps through words ``begin`` + t of the texts still live at t; ``best`` holds each text's state and goes on."""
    for t in range(len(live)):
        n = live[t]
        at = begin[:n] + t
        if t or not first:
            top = best[:n].argmax(1)
            floor = best[np.arange(n), top] - switch
            trail.stay[at] = top
            pays = best[:n] < floor[:, None]
            trail.changed[at] = pays
            best[:n] = np.where(pays, floor[:, None], best[:n])
        best[:n] += scores[at]


def _backward(begin: np.ndarray, live: np.ndarray, label: np.ndarray, trail: Trail, labels: np.ndarray) -> None:
    """Writes ``labels`` from the last words to the first; ``label`` ends as that of the word before the first."""
    for t in range(len(live) - 1, -1, -1):
        n = live[t]
        at = begin[:n] + t
        labels[at] = label[:n]
        label[:n] = np.where(trail.changed[at, label[:n]], trail.stay[at], label[:n])


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word; all texts of the batch take a step at a time, the longest ones longest."""
    labels = np.zeros(len(scores), np.int32)
    length = np.diff(bounds)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    if not len(order):
        return labels
    begin, length = bounds[:-1][order], length[order]
    live = np.searchsorted(-length, -np.arange(length[0]), "left")  # texts longer than step t
    trail = Trail(len(scores), scores.shape[1])
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    _forward(scores, begin, live, best, switch, trail, True)
    _backward(begin, live, best.argmax(1), trail, labels)
    return labels


def viterbi_in_pieces(pieces: Iterator[np.ndarray], languages: int, switch: float) -> list[np.ndarray]:
    """The same for one text whose words come piece by piece: the state is carried on, scores are not kept."""
    best, trails = np.zeros((1, languages), np.float32), []
    zero, words = np.zeros(1, np.int64), 0
    for scores in pieces:
        trail = Trail(len(scores), languages)
        best -= best.max()  # a constant; keeps sums small
        _forward(scores, zero, np.ones(len(scores), np.int64), best, switch, trail, words == 0)
        words += len(scores)
        trails.append(trail)
    label, found = best.argmax(1), []
    for trail in reversed(trails):
        labels = np.zeros(len(trail.stay), np.int32)
        _backward(zero, np.ones(len(labels), np.int64), label, trail, labels)
        found.append(labels)
    return found[::-1]


def train(docs: DataFrame, per_language: int = TRAIN_DOCS) -> Model:
    """From text and lang of rows with both; other columns are not read."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((OTHER + 1, 0)))
    grid = 1 << 20
    limit = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(max(1, round(grid * min(1, per_language / n))))) for lang, n in sizes.items()])
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grid)) < limit)
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(langs), BUCKETS), np.int64)
        scripts = np.zeros((len(langs), OTHER + 1), np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for texts in arrays.chunks(batch.column(0), CHUNK):
                words = LetterWords(texts)
                of_word = np.repeat(lang[texts.first : texts.first + texts.count], np.diff(words.word_bounds))
                found, owner = words.ngrams()
                of_gram = of_word[owner]
                for k in np.unique(of_word):
                    counts[k] += np.bincount(found[of_gram == k].ravel(), minlength=BUCKETS)
                    scripts[k] += np.bincount(words.script[of_word == k], weights=words.letters[of_word == k], minlength=OTHER + 1).astype(np.int64)
        both = np.concatenate([counts, scripts], axis=1)
        lang, bucket = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(both[lang, bucket])], names=["lang", "bucket", "n"])

    rows = sample.select("text", "lang").mapInArrow(run, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    both = np.zeros((BUCKETS + OTHER + 1, len(langs)))
    for r in rows.collect():  # at most (BUCKETS + scripts) rows a language
        both[r["bucket"], r["lang"]] = r["n"]
    return Model(langs, both[:BUCKETS], both[BUCKETS:])


class Words:
    """Of the words of some texts: begin and end (code points of their text), text, language, and its letters if any
    language could score it."""

    def __init__(self, words: LetterWords, model: Model, text: np.ndarray, first: int = 0):
        base = words.bounds[text]
        self.begin, self.end, self.text = words.starts - base + first, words.ends - base + first, text
        self.letters = words.letters
        self.scored = model.allowed[words.script].any(1) if len(model.langs) else np.zeros(len(text), bool)


class Labelled:
    """Words of a chunk of texts with their languages, and each text's language (its number, or the number of
    languages for none) and share of letters."""

    def __init__(self, model: Model, texts: arrays.Texts, switch: float):
        n = len(model.langs)
        self.count = texts.count
        if texts.count == 1 and len(texts.data) > CHUNK and n:
            parts, self.labels = self._in_pieces(model, texts, switch)
        else:
            words = LetterWords(texts)
            scores = model.scores(words) if n else np.zeros((len(words.starts), 0), np.float32)
            self.labels = viterbi(scores, words.word_bounds, switch) if n else np.zeros(len(scores), np.int32)
            parts = [Words(words, model, np.repeat(np.arange(words.count), np.diff(words.word_bounds)))]
        self.begin, self.end, self.text, each, scored = (np.concatenate([getattr(p, x) for p in parts]) for x in ("begin", "end", "text", "letters", "scored"))
        weight = np.zeros((self.count, max(n, 1)))
        np.add.at(weight, (self.text[scored], self.labels[scored]), each[scored])
        letters = np.bincount(self.text, weights=each, minlength=self.count)
        total = weight.sum(1)
        best = np.where(total > 0, weight.argmax(1), model.frequent)
        self.spoken = (letters > 0) & (n > 0)
        self.best = np.where(self.spoken, best, n)
        self.share = np.where(self.spoken & (total > 0), weight.max(1) / np.maximum(total, 1), 0.0)

    @staticmethod
    def _in_pieces(model: Model, texts: arrays.Texts, switch: float) -> tuple[list[Words], np.ndarray]:
        parts: list[Words] = []

        def scored() -> Iterator[np.ndarray]:
            first = 0
            for piece in arrays.pieces(texts, CHUNK):
                words = LetterWords(piece)
                parts.append(Words(words, model, np.zeros(len(words.starts), np.int64), first))
                first += len(words.code)
                yield model.scores(words)

        labels = viterbi_in_pieces(scored(), len(model.langs), switch)
        return parts, np.concatenate(labels)


def predict(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """Per row: doc_id, lang_pred, score and the spans (begin, end in code points, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of a number each language
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            for texts in arrays.chunks(batch.column(1), CHUNK):
                found = Labelled(model, texts, switch)
                made = [
                    batch.column(0)[texts.first : texts.first + texts.count], pa.array(names[found.best], pa.string()), pa.array(found.share),
                    _spans(found, model.langs, span),
                ]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "lang_pred", "score", "spans"])

    spans = "spans array<struct<begin: int, end: int, lang: string>>"
    return tables.keyed(docs).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, {spans}")


def _spans(found: Labelled, langs: list[str], kind: pa.DataType) -> pa.Array:
    text, labels = found.text, found.labels
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (labels[1:] != labels[:-1])]) if len(text) and langs else np.zeros(len(text), bool)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(text)]]) - 1 if len(first) else first
    values = pa.StructArray.from_arrays(
        [pa.array(found.begin[first].astype(np.int32)), pa.array(found.end[last].astype(np.int32)), pa.array([langs[k] for k in labels[first]], pa.string())],
        fields=list(kind),
    )
    ends = np.concatenate([[0], np.cumsum(np.bincount(text[first], minlength=found.count))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), values)


def identify(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Learns from the rows outside the held-out fold and predicts all; adds ``held_out``."""
    model = train(docs.filter(~tables.held_out("doc_id", folds)))
    return predict(docs, model).withColumn("held_out", tables.held_out("doc_id", folds))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(tables.read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def keep_identified(
    docs: DataFrame, folds: int = FOLDS, switch: float = SWITCH, min_score: float = 0.0, languages: set[str] | None = None
) -> DataFrame:
    """``docs``, all columns, without the rows whose language is not identified or not wanted.

    A row stays if its text has a language at all (not NULL, a letter in it), the predicted one is among ``languages``
    (None: any) and its score, the language's share of the letters, is ``min_score`` or more. With rows but none of
    them labelled there is nothing to learn languages from: that raises, instead of dropping or passing all.
    """
    model = train(docs.filter(~tables.held_out("doc_id", folds)))
    if not model.langs:
        if docs.isEmpty():
            return docs
        raise ValueError("no rows with text and language outside the held-out fold: no language can be identified")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")
    wanted = np.array([*(languages is None or lang in languages for lang in model.langs), False])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for texts in arrays.chunks(batch.column(column), CHUNK):
                found = Labelled(model, texts, switch)
                stays = found.spoken & wanted[found.best] & (found.share >= min_score)
                yield batch.slice(texts.first, texts.count).filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
