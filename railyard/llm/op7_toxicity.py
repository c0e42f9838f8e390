"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: INSULT and THREAT by lexicon, TARGET, NOT, SAID and QUOTE by short fixed lists, anything else a
plain word. What scores is the sum of the lexicon's weights in a clause, of a lone word too. Three small transducers
read a clause's symbols and write factors: one raises weights next to a target, one lowers them after a negation, one
lowers them in reported speech, quotations of several sentences of a line included. They are composed once into a
single automaton. There are no patterns of insults or threats, which are treated alike; the README has figures.

The lexicon is learned: words and word beginnings that stand out in toxic training rows, with their log odds as
weights. At most about ``TRAIN_DOCS`` labelled rows are read for it (an even choice by a hash of the id), and at most
``LEXICON`` entries are kept. A text's clauses give a few sums, which a logistic regression on the same rows turns
into a probability.

NULL or empty texts score as a text without any matched clause. Without labelled rows of both kinds every text gets
the score 0.5 of an untrained model. Repeated rows get one result each; several labels of one id count each.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import tables

FOLDS = 5
TRAIN_DOCS = 20_000
LEXICON = 4000
MIN_DOCS = 3
STEMS = (3, 4, 5, 6)
MIN_ODDS = 2.5

# Function words of the grammar in the four languages of the texts.
TARGETS = frozenset("you your yours yourself he him his she her they them their du dich dir dein ihr euch tu toi ton vous votre tú tu usted ustedes".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't nicht kein keine nie pas jamais aucun nunca ningún jamás".split())
REPORTING = frozenset("said says say wrote writes called calls quoted according sagte sagt schrieb dit disait écrit dijo dice escribió".split())
THREATS = frozenset("kill hurt destroy beat töten schlagen tuer frapper matar golpear".split())
QUOTES = "\"“”„«»"

SYMBOLS = ("word", "insult", "threat", "target", "not", "said", "quote", "end")
WORD, INSULT, THREAT, TARGET, NOT, SAID, QUOTE, END = range(len(SYMBOLS))
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[\"“”„«»]|[.!?;:\n|]+")


class Transducer:
    """States 0..n-1, start 0. ``arcs[state][symbol]`` is (next state, factor): what a weight at this symbol is
    multiplied by. Symbols not listed go back to ``rest`` with factor 1."""

    def __init__(self, arcs: list[dict[int, tuple[int, float]]], rest: list[int]):
        self.arcs, self.rest = arcs, rest

    def step(self, state: int, symbol: int) -> tuple[int, float]:
        return self.arcs[state].get(symbol, (self.rest[state], 1.0))

    def compose(self, other: "Transducer") -> "Transducer":
        """Both read the same symbols; factors multiply. Only pairs of states that can be reached are built."""
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], []
        rest: list[int] = []
        while len(arcs) < len(todo):
            a, b = todo[len(arcs)]
            row = {}
            for symbol in range(len(SYMBOLS)):
                (next_a, fa), (next_b, fb) = self.step(a, symbol), other.step(b, symbol)
                if (next_a, next_b) not in number:
                    number[next_a, next_b] = len(todo)
                    todo.append((next_a, next_b))
                row[symbol] = (number[next_a, next_b], fa * fb)
            arcs.append(row)
            rest.append(row[WORD][0])
        return Transducer(arcs, rest)


def near(opening: int, reach: int, factor: float) -> Transducer:
    """After ``opening``, insults and threats within ``reach`` words count ``factor`` times."""
    arcs: list[dict[int, tuple[int, float]]] = [{opening: (1, 1.0)}]
    rest = [0]
    for k in range(1, reach + 1):
        after = k + 1 if k < reach else 0
        arcs.append({opening: (1, 1.0), INSULT: (after, factor), THREAT: (after, factor), END: (0, 1.0)})
        rest.append(after)
    return Transducer(arcs, rest)


def reported(factor: float) -> Transducer:
    """Inside quotation marks, and in the rest of a clause after a verb of saying, weights count ``factor`` times."""
    lowered = {INSULT: (1, factor), THREAT: (1, factor), QUOTE: (0, 1.0)}
    said = {INSULT: (2, factor), THREAT: (2, factor), QUOTE: (1, 1.0), END: (0, 1.0)}
    return Transducer([{QUOTE: (1, 1.0), SAID: (2, 1.0)}, lowered, said], [0, 1, 2])


def grammar() -> Transducer:
    return near(TARGET, 4, 1.5).compose(near(NOT, 2, 0.4)).compose(reported(0.5))


class Lexicon:
    """Weights of words and of word beginnings (marked by a trailing ``*``)."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        if word not in self.known:
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[word] = max((self.weights.get(x, 0.0) for x in forms(word)), default=0.0)
        return self.known[word]


def forms(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


_GRAMMAR = grammar()
FEATURES = 5


def features(text: str, lexicon: Lexicon) -> np.ndarray:
    """Of a text's clause scores: greatest, sum (damped), number of scoring clauses (damped), hits a word, any hit."""
    arcs, weight_of = _GRAMMAR.arcs, lexicon.weight
    state, clause, words, hits = 0, 0.0, 0, 0
    best = total = 0.0
    scoring = 0
    for token in TOKEN.findall(text.lower()):
        if token[0] in ".!?;:\n|":
            if clause > 0:
                best, total, scoring = max(best, clause), total + clause, scoring + 1
            state, clause = 0 if "\n" in token or "|" in token else arcs[state][END][0], 0.0
            continue
        words += 1
        weight = weight_of(token)
        if weight > 0:
            symbol, hits = INSULT, hits + 1
        elif token in THREATS:
            symbol, weight = THREAT, 0.5
        elif token in TARGETS:
            symbol = TARGET
        elif token in NEGATIONS:
            symbol = NOT
        elif token in REPORTING:
            symbol = SAID
        elif token in QUOTES:
            symbol = QUOTE
        else:
            symbol = WORD
        state, factor = arcs[state][symbol]
        clause += weight * factor
    if clause > 0:
        best, total, scoring = max(best, clause), total + clause, scoring + 1
    return np.array([min(best, 20.0), math.log1p(total), math.log1p(scoring), min(20.0, 100.0 * hits / max(words, 1)), float(hits > 0)])


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, center: np.ndarray, scale: np.ndarray):
        self.lexicon, self.weights, self.center, self.scale = lexicon, weights, center, scale

    def score(self, text: str | None) -> float:
        x = (features(text or "", self.lexicon) - self.center) / self.scale
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.weights[0] + x @ self.weights[1:]))))))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """From (text, toxic): log odds of words and beginnings by the rows they occur in. The caller leaves a
    quarter of the rows for the regression, which so sees the weights as they work on new texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {t for t in TOKEN.findall((text or "").lower()) if t[0].isalpha()}
                into = counts[toxic]
                for form in set(itertools.chain.from_iterable(map(forms, words))):
                    into[form] = into.get(form, 0) + 1
        names = list(counts[0].keys() | counts[1].keys())
        made = [pa.array(names, pa.string()), *(pa.array([c.get(x, 0) for x in names], pa.int64()) for c in counts)]
        yield pa.RecordBatch.from_arrays(made, names=["form", "clean", "toxic"])

    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return {}
    counted = rows.select("text", "toxic").mapInArrow(run, "form string, clean long, toxic long").groupBy("form").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.2) / F.lit(totals[1] + 0.4)) - F.log((F.col("clean") + 0.2) / F.lit(totals[0] + 0.4))
    # the lower end of the odds: rare words need to stand out more
    sure = odds - 1.0 / F.sqrt(F.col("toxic") + 0.2) - F.lit(0.5) / F.sqrt(F.col("clean") + 0.2) / 2
    top = counted.filter(F.col("toxic") >= MIN_DOCS).withColumn("odds", sure).filter(F.col("odds") >= MIN_ODDS - 1)
    top = top.filter(F.col("toxic") * F.lit(totals[0]) > F.col("clean") * F.lit(8.0 * totals[1]))
    rows_kept = top.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "form").limit(LEXICON).collect()
    return {r["form"]: min(6.0, r["odds"]) for r in rows_kept}


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """From (doc_id, text, toxic) with toxic 0 or 1."""
    n = labelled.count()
    grid = 1 << 20
    limit = max(1, round(grid * min(1.0, train_docs / max(n, 1))))
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(grid)) < limit)
    sample = tables.written(sample.select("doc_id", "text", "toxic").repartition(64, "doc_id"), "labelled")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4))
    plain = np.zeros(FEATURES)
    lexicon = learn_lexicon(sample.filter(fold != 0))
    if not lexicon:
        return Model(Lexicon({}), np.zeros(FEATURES + 1), plain, plain + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lexicon(lexicon)
        for batch in batches:
            values = [features(t or "", known) for t in batch.column(0).to_pylist()]
            made = [pa.array([v.tolist() for v in values], pa.list_(pa.float64())), batch.column(1)]
            yield pa.RecordBatch.from_arrays(made, names=["x", "toxic"])

    found = sample.filter(fold == 0).select("text", "toxic").mapInArrow(run, "x array<double>, toxic int").collect()  # at most about TRAIN_DOCS / 4 small rows
    x, y = np.array([r["x"] for r in found]).reshape(-1, FEATURES), np.array([r["toxic"] for r in found], float)
    if not len(y) or y.min() == y.max():
        return Model(Lexicon(lexicon), np.zeros(FEATURES + 1), plain, plain + 1)
    center, scale = x.mean(0), x.std(0) + 1e-6
    return Model(Lexicon(lexicon), regression((x - center) / scale, y), center, scale)


def regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the ridge keeps separable data finite."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return w


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LEXICON entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(1)]
            made = [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "score", "predicted"])

    return tables.keyed(docs).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int")


def score(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Learns from the labelled rows outside the held-out fold and scores all rows of ``docs``."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1) AND doc_id IS NOT NULL")
    known = known.filter(~tables.held_out("doc_id", folds))
    model = fit(tables.keyed(docs).join(known, "doc_id"))
    return predict(docs, model).withColumn("held_out", tables.held_out("doc_id", folds))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")
