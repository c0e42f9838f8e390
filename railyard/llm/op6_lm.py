"""Language-model scores by a hashed maximum-entropy model over a smoothed unigram measure.

The base measure gives a token (c + 0.1) / (N + 0.1 (V + 1)), from counts over all training rows. The model
multiplies it by exponentials of hashed context features: the word before, the word before that (a skip), and both
together. Its softmax is factored: a class by context, then a word within its class, both by all three features. The
``HEAD`` most frequent words are members of ``CLASSES`` classes; the last class holds all other words, each in one of
``BINS`` hashed bins, so there a group of bins and a bin within it are predicted by context and the base measure shares
the bin out among its words. The words of a context have rows: the most frequent ones of their own, every other one a
hashed row; both together have the hashed row of their two rows. So no word, and no context, is without weights, whatever
the size of the vocabulary; what is bounded is how many share a weight. Words unseen in training are in the bins too,
whose mass includes theirs. With all weights 0 the score is the base score.

Training. One pass of all training rows counts, for each softmax, its outcomes by each feature and how often each cell
(row of the word before, row of the skipped word) occurs. The likelihood depends on the rows through these counts alone,
so it is maximised over them: the three features' weights move in turn by the logarithm of observed over expected (an
iterative scaling step, which cannot lower it) until a round of the three gains less than ``TOLERANCE`` a token. Each
weight row also has ``PRIOR`` tokens of the base measure. The softmaxes do not depend on each other, so each is one
task. Counts and weights have a fixed size, whatever the corpus, and counts are whole numbers, so the weights do not
depend on how rows are dealt to tasks.

Counts of words grow with the corpus and are never broadcast: the ``HOT`` most frequent tokens' counts are, for all other
tokens documents and counts meet in a join.

NULL or empty text: no words, so one token, the end. Repeated rows each get a row. No training rows: N = V = 0, all
tokens unknown. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import arrays, tables

FOLDS = 10
HOT = 1 << 16
HEAD = 1024
CLASSES = 32
BINS = 1 << 10
TOLERANCE = 1e-4
SMOOTH = 0.1
PRIOR = 20.0
PART = 1 << 17
HELD_COUNTS = 2_000_000
END, BEGIN = np.uint64(0xE0D0E0D0E0D0E0D1), np.uint64(0xB0E0B0E0B0E0B0E1)


class Tokens:
    """Tokens of some texts: their words, each text closed by the end token."""

    def __init__(self, texts: arrays.Texts):
        words = texts.words(arrays.PLAIN)
        self.count = texts.count
        self.lengths = words.counts + 1
        self.bounds = np.concatenate([[0], np.cumsum(self.lengths)])
        total = int(self.bounds[-1])
        self.token = np.full(total, END, np.uint64)
        inside = np.ones(total, bool)
        inside[self.bounds[1:] - 1] = False
        self.token[inside] = words.hashes()
        self.text = np.repeat(np.arange(self.count), self.lengths)


class Grid:
    """Contexts: rows of the word before times rows of the skipped word, and hashed rows of both. Of each word's rows,
    the first are the most frequent words' own."""

    def __init__(self, before: tuple[int, int], skip: tuple[int, int], pairs: int):
        self.own = before, skip
        self.sizes = sum(before), sum(skip), pairs
        self.cells = self.sizes[0] * self.sizes[1]
        self.pair = (arrays.mix(np.arange(self.cells, dtype=np.uint64)) % np.uint64(pairs)).astype(np.int64)

    def rows(self, tokens: Tokens, number: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each token: the rows of the three features, and the cell."""
        first, second = (_row(tokens.token, number, *own) for own in self.own)
        begin = [int(_row(np.array([BEGIN]), np.array([-1]), *own)[0]) for own in self.own]
        start = tokens.bounds[:-1]
        before = np.concatenate([first[:1], first[:-1]])
        before[start] = begin[0]
        skip = np.concatenate([second[:2], second[:-2]])[: len(second)]
        skip[start] = begin[1]
        after = start[tokens.lengths > 1] + 1
        skip[after] = begin[1]
        cell = before * self.sizes[1] + skip
        return before, skip, self.pair[cell], cell


def _row(token: np.ndarray, number: np.ndarray, own: int, hashed: int) -> np.ndarray:
    other = own + (token >> np.uint64(32) & np.uint64(hashed - 1)).astype(np.int64)
    return np.where((number >= 0) & (number < own), number, other)


class Softmaxes:
    """``count`` softmaxes of ``width`` outcomes by contexts of a grid, and where their numbers lie in a vector: for each
    its sums by the rows of the three features, then its cells; or weights, and less the logarithm of the cell's norm."""

    def __init__(self, grid: Grid, count: int, width: int, first: int):
        self.grid, self.count, self.width, self.first = grid, count, width, first
        self.starts = np.cumsum([0, *(size * width for size in grid.sizes)])
        self.size = int(self.starts[3]) + grid.cells
        self.end = first + count * self.size

    def places(self, which: np.ndarray | int, outcome: np.ndarray, rows: tuple[np.ndarray, ...]) -> list[np.ndarray]:
        at = self.first + which * self.size
        return [at + start + row * self.width + outcome for start, row in zip(self.starts, rows[:3])] + [at + self.starts[3] + rows[3]]

    def span(self, which: int) -> slice:
        return slice(self.first + which * self.size, self.first + (which + 1) * self.size)


# One softmax over classes; then those of words in each class, of groups of bins, and of bins in each group.
GROUP = BINS // CLASSES
BY_CLASS = Softmaxes(Grid((512, 512), (128, 128), 1 << 13), 1, CLASSES + 1, 0)
BY_WORD = Softmaxes(Grid((256, 256), (64, 64), 1 << 10), 2 * CLASSES + 1, HEAD // CLASSES, BY_CLASS.end)
ALL = [(BY_CLASS, 0), *((BY_WORD, k) for k in range(BY_WORD.count))]
SIZE = BY_WORD.end


def token_places(head: Head, tokens: Tokens, number: np.ndarray) -> list[tuple[np.ndarray | slice, list[np.ndarray]]]:
    """Per step of the factored softmax: the tokens that take it, and the places of their numbers."""
    kind, every = head.classes(number), slice(None)
    rows = BY_WORD.grid.rows(tokens, number)
    inside, outside = np.flatnonzero(kind < CLASSES), np.flatnonzero(kind == CLASSES)
    within, beyond = tuple(r[inside] for r in rows), tuple(r[outside] for r in rows)
    group, place = np.divmod(bin_of(tokens.token[outside]), GROUP)
    return [
        (every, BY_CLASS.places(0, kind, BY_CLASS.grid.rows(tokens, number))),
        (inside, BY_WORD.places(kind[inside], number[inside] % head.size, within)),
        (outside, BY_WORD.places(CLASSES, group, beyond)),
        (outside, BY_WORD.places(CLASSES + 1 + group, place, beyond)),
    ]


def bin_of(token: np.ndarray) -> np.ndarray:
    return (token & np.uint64(BINS - 1)).astype(np.int64)


def binned(counts: DataFrame) -> np.ndarray:
    """Per bin: the counts of its tokens, each smoothed."""
    out = np.zeros(BINS)
    per_bin = counts.groupBy(F.col("token").bitwiseAND(F.lit(BINS - 1)).alias("bin")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    for r in per_bin.collect():  # at most BINS rows
        out[r["bin"]] = r["n"] + SMOOTH * r["v"]
    return out


class Head:
    """The most frequent tokens: their numbers by rank, base probabilities and classes (equal runs of ranks); and the
    shares of the bins in the base measure of all others."""

    def __init__(self, hot: np.ndarray, counts: np.ndarray, n: int, v: int, in_bins: np.ndarray):
        self.total = n + SMOOTH * (v + 1)
        mass = in_bins - np.bincount(bin_of(hot[:HEAD]), weights=counts[:HEAD] + SMOOTH, minlength=BINS)
        # the one unseen word of the base measure is spread over the bins
        mass = np.maximum(mass, 0) + SMOOTH / BINS
        self.bins = mass / mass.sum()
        self.index, self.counts = arrays.Index(hot), counts
        head = (counts[:HEAD] + SMOOTH) / self.total
        self.base = np.concatenate([head, np.zeros(HEAD - len(head))])
        self.size = HEAD // CLASSES
        of_class = self.base.reshape(CLASSES, self.size).sum(1)
        # a class without words (fewer tokens than HEAD) keeps a trace of probability
        self.of_class = np.maximum(np.concatenate([of_class, [1 - of_class.sum()]]), 1e-12)
        self.log_class = np.log(self.of_class).astype(np.float32)
        inner = self.base.reshape(CLASSES, self.size) / np.maximum(of_class, 1e-12)[:, None]
        self.inner = np.where(inner > 0, inner, 1e-12)

    def measure(self, softmaxes: Softmaxes, which: int) -> np.ndarray:
        """The base measure of a softmax's outcomes."""
        groups = self.bins.reshape(CLASSES, GROUP)
        if softmaxes is BY_CLASS:
            found = self.of_class
        elif which < CLASSES:
            found = self.inner[which]
        else:
            found = groups.sum(1) if which == CLASSES else groups[which - CLASSES - 1]
        return found / found.sum()

    def classes(self, number: np.ndarray) -> np.ndarray:
        return np.where((number >= 0) & (number < HEAD), number // self.size, CLASSES)


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, n) over all rows; a task gives one row a token, or some more where it has very many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in arrays.chunks(batch.column(0)):
                new, counts = np.unique(Tokens(part).token, return_counts=True)
                token, back = np.unique(np.concatenate([token, new]), return_inverse=True)
                n = sum64(np.concatenate([n, counts]), back, len(token))
                if len(token) > HELD_COUNTS:
                    yield pa.RecordBatch.from_arrays([arrays.as_long(token), pa.array(n)], names=["token", "n"])
                    token, n = token[:0], n[:0]
        yield pa.RecordBatch.from_arrays([arrays.as_long(token), pa.array(n)], names=["token", "n"])

    return texts.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def sum64(value: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(owner, weights=value, minlength=size).astype(np.int64)


def fitted(seen: np.ndarray, measure: np.ndarray, softmaxes: Softmaxes, tolerance: float = TOLERANCE) -> np.ndarray:
    """The weights of one softmax and less the logarithms of its norms, by its sums."""
    grid, width = softmaxes.grid, softmaxes.width
    goals = [seen[a:b].reshape(-1, width) for a, b in zip(softmaxes.starts, softmaxes.starts[1:])]
    cells = np.flatnonzero(seen[softmaxes.starts[3] :])
    often = seen[softmaxes.starts[3] :][cells]
    rows = [cells // grid.sizes[1], cells % grid.sizes[1], grid.pair[cells]]
    orders = [np.argsort(row, kind="stable") for row in rows]
    firsts = [np.flatnonzero(np.diff(row[order], prepend=-1)) for row, order in zip(rows, orders)]
    theta = [np.zeros(goal.shape) for goal in goals]
    start = np.log(measure)
    x = np.repeat(start.astype(np.float32)[None], len(cells), axis=0)
    before = -np.inf
    while len(cells):
        for k, goal in enumerate(goals):
            p = np.exp(x)
            norm = p.sum(1)
            if k == 0:
                value = likelihood(goals, theta, measure, often, norm)
                if value - before < tolerance * often.sum():
                    return np.concatenate([*(t.ravel() for t in theta), norms(theta, start, grid)]).astype(np.float32)
                before = value
            p *= (often / norm).astype(np.float32)[:, None]
            seen_rows = rows[k][orders[k][firsts[k]]]
            mean = np.add.reduceat(p[orders[k]], firsts[k], axis=0).astype(np.float64)
            own = measure * np.exp(theta[k][seen_rows])
            own /= own.sum(1, keepdims=True)
            move = np.zeros(goal.shape)
            move[seen_rows] = np.log((goal[seen_rows] + PRIOR * measure) / (mean + PRIOR * own))
            theta[k] += move
            x += move.astype(np.float32)[rows[k]]
    return np.zeros(softmaxes.size, np.float32)


def likelihood(goals: list[np.ndarray], theta: list[np.ndarray], measure: np.ndarray, often: np.ndarray, norm: np.ndarray) -> float:
    """What training maximises: the gain of all tokens over the base measure, those of the prior included."""
    prior = sum(float((t @ measure - np.log(np.exp(t) @ measure)).sum()) for t in theta)
    return sum(float((g * t).sum()) for g, t in zip(goals, theta)) - float(often @ np.log(norm.astype(np.float64))) + PRIOR * prior


def norms(theta: list[np.ndarray], start: np.ndarray, grid: Grid) -> np.ndarray:
    """Less the logarithm of the norm of every cell, seen or not."""
    out = []
    for row, pairs in zip(theta[0], grid.pair.reshape(grid.sizes[0], -1)):
        out.append(-np.log(np.exp(start + row + theta[1] + theta[2][pairs]).sum(1)))
    return np.concatenate(out)


def count(head: Head, tokens: Tokens, vector: np.ndarray) -> None:
    for _, places in token_places(head, tokens, head.index.find(tokens.token)):
        for place in places:
            np.add.at(vector, place, 1)


def cut(vector: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(softmax, part, blob): the numbers of each softmax in parts."""
    for k, (softmaxes, which) in enumerate(ALL):
        mine = vector[softmaxes.span(which)]
        blobs = [zlib.compress(mine[at : at + PART].tobytes(), 1) for at in range(0, len(mine), PART)]
        yield pa.RecordBatch.from_arrays([pa.array([k] * len(blobs), pa.int32()), pa.array(range(len(blobs)), pa.int32()), pa.array(blobs, pa.binary())], names=["softmax", "part", "blob"])


def fitted_to(head: Head, k: int, seen: np.ndarray, tolerance: float) -> np.ndarray:
    softmaxes, which = ALL[k]
    return fitted(seen, head.measure(softmaxes, which), softmaxes, tolerance)


def train(texts: DataFrame, head: Head, tolerance: float = TOLERANCE) -> np.ndarray:
    """The weights of all softmaxes, as ``Softmaxes`` lays them out."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, vector = shared.value, np.zeros(SIZE, np.int32)
        for batch in batches:
            for part in arrays.chunks(batch.column(0)):
                count(head, Tokens(part), vector)
        yield from cut(vector)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                new = np.frombuffer(zlib.decompress(blob.as_buffer()), np.int32)
                sums[k, part] = sums[k, part] + new if (k, part) in sums else new.astype(np.int64)
        for (k, part), numbers in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([numbers.tobytes()], pa.binary())], names=["softmax", "part", "blob"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for k, part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found.setdefault(k, {})[part] = np.frombuffer(blob.as_buffer(), np.int64)
        for k, parts in found.items():
            weights = fitted_to(shared.value, k, np.concatenate([parts[j] for j in sorted(parts)]).astype(np.float64), tolerance)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([weights.tobytes()], pa.binary())], names=["softmax", "blob"])

    schema = "softmax int, part int, blob binary"
    dealt = texts.select("text").mapInArrow(observed, schema).repartition("softmax", "part").mapInArrow(add, schema)
    out = np.zeros(SIZE, np.float32)
    for r in dealt.repartition(len(ALL), "softmax").mapInArrow(fit, "softmax int, blob binary").collect():  # a row of a fixed size per softmax
        softmaxes, which = ALL[r["softmax"]]
        out[softmaxes.span(which)] = np.frombuffer(r["blob"], np.float32)
    return out


def score(docs: DataFrame, folds: int = FOLDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = tables.keyed(docs)
    training = docs.filter(~tables.held_out("doc_id", folds))
    counts = tables.written(token_counts(training), "counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("n"), "token").limit(HOT).collect()  # at most HOT rows
    head = Head(np.array([r["token"] for r in top], np.int64).view(np.uint64), np.array([r["n"] for r in top], np.int64), n, v, binned(counts))
    shared = spark.sparkContext.broadcast((head, train(training, head, tolerance)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weights = shared.value
        log_c = np.log10(head.counts + SMOOTH)
        for batch in batches:
            for part in arrays.chunks(batch.column(2)):
                tokens = Tokens(part)
                number = head.index.find(tokens.token)
                gain = np.zeros(len(number))
                for taken, places in token_places(head, tokens, number):
                    for place in places:
                        gain[taken] += weights[place]
                hot = number >= 0
                base = np.where(hot, log_c[np.maximum(number, 0)], 0.0) if len(log_c) else np.zeros(len(number))
                sums = [np.add.reduceat(x, tokens.bounds[:-1]) for x in (base, gain, hot.astype(np.int64))]
                # tokens whose counts are elsewhere, once a text
                rest = np.flatnonzero(~hot)
                order = rest[np.lexsort((tokens.token[rest], tokens.text[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (tokens.token[order][1:] != tokens.token[order][:-1]) | (tokens.text[order][1:] != tokens.text[order][:-1])
                first = np.flatnonzero(new)
                often = np.diff(np.concatenate([first, [len(order)]])).astype(np.int32)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(tokens.text[order[first]], minlength=part.count))]).astype(np.int32))
                here = slice(part.first, part.first + part.count)
                made = [
                    batch.column(0)[here], batch.column(1)[here], pa.array(tokens.lengths.astype(np.int64)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1] / np.log(10)),
                    pa.ListArray.from_arrays(ends, arrays.as_long(tokens.token[order[first]])), pa.ListArray.from_arrays(ends, pa.array(often)),
                ]
                yield pa.RecordBatch.from_arrays(made, names=[tables.ROW, "doc_id", "n_tokens", "n_hot", "base", "gain", "rest", "often"])

    rows = docs.select(F.monotonically_increasing_id().alias(tables.ROW), "doc_id", "text")
    schema = f"{tables.ROW} long, doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, n_hot long, base double, gain double, rest array<long>, often array<int>"
    scored = tables.written(rows.mapInArrow(run, schema), "scored")
    cold = scored.select(tables.ROW, F.explode(F.arrays_zip("rest", "often")).alias("r")).select(tables.ROW, F.col("r.rest").alias("token"), F.col("r.often").alias("often"))
    per_row = (
        cold.join(counts, "token", "left")
        .groupBy(tables.ROW)
        .agg(
            F.sum(F.col("often") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("cold_base"),
            F.sum(F.when(F.col("n").isNotNull(), F.col("often")).otherwise(0)).alias("cold_known"),
        )
    )
    base = F.col("base") + F.coalesce("cold_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(float(np.log10(head.total)))
    return scored.join(per_row, tables.ROW, "left").select(
        "doc_id", tables.held_out("doc_id", folds).alias("held_out"), "n_tokens", (F.col("n_hot") + F.coalesce("cold_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"),
    )


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(tables.read(spark, sf_dir, "documents"))
