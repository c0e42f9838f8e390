"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its distinct words, hashed to ``HASHED`` buckets and weighted by damped count (their vector has
length 1), and one bin each of some statistics of its structure (lengths, shares of symbols, capitals, digits,
repeated and distinct words, ...) and of each metadata column. The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ],

so all pairwise interactions cost one pass over a text's features.

Weights are learned by full gradient steps (Adam): each step is a job over the written features of the training rows,
whose tasks return gradient sums of the model's fixed size. Training rows are the distinct labelled rows, or an even
choice of about ``TRAIN_DOCS`` of them by a hash of id and text. Of several labels of one id the mean counts.

NULL texts are empty; a text without words has bins only. NULL or negative metadata has a bin of its own. Repeated rows
get one result each, and count once in training. NULL ids are scored and never trained on. Without labelled rows of both
kinds every score is 0.5. A text beyond ``arrays.CHUNK_BYTES`` is read whole, in pieces that end at white space.
An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import arrays, tables
from railyard.llm.arrays import pieces

FOLDS = 5
TRAIN_DOCS = 20_000
HASHED = 1 << 13
RANK = 8
STEPS = 40
RATE, DECAY, SPREAD, SEED = 0.08, 2e-4, 0.02, 13
SLICES = 16
THRESHOLD = 0.3
METADATA = ("n_chars",)

SYMBOLS = b"#*$%&|<>{}[]\\^~=_@"
EDGES = np.array([0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8, 0.95, 1.0])
STATISTICS = (
    "words", "bytes", "word_bytes", "line_words", "symbols", "upper", "digits", "marks", "bars", "distinct", "repeated", "short", "long", "blank", "ends",
)
SIZES = {"words", "bytes", "word_bytes", "line_words"}  # binned by powers of two, the others are shares
BINS = 24


def classes(members: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(members)] = 1
    return table


_COUNTED = [classes(SYMBOLS), classes(bytes(range(0x41, 0x5B))), classes(bytes(range(0x30, 0x3A))), classes(b"!?"), classes(b"|"), classes(b"\n"), classes(b" \t\r\n\v\f"), classes(b".!?:;")]


class Rows:
    """Features of some texts: text ``owner``, feature number ``index`` and ``value``, sorted by text."""

    def __init__(self, owner: np.ndarray, index: np.ndarray, value: np.ndarray, count: int):
        self.owner, self.index, self.value, self.count = owner, index, value, count


def width(metadata: int) -> int:
    return HASHED + BINS * (len(STATISTICS) + metadata)


def features(texts: arrays.Texts, metadata: np.ndarray) -> Rows:
    """``metadata``: one row per text, one column per metadata column, NaN where NULL."""
    n = texts.count
    sums = np.zeros((len(_COUNTED), n))
    size = np.diff(texts.bounds).astype(float)
    n_words, word_bytes, repeated, short, long, ends = (np.zeros(n) for _ in range(6))
    owner, word, count = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0)
    for part in pieces(texts):
        for k, table in enumerate(_COUNTED):
            total = np.concatenate([[0], np.cumsum(table[part.data], dtype=np.int64)])
            sums[k] += total[part.bounds[1:]] - total[part.bounds[:-1]]
        words = part.words(arrays.PLAIN)
        hashes, lengths, of = words.hashes(), words.ends - words.starts, words.text
        n_words += words.counts
        word_bytes += np.bincount(of, lengths, n)
        short += np.bincount(of, lengths <= 3, n)
        long += np.bincount(of, lengths >= 14, n)
        ends += np.bincount(of, _COUNTED[-1][part.data[words.ends - 1]] > 0, n)
        same = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
        repeated += np.bincount(of[1:][same], minlength=n)
        # distinct words with their counts, merged with those of earlier pieces
        all_of, all_words = np.concatenate([owner, of]), np.concatenate([word, hashes])
        order = np.lexsort((all_words, all_of))
        all_of, all_words, weight = all_of[order], all_words[order], np.concatenate([count, np.ones(len(of))])[order]
        new = np.ones(len(order), bool)
        new[1:] = (all_of[1:] != all_of[:-1]) | (all_words[1:] != all_words[:-1])
        first = np.flatnonzero(new)
        owner, word, count = all_of[first], all_words[first], np.add.reduceat(weight, first) if len(first) else weight
    some, many = np.maximum(size, 1), np.maximum(n_words, 1)
    symbols, upper, digits, marks, bars, newlines, blank, _ = sums
    distinct = np.bincount(owner, minlength=n)
    values = (
        n_words, size, word_bytes / many, n_words / (newlines + 1), symbols / some, upper / some, digits / some, marks / some, bars / many, distinct / many,
        repeated / many, short / many, long / many, blank / some, ends / many,
    )
    bins = [logarithmic(v) if name in SIZES else np.searchsorted(EDGES, v) for name, v in zip(STATISTICS, values)]
    bins += [np.where(np.nan_to_num(m, nan=-1) < 0, BINS - 1, logarithmic(np.maximum(np.nan_to_num(m), 0))) for m in metadata.T]
    weight = np.log1p(count)
    norm = np.sqrt(np.bincount(owner, weight**2, n))
    all_owner = np.concatenate([owner, *[np.arange(n)] * len(bins)])
    index = np.concatenate([(word >> np.uint64(64 - HASHED.bit_length() + 1)).astype(np.int64), *(HASHED + BINS * k + b for k, b in enumerate(bins))])
    value = np.concatenate([weight / np.maximum(norm, 1e-9)[owner], np.ones(n * len(bins))])
    order = np.argsort(all_owner, kind="stable")
    return Rows(all_owner[order], index[order].astype(np.int32), value[order].astype(np.float32), n)


def logarithmic(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + x).astype(np.int64), BINS - 2)


class Machine:
    """``bias``, ``linear`` (feature) and ``factors`` (feature, RANK)."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear.astype(np.float32), factors.astype(np.float32)

    def margins(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of all terms, and the factor sums (text, RANK) that pairs are computed from."""
        linear = np.bincount(rows.owner, self.linear[rows.index] * rows.value, rows.count)
        scaled = self.factors[rows.index] * rows.value[:, None]
        first = np.searchsorted(rows.owner, np.arange(rows.count))  # every text has its bins
        sums = np.add.reduceat(scaled, first) if rows.count else np.zeros((0, RANK), np.float32)
        squares = np.add.reduceat((scaled**2).sum(1), first) if rows.count else np.zeros(0)
        return self.bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums

    def scores(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows)[0], -30, 30)))

    def gradient(self, rows: Rows, y: np.ndarray) -> np.ndarray:
        """Of the logistic loss summed over ``rows``, flat: bias, linear, factors; then the number of rows."""
        margin, sums = self.margins(rows)
        miss = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        each = miss[rows.owner] * rows.value
        size = len(self.linear)
        linear = np.bincount(rows.index, each, size)
        squares = np.bincount(rows.index, each * rows.value, size)
        factors = np.stack([np.bincount(rows.index, each * sums[rows.owner, f], size) for f in range(RANK)], 1) - self.factors * squares[:, None]
        return np.concatenate([[miss.sum()], linear, factors.ravel(), [len(y)]])


def featured(docs: DataFrame, metadata: tuple[str, ...], label: str | None = None) -> DataFrame:
    """(y, index, value) of rows with a text, metadata columns and a label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            meta = columns(batch, 2)
            for part in arrays.chunks(batch.column(1)):
                here = slice(part.first, part.first + part.count)
                rows = features(part, meta[here])
                bounds = pa.array(np.searchsorted(rows.owner, np.arange(rows.count + 1)).astype(np.int32))
                lists = (pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (rows.index, rows.value))
                yield pa.RecordBatch.from_arrays([batch.column(0)[here], *lists], names=["y", "index", "value"])

    return docs.select(F.col(label).cast("double").alias("y"), "text", *metadata).mapInArrow(run, "y double, index array<int>, value array<float>")


def columns(batch: pa.RecordBatch, first: int) -> np.ndarray:
    """Metadata columns of a batch as doubles, NaN where NULL."""
    found = [batch.column(k).cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for k in range(first, batch.num_columns)]
    return np.stack(found, 1) if found else np.zeros((batch.num_rows, 0))


def gradient_sum(rows: DataFrame, machine: Machine, size: int) -> np.ndarray:
    """The gradient over all rows: tasks add up their rows', slices of these meet and are added in a fixed order."""
    shared = rows.sparkSession.sparkContext.broadcast(machine)  # the model's fixed size
    cut = -(-size // SLICES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cut * SLICES)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                lists = part.column(1)
                owner = np.repeat(np.arange(len(part)), lists.value_lengths().to_numpy())
                made = Rows(owner, lists.flatten().to_numpy(), part.column(2).flatten().to_numpy(), len(part))
                total[:size] += shared.value.gradient(made, part.column(0).to_numpy())
        blobs = [total[k * cut : (k + 1) * cut].tobytes() for k in range(SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names=["slice", "blob"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, blob in zip(batch.column(1).to_pylist(), batch.column(2)):
                sums[k] = sums.get(k, 0.0) + np.frombuffer(blob.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "blob"])

    schema = "slice int, blob binary"
    dealt = rows.mapInArrow(run, schema).withColumn("task", F.spark_partition_id()).repartition(SLICES, "slice").sortWithinPartitions("slice", "task")
    out = np.zeros(cut * SLICES)
    for r in dealt.select("task", "slice", "blob").mapInArrow(add, schema).collect():  # SLICES rows of a fixed size
        out[r["slice"] * cut : (r["slice"] + 1) * cut] = np.frombuffer(r["blob"], np.float64)
    return out[:size]


def train(rows: DataFrame, n_features: int, steps: int = STEPS) -> Machine:
    """From written (y, index, value) rows of both kinds."""
    positive, n = rows.agg(F.coalesce(F.sum("y"), F.lit(0.0)), F.count("*")).first()
    bias = float(np.log(positive / (n - positive))) if 0 < positive < n else 0.0
    start = np.random.default_rng(SEED).normal(0, SPREAD, (n_features, RANK))
    theta = np.concatenate([[bias], np.zeros(n_features), start.ravel()])
    if not 0 < positive < n:
        return Machine(0.0, np.zeros(n_features), np.zeros((n_features, RANK)))
    mean = variance = np.zeros(len(theta))
    for step in range(1, steps + 1):
        found = gradient_sum(rows, machine_of(theta, n_features), len(theta) + 1)
        slope = found[:-1] / max(found[-1], 1) + DECAY * np.concatenate([[0], theta[1:]])
        mean, variance = 0.9 * mean + 0.1 * slope, 0.99 * variance + 0.01 * slope**2
        theta = theta - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(variance / (1 - 0.99**step)) + 1e-8)
    return machine_of(theta, n_features)


def machine_of(theta: np.ndarray, n_features: int) -> Machine:
    return Machine(float(theta[0]), theta[1 : 1 + n_features], theta[1 + n_features :].reshape(n_features, RANK))


def sampled(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...], folds: int, train_docs: int) -> DataFrame:
    """(y, text, metadata) of distinct labelled rows outside the held-out fold, about ``train_docs`` at most."""
    known = labels.filter("quality IN (0, 1)").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & ~tables.held_out("doc_id", folds))
    n = docs.select("doc_id").join(known, "doc_id").count()
    grid = 1 << 30
    limit = max(1, round(grid * min(1.0, train_docs / max(n, 1))))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(grid)) < limit).filter(~tables.held_out("doc_id", folds))
    # a repeated row meets its copies before the shuffle
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = chosen.join(known, "doc_id").groupBy("doc_id", key.alias("th"), "y").agg(F.first("text").alias("text"), *(F.max(m).alias(m) for m in metadata))
    return rows.select("y", "text", *metadata)


def score(
    docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = METADATA, folds: int = FOLDS, train_docs: int = TRAIN_DOCS, steps: int = STEPS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row: doc_id, held_out, score (of quality 1), predicted. Learns outside the held-out fold only."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", *metadata)
    rows = tables.written(featured(sampled(docs, labels, metadata, folds, train_docs), metadata, "y").repartition(16), "features")
    shared = spark.sparkContext.broadcast(train(rows, width(len(metadata)), steps))  # the model's fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            meta = columns(batch, 3)
            for part in arrays.chunks(batch.column(2)):
                here = slice(part.first, part.first + part.count)
                scores = shared.value.scores(features(part, meta[here])).astype(np.float64)
                made = [batch.column(0)[here], batch.column(1)[here], pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "held_out", "score", "predicted"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int"
    return docs.select("doc_id", tables.held_out("doc_id", folds).alias("held_out"), "text", *metadata).mapInArrow(run, schema)


def op13_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "labels"))
