"""Personal data by candidate generation and gradient boosting, with DataFrame functions only.

* Generators. For each kind a base pattern and a wider one propose spans, which may overlap.
* Features of a candidate's format and context are small integers: kind, number of digits, a check (Luhn digits,
  octets), separators, a leading plus, a cue word before it, a letter or digit after it.
* Training. Base candidates that pass their kind's check are positive, the others negative. One pass over all texts
  counts the feature combinations; there are at most ``GRID`` of them, whatever the corpus. Shallow trees are boosted
  on that table, their sum is calibrated by a logistic curve, and each kind gets the lowest threshold whose
  selection is at least ``PRECISION`` positive.
* Scoring. The trees are compiled into one SQL expression, evaluated per candidate beside the patterns.

Base spans always stay; wider candidates above their threshold are added unless a base span covers them.

Patterns are written so that no text takes more than linear time: a run of letters is entered at its beginning only,
and repetitions never give back. Offsets are code points, ends exclusive. NULL counts as the empty text; texts without
a candidate, and empty tables, give no spans (then nothing is learned and only base spans are returned). Repeated
rows each get a row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import tables
from railyard.llm.op5_quality import let

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
PRECISION = 0.95
TREES, DEPTH, RATE = 30, 3, 0.3
CONTEXT = 24

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# The base patterns, entered only where a match can begin (or where the last one ended).
BASE = {
    EMAIL: r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    CARD: r"[0-9](?:[\x20-]?[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    EMAIL: r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    IP: rf"(?<![0-9]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])",
    CARD: r"(?<![0-9])[0-9]{4}([\x20.-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    PHONE: r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
CUES = r"(?i)(?:mail|contact|write|tel|phone|call|fax|mobile|card|visa|credit|account|ip|host|server|address)[^A-Za-z]{0,4}$"

FEATURES = ("kind", "digits", "check", "separators", "plus", "cue", "tail")
LEVELS = (4, 22, 2, 8, 2, 2, 2)
GRID = int(np.prod(LEVELS))
BLOCK = 256


def running(values: Column) -> Column:
    """Running sums of an array, in blocks, so that long arrays take no quadratic time."""

    def append(part: Column, start: Column) -> Column:
        empty = F.struct(F.array().cast("array<int>").alias("out"), start.alias("sum"))
        return F.aggregate(part, empty, lambda a, v: F.struct(F.concat(a["out"], F.array(a["sum"] + v)).alias("out"), (a["sum"] + v).alias("sum")), lambda a: a["out"])

    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda g: F.slice(v, g * BLOCK + 1, F.lit(BLOCK)))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, v: a + v))
        starts = F.concat(F.array(F.lit(0)), append(totals, F.lit(0)))
        return F.flatten(F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), append))

    return let(values, lambda v: let(blocks(v), joined))


def candidates(text: Column, kind: int, wide: bool) -> Column:
    """(start, kind, end, wide, word, before, after) of each match."""
    pattern = (WIDE if wide else BASE)[kind]

    def located(found: Column) -> Column:
        pieces = F.split(text, pattern, -1)

        def spans(p: Column) -> Column:
            sizes = F.zip_with(F.slice(p, F.lit(1), F.size(found)), found, lambda a, m: F.length(a) + F.length(m))
            around = F.zip_with(F.slice(p, F.lit(1), F.size(found)), F.slice(p, F.lit(2), F.size(found)), lambda a, b: F.struct(F.right(a, F.lit(CONTEXT)).alias("before"), F.left(b, F.lit(1)).alias("after")))
            ends = F.zip_with(running(sizes), around, lambda e, c: F.struct(e.alias("end"), c["before"].alias("before"), c["after"].alias("after")))
            return F.zip_with(ends, found, lambda e, m: F.struct(
                (e["end"] - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e["end"].alias("end"), F.lit(wide).alias("wide"),
                m.alias("word"), e["before"].alias("before"), e["after"].alias("after"),
            ))

        return F.when(F.size(found) == 0, F.array().cast(SPAN)).otherwise(let(pieces, spans))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


SPAN = "array<struct<start: int, kind: int, end: int, wide: boolean, word: string, before: string, after: string>>"


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.length(digits) - i + 1, F.lit(1))) - 48
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def octets(word: Column) -> Column:
    parts = F.transform(F.split(word, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: F.when(F.length(p) > 3, False).otherwise(F.concat(F.lit("0"), F.left(p, F.lit(3))).cast("int") <= 255))


def described(c: Column) -> Column:
    """A candidate with its features and whether it passes its kind's base rule."""

    def parts(digits: Column) -> Column:
        n = F.length(digits)
        check = F.when(c["kind"] == CARD, F.when((n >= 14) & (n <= 19), luhn(digits)).otherwise(False)).when(c["kind"] == IP, octets(c["word"])).otherwise(True)

        def whole(ok: Column) -> Column:
            valid = F.when(c["kind"] == CARD, ok & (n >= 14) & (n <= 19)).when(c["kind"] == PHONE, (n >= 10) & (n <= 15)).otherwise(ok)
            marks = F.when(F.contains(c["word"], F.lit(" ")), 1).otherwise(0) + F.when(F.contains(c["word"], F.lit("-")), 2).otherwise(0) + F.when(c["word"].rlike(r"[().]"), 4).otherwise(0)
            return F.struct(
                c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["wide"].alias("wide"), (valid & ~c["wide"]).alias("base"),
                F.least(n, F.lit(LEVELS[1] - 1)).alias("digits"), ok.cast("int").alias("check"), marks.alias("separators"),
                F.startswith(c["word"], F.lit("+")).cast("int").alias("plus"), c["before"].rlike(CUES).cast("int").alias("cue"), c["after"].rlike("[A-Za-z0-9]").cast("int").alias("tail"),
            )

        return let(check, whole)

    return let(F.regexp_replace(c["word"], "[^0-9]", ""), parts)


def proposed(docs: DataFrame) -> DataFrame:
    """doc_id, text and all candidates of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digits, at = text.rlike("[0-9]"), F.contains(text, F.lit("@")) | text.rlike(r"[(\[]at[)\]]")
    empty = F.array().cast(SPAN)
    found = F.concat(*[F.when(at if kind == EMAIL else digits, candidates(text, kind, wide)).otherwise(empty) for kind in range(4) for wide in (False, True)])
    return docs.select("doc_id", "text", F.transform(found, described).alias("candidates"))


# ---- Boosted trees on the table of feature combinations ------------------------------------------------


class Split(NamedTuple):
    feature: int
    level: int  # left: feature <= level
    left: "Split | float"
    right: "Split | float"


@dataclass
class Model:
    trees: list = field(default_factory=list)
    curve: tuple[float, float] = (0.0, 1.0)
    thresholds: tuple[float, ...] = (2.0,) * 4  # by kind; a probability above 1 selects nothing


def grow(x: np.ndarray, residual: np.ndarray, hessian: np.ndarray, depth: int) -> Split | float:
    """A regression tree by the second-order gain; leaves hold Newton steps."""
    g, h = residual.sum(), hessian.sum()
    leaf = float(np.clip(g / (h + 1.0), -4, 4))
    if depth == 0:
        return leaf
    best = None
    for f in range(x.shape[1]):
        by_level_g, by_level_h = (np.bincount(x[:, f], weights=w, minlength=LEVELS[f]) for w in (residual, hessian))
        left_g, left_h = np.cumsum(by_level_g)[:-1], np.cumsum(by_level_h)[:-1]
        gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
        if len(gain) and (best is None or gain.max() > best[0]):
            best = (gain.max(), f, int(gain.argmax()))
    if best is None or best[0] < 1e-6:
        return leaf
    left = x[:, best[1]] <= best[2]
    if left.all() or not left.any():
        return leaf
    return Split(best[1], best[2], grow(x[left], residual[left], hessian[left], depth - 1), grow(x[~left], residual[~left], hessian[~left], depth - 1))


def apply(tree: Split | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, Split):
        return np.full(len(x), tree)
    return np.where(x[:, tree.feature] <= tree.level, apply(tree.left, x), apply(tree.right, x))


def boost(x: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> Model:
    """Logistic boosting on combinations ``x`` that occur so often with either label."""
    model, n = Model(), positive + negative
    if not n.sum():
        return model
    weight = n / n.sum() * min(n.sum(), 1e4)
    share = positive / np.maximum(n, 1)
    raw = np.zeros(len(x))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        tree = grow(x, weight * (share - p), weight * p * (1 - p), DEPTH)
        model.trees.append(tree)
        raw += RATE * apply(tree, x)
    model.curve = calibrate(raw, share, weight)
    p = 1 / (1 + np.exp(-(model.curve[0] + model.curve[1] * raw)))
    model.thresholds = tuple(threshold(p[x[:, 0] == k], positive[x[:, 0] == k], n[x[:, 0] == k]) for k in range(4))
    return model


def calibrate(raw: np.ndarray, share: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """The logistic curve of the scores, by Newton steps with a small ridge."""
    a, b = 0.0, 1.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a + b * raw, -30, 30)))
        r, h = weight * (share - p), weight * p * (1 - p)
        grad = np.array([r.sum(), (r * raw).sum() - 0.1 * (b - 1)])
        hess = np.array([[h.sum() + 1e-3, (h * raw).sum()], [(h * raw).sum(), (h * raw**2).sum() + 0.1]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + step[0], b + step[1]
    return float(a), float(max(b, 0.1))


def threshold(p: np.ndarray, positive: np.ndarray, n: np.ndarray) -> float:
    """The lowest probability from which on the selection is precise enough; 2 if there is none."""
    order = np.argsort(-p, kind="stable")
    precise = np.cumsum(positive[order]) >= PRECISION * np.cumsum(n[order])
    ends = np.concatenate([p[order][1:] != p[order][:-1], [True]]) if len(p) else np.zeros(0, bool)
    good = np.flatnonzero(precise & ends)
    return float(p[order][good[-1]]) if len(good) else 2.0


def train(found: DataFrame) -> Model:
    """From the base candidates of all texts, counted by feature combination: at most 2 * GRID rows come back."""
    each = found.select(F.explode("candidates").alias("c")).filter("NOT c.wide")
    table = each.groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES], F.col("c.base").alias("base")).agg(F.count("*").alias("n")).collect()
    counts: dict[tuple, list[int]] = {}
    for r in table:
        counts.setdefault(tuple(r[f] for f in FEATURES), [0, 0])[r["base"]] += r["n"]
    keys = sorted(counts)
    if not keys:
        return Model()
    both = np.array([counts[k] for k in keys], float)
    return boost(np.array(keys, np.int64), both[:, 1], both[:, 0])


# ---- Scoring ------------------------------------------------------------------------------------------


def tree_column(tree: Split | float, c: Column) -> Column:
    if not isinstance(tree, Split):
        return F.lit(tree)
    return F.when(c[FEATURES[tree.feature]] <= tree.level, tree_column(tree.left, c)).otherwise(tree_column(tree.right, c))


def selected(model: Model) -> Callable[[Column], Column]:
    """Whether a wide candidate's calibrated score reaches its kind's threshold."""
    # p >= t is a bound on the sum of the trees
    bounds = [None if t > 1 else (np.log(max(t, 1e-9) / max(1 - t, 1e-9)) - model.curve[0]) / model.curve[1] / RATE for t in model.thresholds]

    def test(c: Column) -> Column:
        total = F.lit(0.0)
        for tree in model.trees:
            total = total + tree_column(tree, c)
        bound = F.lit(None).cast("double")
        for kind, b in enumerate(bounds):
            if b is not None:
                bound = F.when(c["kind"] == kind, F.lit(float(b) - 1e-9)).otherwise(bound)
        return F.coalesce(total >= bound, F.lit(False))

    return test


def detect(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text, base (base spans), spans (all), each an array of (start, kind, end) in order."""
    found = proposed(docs)
    model = train(found)
    chosen = selected(model)

    def short(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))

    def spans(c: Column) -> Column:
        base = F.array_sort(F.transform(F.filter(c, lambda x: x["base"]), short))

        def with_more(b: Column) -> Column:
            more = F.filter(c, lambda x: x["wide"] & chosen(x) & ~F.exists(b, lambda y: (y["start"] <= x["start"]) & (x["end"] <= y["end"])))
            return F.struct(b.alias("base"), F.array_sort(F.array_union(b, F.transform(more, short))).alias("spans"))

        return let(base, with_more)

    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    both = F.when(F.size("candidates") == 0, F.struct(none.alias("base"), none.alias("spans"))).otherwise(let(F.col("candidates"), spans))
    return found.select("doc_id", "text", both.alias("_both")).select("doc_id", "text", "_both.base", "_both.spans")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: int) -> Column:
    """How many spans are of a kind. The lambda has one argument: a second one would be given the span's index."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first names the place."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def add(a: Column, s: Column) -> Column:
        fresh = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.when(s["start"] >= a["at"], fresh).otherwise(a["out"]).alias("out"), F.greatest(a["at"], s["end"]).alias("at"))

    return F.aggregate(spans, start, add, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(tables.read(spark, sf_dir, "documents"))
    counts = [counted(F.col("base"), kind).alias(f"n_{name}") for kind, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
