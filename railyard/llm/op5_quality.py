"""Quality rules: a table of thresholds compiled into one projection over counts of a text, all in the JVM.

Counts come from one pass over each text: its words, lines, symbols, capitals, letters, stop words and repetitions.
Nothing is shuffled. A rule bounds the ratio of two counts; a text is kept if it passes the base checks and all rules.

Words are ``[^\\x20\\x09-\\x0D]+``. NULL counts as the empty text, which fails. Repeated rows each get a row; a rule
whose denominator is 0 passes. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.llm import tables

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the languages.
STOP_WORDS = (
    "the of and to a in is it that this with for on as are be was by or from at not "
    "der die das und ist nicht ein eine mit von zu den dem im auf für sich des als auch "
    "le la les de des du et un une est en que qui dans pour sur au pas avec par "
    "el los las y del que se por con para una su al lo como más o es no"
).split()


class Rule(NamedTuple):
    """``low <= numerator / denominator <= high``."""

    name: str
    numerator: str
    denominator: str
    low: float
    high: float


RULES = (
    Rule("symbols", "n_symbols", "word_chars", 0.0, 0.05),
    Rule("capitals", "n_upper", "n_letters", 0.0, 0.35),
    Rule("letters", "n_letters", "word_chars", 0.6, 1.0),
    Rule("word_length", "word_chars", "n_words", 2.5, 12.0),
    Rule("stop_words", "n_stop", "n_words", 0.01, 1.0),
    Rule("distinct_words", "n_distinct", "n_words", 0.15, 1.0),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.0, 0.4),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", 0.0, 0.9),
    Rule("open_lines", "n_open_lines", "n_lines", 0.0, 0.3),
    Rule("shouting", "n_shouted", "n_words", 0.0, 0.1),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def repeated_words(hashes: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more. ``hashes`` has three words at least.

    Windows are sorted by hash with their places, so that equal ones are neighbours; each pair of neighbours gives
    both places, each place its three words.
    """
    windows = let(F.size(hashes), lambda n: F.zip_with(
        F.zip_with(F.slice(hashes, F.lit(1), n - 2), F.slice(hashes, F.lit(2), n - 2), lambda a, b: F.xxhash64(a, b)),
        F.slice(hashes, F.lit(3), n - 2), lambda a, b: F.xxhash64(a, b),
    ))

    def covered(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(placed, lambda s: F.zip_with(
            F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)).otherwise(F.array().cast("array<int>")),
        ))
        return F.size(F.array_distinct(F.flatten(twice)))

    return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))


def counts(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules may use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    stop = [w for s in STOP_WORDS for w in (s, s.capitalize())]
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without(x, SPACES)) > 0)
    by_words = let(words, lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop"),
        F.size(F.filter(w, lambda x: F.endswith(x, F.lit("!!")))).cast("long").alias("n_shouted"),
        F.size(F.array_distinct(h)).cast("long").alias("n_distinct"),
        F.when(F.size(w) < 4, F.lit(0)).otherwise(repeated_words(h)).cast("long").alias("n_repeat_words"),
    )))
    by_lines = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(x, lambda y: F.ltrim(y).substr(1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(x, lambda y: F.endswith(F.rtrim(y), F.lit("...")) | F.endswith(F.rtrim(y), F.lit("…")))).cast("long").alias("n_open_lines"),
    ))
    found = docs.select(
        F.col("doc_id"), by_words.alias("_words"), by_lines.alias("_lines"),
        F.length(without(text, SPACES)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("long").alias("n_letters"),
    )
    return found.select("doc_id", "_words.*", "_lines.*", "word_chars", "n_symbols", "n_upper", "n_letters")


def passes(rule: Rule) -> Column:
    ratio = F.col(rule.numerator) / F.col(rule.denominator)
    return F.when(F.col(rule.denominator) == 0, F.lit(True)).otherwise((ratio >= rule.low) & (ratio <= rule.high))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, base_failed, kept, and the names of the rules that a text fails."""
    base = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    found = counts(docs)
    return found.select("*", base.alias("base_failed"), failed.alias("failed")).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(tables.read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_rules() -> str:
    return " AND ".join(f"({r.denominator} = 0 OR ({r.numerator}::DOUBLE / {r.denominator} BETWEEN {r.low!r} AND {r.high!r}))" for r in RULES)


_STOP = ", ".join(f"'{w}'" for s in STOP_WORDS for w in (s, s.capitalize()))

#: Words, windows and lines as rows.
ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM d),
by_word AS (
  SELECT doc_id, count(*) FILTER (x IN ({_STOP})) AS n_stop, count(*) FILTER (ends_with(x, '!!')) AS n_shouted,
         count(DISTINCT x) AS n_distinct
  FROM words GROUP BY doc_id),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS often
  FROM (SELECT a.doc_id, a.i, a.x || ' ' || b.x || ' ' || c.x AS g
        FROM words a JOIN words b ON a.doc_id = b.doc_id AND b.i = a.i + 1 JOIN words c ON a.doc_id = c.doc_id AND c.i = a.i + 2)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE often > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, x FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
by_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines,
         count(*) FILTER (regexp_matches(x, '^ *[-*•]')) AS n_bullet_lines, count(*) FILTER (regexp_matches(x, '(\.\.\.|…) *$')) AS n_open_lines
  FROM lines GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_upper,
         length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters, coalesce(n_stop, 0) AS n_stop, coalesce(n_shouted, 0) AS n_shouted,
         coalesce(n_distinct, 0) AS n_distinct, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_bullet_lines, 0) AS n_bullet_lines, coalesce(n_open_lines, 0) AS n_open_lines
  FROM d LEFT JOIN by_word USING (doc_id) LEFT JOIN repeats USING (doc_id) LEFT JOIN by_line USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_sql_rules()} AS kept
FROM judged
"""
