"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A window is the shortest run of lines, forward or backward from a line, that has ``MIN_CHARS`` characters; a long line
is a window of its own. Where ``word_chars`` is given, a line counts as that many characters a word if it has fewer:
with ``WORD_CHARS`` a line of five words is a window too, and shorter lines need a run of five words. The pipeline
and ``op1_short_lines`` do so; the SQL of ``op1_lines`` has plain characters. Repeated lines of up to four words
between lines that are not repeated stay in either. The smallest line hash of each window is its fingerprint, so every repeated run of that
length shares at least one fingerprint. Only windows whose fingerprint occurs at two places are looked at further:
their whole contents (128 bits) are joined with the first place that has them. Windows that occur at an earlier,
not overlapping place are joined to runs, which so extend both ways as far as the texts agree, and the runs' lines
are deleted. The first place of every run stays.

Places are ordered by doc_id (NULL last), text hash and line. Lines are compared without white space at their ends;
blank lines count for nothing and are deleted only inside a run. A run may repeat within one text. Rows with equal id
and text are one document and get the same result. NULL text stays NULL. Other columns are not read.

No group is held: contents are pre-aggregated to their first place and met by a join that adaptive execution may
split; all else is per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railyard.llm import tables

MIN_CHARS = 100
WORD_CHARS = 20
BLANKS = " \t\r\x0b\x0c"
KEY = ("id", "th")


def text_hash() -> Column:
    return F.xxhash64("text")


def size_of(line: Column, word_chars: int) -> Column:
    chars = F.length(line).cast("long")
    return F.greatest(chars, F.size(F.split(line, f"[{BLANKS}]+")) * F.lit(word_chars).cast("long")) if word_chars else chars


def lines(docs: DataFrame, word_chars: int = 0) -> DataFrame:
    """(id, th, pos, h, h2, size): every line with something in it, once per document."""
    found = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("id"), text_hash().alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    found = found.withColumn("line", F.btrim("line", F.lit(BLANKS))).filter(F.length("line") > 0).withColumn("size", size_of(F.col("line"), word_chars))
    found = found.select(*KEY, "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit("line"), "line").alias("h2"), "size").repartition(*KEY)
    once = Window.partitionBy(*KEY, "pos").orderBy("h")
    return found.withColumn("n", F.row_number().over(once)).filter("n = 1").drop("n")


def windows(found: DataFrame, min_chars: int) -> DataFrame:
    """(id, th, begin, end, c, c2, fp, fp_pos, new): windows with content digests and fingerprints.

    ``new`` marks the first of the neighbouring windows that share a fingerprint.
    """
    of_doc = Window.partitionBy(*KEY)
    found = found.withColumn("stop", F.sum("size").over(of_doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
    found = found.withColumn("start", F.col("stop") - F.col("size"))

    def side(frame) -> Column:
        return F.struct(
            F.min("pos").over(frame).alias("begin"), F.max("pos").over(frame).alias("end"),
            (F.max("stop").over(frame) - F.min("start").over(frame)).alias("chars"),
            F.xxhash64(F.collect_list("h").over(frame)).alias("c"), F.xxhash64(F.collect_list("h2").over(frame)).alias("c2"),
            F.min(F.struct("h", (-F.col("pos")).alias("back"))).over(frame).alias("least"),
        )

    forward = side(of_doc.orderBy("start").rangeBetween(0, min_chars - 1))
    backward = side(of_doc.orderBy("stop").rangeBetween(-(min_chars - 1), 0))
    both = found.select(*KEY, "pos", forward.alias("f"), backward.alias("b"))
    before = of_doc.orderBy("pos")

    def new(name: str) -> Column:
        last = F.lag(F.when(F.col(f"{name}.chars") >= min_chars, F.col(f"{name}.least.back"))).over(before)
        return F.coalesce(F.col(f"{name}.least.back") != last, F.lit(True))

    both = both.select(*KEY, F.col("f"), F.col("b"), new("f").alias("new_f"), new("b").alias("new_b"))
    sides = F.array(F.struct(F.col("f").alias("w"), F.col("new_f").alias("new")), F.struct(F.col("b").alias("w"), F.col("new_b").alias("new")))
    each = both.select(*KEY, F.posexplode(sides).alias("back", "x")).select(*KEY, "back", "x.w.*", "x.new")
    # a line that is a window by itself is one both ways
    each = each.filter((F.col("chars") >= min_chars) & ((F.col("back") == 0) | (F.col("begin") < F.col("end"))))
    return each.select(*KEY, "begin", "end", "c", "c2", F.col("least.h").alias("fp"), (-F.col("least.back")).alias("fp_pos"), "new")


def place(*more: str) -> Column:
    return F.struct(F.col("id").isNull().alias("last"), "id", "th", *more)


def repeated_runs(docs: DataFrame, min_chars: int = MIN_CHARS, word_chars: int = 0) -> DataFrame:
    """(id, th, runs): for documents with something to delete, the runs (begin, end) of lines, in order."""
    found = tables.written(windows(lines(docs, word_chars), min_chars), "windows")
    prints = found.filter("new").groupBy("fp").agg(F.min(place("fp_pos")).alias("low"), F.max(place("fp_pos")).alias("high"))
    shared = tables.written(prints.filter("low <> high").select("fp"), "fingerprints")
    near = found.join(shared, "fp").select(*KEY, "begin", "end", "c", "c2")
    near = tables.written(near, "near")
    firsts = near.groupBy("c", "c2").agg(F.min(place("begin", "end")).alias("first"), F.max(place("begin", "end")).alias("other"))
    firsts = tables.written(firsts.filter("first <> other").select("c", "c2", "first"), "firsts")
    met = near.join(firsts, ["c", "c2"])
    same = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.th") == F.col("th"))
    later = met.filter(~same | (F.col("first.end") < F.col("begin"))).select(*KEY, "begin", "end")
    of_doc = Window.partitionBy(*KEY).orderBy("begin", "end")
    reach = F.max("end").over(of_doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = later.withColumn("new", F.coalesce(F.col("begin") > reach + 1, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(of_doc.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*KEY, "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    return runs.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The lines between the runs."""
    split = F.split(text, "\n")
    after = F.concat(F.array(F.lit(-1)), F.transform(runs, lambda r: r["end"]))

    def rest(x: Column) -> Column:
        before = F.concat(F.transform(runs, lambda r: r["begin"]), F.array(F.size(x)))
        return F.array_join(F.flatten(F.zip_with(after, before, lambda a, b: F.slice(x, a + 2, b - a - 1))), "\n")

    return F.element_at(F.transform(F.array(split), rest), 1)


def filled(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)).cast("long")


def dedup(docs: DataFrame, min_chars: int = MIN_CHARS, word_chars: int = 0) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` less its repeated runs, and ``_llm_deleted``: whether any went."""
    runs = repeated_runs(docs, min_chars, word_chars).select(F.col("id").alias("_llm_id"), F.col("th").alias("_llm_th"), F.col("runs").alias("_llm_runs"))
    met = docs.join(runs, docs["doc_id"].eqNullSafe(runs["_llm_id"]) & (F.xxhash64(docs["text"]) == runs["_llm_th"]), "left")
    text = F.when(F.col("_llm_runs").isNull(), docs["text"]).otherwise(kept_text(docs["text"], F.col("_llm_runs")))
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    return met.select(*columns, docs["text"].alias("_llm_whole"), F.col("_llm_runs").isNotNull().alias("_llm_deleted"))


def counted(found: DataFrame) -> DataFrame:
    whole, left = filled(F.coalesce(F.col("_llm_whole"), F.lit(""))), filled(F.coalesce(F.col("text"), F.lit("")))
    return found.select("doc_id", "text", whole.alias("n_lines"), (whole - left).alias("n_deleted"))


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted(dedup(tables.keyed(tables.read(spark, sf_dir, "documents"))))


def op1_short_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with lines of five words as windows, as the pipeline has it."""
    return counted(dedup(tables.keyed(tables.read(spark, sf_dir, "documents")), word_chars=WORD_CHARS))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` less their repeated runs, ``n_chars`` kept in step; texts of which nothing is left go."""
    found = dedup(docs, word_chars=WORD_CHARS)
    empty = F.col("_llm_deleted") & (filled(F.col("text")) == 0)
    found = found.filter(~empty)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        found = found.withColumn("n_chars", F.when(F.col("_llm_deleted"), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


#: Every window's whole content against every earlier one, without fingerprints.
ORACLE = rf"""
WITH l AS (
  SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS x
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
s AS (
  SELECT doc_id, pos, x, sum(length(x)) OVER (PARTITION BY doc_id ORDER BY pos) AS stop, stop - length(x) AS start
  FROM l WHERE length(x) > 0),
sides AS (
  SELECT doc_id, array_to_string(list(x) OVER f, chr(10)) AS c, min(pos) OVER f AS a, max(pos) OVER f AS b, max(stop) OVER f - min(start) OVER f AS chars
  FROM s WINDOW f AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {MIN_CHARS - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, array_to_string(list(x) OVER g, chr(10)) AS c, min(pos) OVER g, max(pos) OVER g, max(stop) OVER g - min(start) OVER g
  FROM s WINDOW g AS (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN {MIN_CHARS - 1} PRECEDING AND CURRENT ROW)),
w AS (SELECT DISTINCT doc_id, c, a, b FROM sides WHERE chars >= {MIN_CHARS}),
firsts AS (SELECT c, min({{'d': doc_id, 'a': a, 'b': b}}) AS f FROM w GROUP BY c),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(a, b)) AS pos FROM w JOIN firsts USING (c)
  WHERE f.d < doc_id OR f.b < a),
kept AS (SELECT l.* FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos WHERE gone.pos IS NULL),
texts AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY pos) AS text, count(*) FILTER (length(x) > 0) AS n FROM kept GROUP BY doc_id),
before AS (SELECT doc_id, count(*) FILTER (length(x) > 0) AS n FROM l GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(texts.text, '') END AS text, coalesce(before.n, 0) AS n_lines,
       coalesce(before.n, 0) - coalesce(texts.n, 0) AS n_deleted
FROM documents d LEFT JOIN texts USING (doc_id) LEFT JOIN before USING (doc_id)
"""
