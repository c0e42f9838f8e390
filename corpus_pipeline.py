"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railyard.llm import op1_lines, op4_jaccard, op8_bpe, op9_decontaminate, op10_language, tables


#: Least share of a document's letters that its predicted language has.
LANGUAGE_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an identified language: one that has its share of the letters. Others are in no learned language's
    script, in too many languages at once, or without letters."""
    return op10_language.keep_identified(docs, min_score=LANGUAGE_SHARE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the runs of lines that an earlier place has; those of which nothing is left go."""
    return op1_lines.without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return op4_jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return op9_decontaminate.clean(docs, tables.read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return op8_bpe.encode(docs)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Language identification and the encoder's ids cannot be expressed in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = tables.written(docs, f"stage-{name}")
    return docs
