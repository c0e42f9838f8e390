"""Snapshot read of an operational table, in parallel ranges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def time_ranges(column: str, start: dt.datetime, end: dt.datetime, parts: int) -> list[str]:
    """Predicates that split a time column into ``parts`` ranges. Together they cover every row: the
    first has no lower bound and takes NULLs, the last has no upper bound."""
    if parts < 1 or end <= start:
        raise ValueError("need at least one part and end > start")
    cuts = [start + (end - start) * i / parts for i in range(1, parts)]
    text = [cut.isoformat(sep=" ", timespec="milliseconds") for cut in cuts]
    if not text:
        return ["1 = 1"]
    middle = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(text, text[1:])]
    return [f"{column} < '{text[0]}' OR {column} IS NULL", *middle, f"{column} >= '{text[-1]}'"]


def read_snapshot(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str], fetch_rows: int = 10_000, **properties: str
) -> DataFrame:
    """One task per predicate; the driver of the database must be on the class path."""
    settings = {"fetchsize": str(fetch_rows), **properties}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=settings)


def snapshot_as_changes(rows: DataFrame, seq: int = 0) -> DataFrame:
    """Snapshot rows as the first events of a changelog: any later change has a greater ``seq``."""
    return rows.withColumn("op", F.lit("r")).withColumn("seq", F.lit(seq).cast("bigint"))
