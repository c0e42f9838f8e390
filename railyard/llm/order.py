"""Places of rows in large ordered groups, without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railyard.llm import tables

ID, PART = "_llm_id", "_llm_part"
_PART_BITS = 33  # the row number within a partition, as monotonically_increasing_id() lays it out


def placed(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, within ``group`` by ``order``, NULLs first) and ``size`` (of the group).

    Rows are dealt to ranges of (group, order) and written once in that order, so a group spreads over as many tasks
    as it needs; rows equal in all these columns are dealt on by where they were read. A place is then the row's
    number in its range plus the counts of the ranges before: one row for each group and range is all that is summed.
    ``group`` is never NULL, and ``order`` tells apart all rows that are not interchangeable.
    """
    keys = [group, *order, ID]
    dealt = rows.withColumn(ID, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = tables.written(dealt.withColumn(ID, F.monotonically_increasing_id()), label)
    dealt = dealt.withColumn(PART, F.shiftright(ID, _PART_BITS))
    counts = dealt.groupBy(group, PART).agg(F.min(ID).alias("_llm_first"), F.count("*").alias("_llm_n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        group, PART, (F.coalesce(F.sum("_llm_n").over(before), F.lit(0)) - F.col("_llm_first")).alias("_llm_shift"),
        F.sum("_llm_n").over(whole).alias("size"),
    )
    counts = tables.written(counts, f"{label}-counts")
    return dealt.join(counts, [group, PART]).withColumn("place", F.col(ID) + F.col("_llm_shift")).drop(ID, PART, "_llm_shift")
