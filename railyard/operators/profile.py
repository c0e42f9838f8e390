"""Table profile: rows, NULLs and distinct values per column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(df: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """One row per column.

    Exact: each column is grouped on its own, reading only that column; a frequent value is combined
    before the shuffle. Distinct counts of many columns in one aggregation would instead copy every row
    once per column. Not exact: one pass over the table with HyperLogLog sketches.
    """
    return _exact(df, table) if exact else _approximate(df, table)


def _exact(df: DataFrame, table: str) -> DataFrame:
    parts = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            value = F.sha2(value, 256)  # whole texts are read but not shuffled
        groups = df.select(value.alias("v")).groupBy("v").agg(F.count("*").alias("n"))
        parts.append(
            groups.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
                F.count("v").alias("distinct_count"),
            ).select(
                F.lit(table).alias("table_name"),
                F.lit(field.name).alias("column_name"),
                "row_count",
                "null_count",
                "distinct_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _approximate(df: DataFrame, table: str) -> DataFrame:
    names = df.columns
    sums = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"_n{i}") for i, n in enumerate(names)],
        *[F.approx_count_distinct(F.col(f"`{n}`")).alias(f"_d{i}") for i, n in enumerate(names)],
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(n).alias("column_name"),
            F.col("_rows").alias("row_count"),
            F.col(f"_n{i}").alias("null_count"),
            F.col(f"_d{i}").alias("distinct_count"),
        )
        for i, n in enumerate(names)
    ]
    return sums.select(F.explode(F.array(*lines)).alias("_l")).select("_l.*")
