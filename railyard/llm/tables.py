"""Reading the driver's text tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.session import shared_dir

ROW = "_llm_row"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/railyard-llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors.

    The files stay as long as the returned rows may be read; the shared folder is scratch space.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(column: str, folds: int) -> Column:
    """True where crc32 of the id as text leaves remainder 0. A NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == 0


def keyed(docs: DataFrame) -> DataFrame:
    """Only the id and the text, under names that no other column of ``docs`` can clash with."""
    return docs.select(F.col("doc_id"), F.col("text"))
