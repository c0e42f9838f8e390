"""A key directory: which key of a large table is where, in buckets, so that looking keys up reads only their buckets.

It is a Parquet table of the keys and a few small columns, partitioned by a hash of the key. A load looks its keys up
(a join within the buckets its keys fall into), and afterwards puts their new places into those same buckets. What it
costs grows with the buckets touched and never with the width of the table it stands for.

The directory is taken back before its table changes and completed after it; where it is missing, it is made anew
from the table's key columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.merge import in_partitions, merge_into_parquet, same_key
from railyard.session import drop_path, list_folders, staged
from railyard.sources.tables import beside, full_refresh, is_committed, path_exists, touch

BUCKET = "key_bucket"
ROWS_PER_BUCKET = 2_000_000
MOST_BUCKETS = 8192


@dataclass(frozen=True)
class KeyDirectory:
    """``path``: the folder; ``keys``: the key columns; ``schema``: keys and what is kept with them.

    The number of buckets follows from the number of keys when the directory is made (``rows_per_bucket`` each, at most
    ``MOST_BUCKETS``) and stays until it holds four times as many; then it is made anew.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    rows_per_bucket: int = ROWS_PER_BUCKET

    @staticmethod
    def beside(spark: SparkSession, table_path: str, keys: Sequence[str], schema: T.StructType, rows_per_bucket: int = ROWS_PER_BUCKET) -> KeyDirectory:
        return KeyDirectory(spark, beside(table_path, "keys"), tuple(keys), schema, rows_per_bucket)

    @property
    def buckets(self) -> int:
        """As noted when the directory was made: a folder named by the number."""
        noted = list_folders(self.spark, beside(self.path, "buckets"))
        return int(noted[-1]) if noted else 1

    def bucket(self, buckets: int | None = None) -> Column:
        """NULL parts of a key count as values of their own."""
        parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("0")) for k in self.keys]
        return F.pmod(F.xxhash64(*parts), F.lit(buckets or self.buckets)).cast("int")

    def entries(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names).withColumn(BUCKET, self.bucket())

    @property
    def complete(self) -> bool:
        there = path_exists(self.spark, self.path) and is_committed(self.spark, self.path)
        return there and not path_exists(self.spark, beside(self.path, "stale"))

    def invalidate(self) -> None:
        """Take the directory back; done before its table changes."""
        touch(self.spark, beside(self.path, "stale"))

    def confirm(self) -> None:
        """The directory agrees with its table again."""
        drop_path(self.spark, beside(self.path, "stale"))

    def read(self, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if buckets is None else rows.filter(in_partitions(BUCKET, list(buckets)))

    def rebuild(self, rows: DataFrame, what: str) -> None:
        """Write the directory of ``rows``, one entry a key; a key that occurs twice raises, and nothing is kept."""
        others = [c for c in self.schema.names if c not in self.keys]
        buckets = max(1, min(MOST_BUCKETS, -(-rows.count() // self.rows_per_bucket)))
        drop_path(self.spark, self.path)
        drop_path(self.spark, beside(self.path, "buckets"))
        touch(self.spark, f"{beside(self.path, 'buckets')}/{buckets}/noted")
        once = rows.groupBy(*self.keys).agg(*(F.first(c).alias(c) for c in others), F.count("*").alias("_copies"))
        full_refresh(once.select(*self.schema.names, "_copies").withColumn(BUCKET, self.bucket(buckets)), self.path, BUCKET)
        counted = T.StructType([*self.schema.fields, T.StructField("_copies", T.LongType())])
        twice = self.spark.read.schema(counted).parquet(self.path).filter("_copies > 1").limit(1).collect()
        if twice:
            drop_path(self.spark, self.path)
            raise ValueError(f"{what}: key {self.keys} is not unique, e.g. { {k: twice[0][k] for k in self.keys} }")
        self.confirm()

    def count(self) -> int:
        """How many keys; counted from the files' footers. -1 while the directory is taken back."""
        return self.read().count() if self.complete else -1

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that keys of ``rows`` fall into: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def find(self, rows: DataFrame) -> DataFrame:
        """The entries of the keys of ``rows``, read from their buckets only."""
        wanted = rows.select(*self.keys).withColumn(BUCKET, self.bucket())
        known = self.read(self.touched(rows))
        return known.alias("d").join(wanted.alias("w"), same_key([BUCKET, *self.keys], "d", "w"), "left_semi").drop(BUCKET)

    def put(self, rows: DataFrame) -> list[int]:
        """Add or replace entries, each key once in ``rows``; the buckets that changed (all of them, where it was made anew)."""
        changed = self.touched(rows)
        if changed:
            merge_into_parquet(
                self.spark, self.path, self.entries(rows), self.keys, BUCKET, partition_fixed_by_key=True, schema=self.read().schema
            )
        if self.read().count() > 4 * self.rows_per_bucket * self.buckets and self.buckets < MOST_BUCKETS:
            with staged(self.read().drop(BUCKET), "directory") as rows:
                self.rebuild(rows, self.path)
            return list(range(self.buckets))
        return changed
