"""Upsert merge: as a DataFrame expression, and onto a partitioned Parquet table."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.dedup import assert_unique
from railyard.session import drop_path, list_folders, staged
from railyard.sources.tables import TARGET_FILE_BYTES, beside, file_layout, full_refresh, is_committed, listed_files, path_exists


def same_key(keys: Sequence[str], left: str, right: str, strict_sql_nulls: bool = False) -> Column:
    """Join condition on all keys. Null-safe unless ``strict_sql_nulls``."""
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    terms = [a == b if strict_sql_nulls else a.eqNullSafe(b) for a, b in pairs]
    return reduce(lambda a, b: a & b, terms)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], strict_sql_nulls: bool = False
) -> DataFrame:
    """Target rows without a match, plus all source rows. Nothing is ever deleted.

    ``source`` must hold each key once. Columns only one side has are filled with NULL (append-only
    schema change). With ``strict_sql_nulls`` a NULL key matches nothing and is inserted again each time.
    """
    kept = target.alias("t").join(
        source.select(*keys).alias("s"), same_key(keys, "t", "s", strict_sql_nulls), "left_anti"
    )
    return kept.unionByName(source, allowMissingColumns=True)


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Partitions a merge changes: where source rows go, and where the rows they replace are now.

    A row can move between partitions. ``remaining`` is what stays of a partition's old rows, and a
    partition is ``emptied`` when nothing stays and nothing arrives.

    Replaced rows are found by a semi join on key and partition columns only; a small source is broadcast
    or filters the target's scan. Totals are counted only in partitions that lose rows, without reading
    any data column. What is broadcast there is one row per partition.
    """
    arriving = source.groupBy(partition).agg(F.count("*").alias("arriving"))
    replaced = (
        target.select(partition, *keys)
        .alias("t")
        .join(source.select(*keys).alias("s"), same_key(keys, "t", "s"), "left_semi")
        .groupBy(partition)
        .agg(F.count("*").alias("replaced"))
    )
    affected = replaced.unionByName(arriving.select(partition, F.lit(0).cast("bigint").alias("replaced")))
    totals = (
        target.select(partition)
        .alias("t")
        .join(affected.alias("a"), same_key([partition], "t", "a"), "left_semi")
        .groupBy(partition)
        .agg(F.count("*").alias("total"))
    )
    counts = [
        df.select(partition, *[F.col(c) if c == has else F.lit(0).cast("bigint").alias(c) for c in _COUNTS])
        for df, has in ((replaced, "replaced"), (totals, "total"), (arriving, "arriving"))
    ]
    merged = reduce(DataFrame.unionByName, counts).groupBy(partition).agg(*[F.sum(c).alias(c) for c in _COUNTS])
    remaining = F.col("total") - F.col("replaced")
    return merged.select(
        partition,
        "replaced",
        remaining.alias("remaining"),
        "arriving",
        ((remaining == 0) & (F.col("arriving") == 0)).alias("emptied"),
    )


_COUNTS = ("replaced", "total", "arriving")


def in_partitions(column: str, values: Sequence[object]) -> Column:
    """Partition filter that also finds the NULL partition; prunes the file listing."""
    known = [v for v in values if v is not None]
    match = F.col(column).isin(known) if known else F.lit(False)
    return match | F.col(column).isNull() if len(known) < len(values) else match


def write_partitions(df: DataFrame, path: str, partition: str, rebalance: bool = True) -> None:
    """Replace the partitions that occur in ``df``.

    The rebalance hint lets adaptive execution split a hot partition over many tasks and join small ones,
    so no day is written by a single task.
    """
    (
        (df.hint("rebalance", partition) if rebalance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def merge_into_parquet(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    partition_fixed_by_key: bool = False,
    schema: T.StructType | None = None,
    before_change: Callable[[list[object] | None], None] | None = None,
    locate: Callable[[DataFrame], DataFrame] | None = None,
    newer_by: str | None = None,
    after_change: Callable[[DataFrame | None, list[object] | None], None] | None = None,
) -> None:
    """Upsert ``source`` into the Parquet table at ``path``, rewriting only touched partitions.

    ``partition_fixed_by_key``: the partition follows from the key (it is part of it), so rows never move
    and the target's key columns need no scan. ``locate``: given the source rows, where their keys are now (rows with
    the partition column, as a key directory has them); then the target's key columns need no scan either.
    ``schema``: the table's columns, so that files written before a column was added read as NULL; without it the
    columns of all files are merged. ``newer_by``: a source row older than the target's by this column is left out.
    ``before_change`` is told all partition values about to change (None: the whole table is new), before
    anything is written; ``after_change`` is given the merged source rows and those values when all is in place
    (None and None after a first load, which it then has to check for repeated keys). The first load is written once,
    replacing what a broken-off one may have left.

    A merge that breaks off is repaired by running it again with the same source. The new partitions are written beside
    the table before any old one is replaced; a run that finds them whole puts them in place first, so rows
    that are not in the source never exist in Spark's staging folder only. Emptied partitions go before the others are
    replaced: all their rows are in the source, so a rerun brings them back, while the other order could
    leave a stale copy that a later incremental load would not find.
    """
    finish_rewrite(spark, path, partition)
    if not is_committed(spark, path):
        if before_change:
            before_change(None)
        full_refresh(source, path, partition)
        try:
            if after_change:
                after_change(None, None)
            else:
                assert_unique(spark.read.schema(source.schema).parquet(path), keys, path)
        except ValueError:
            drop_path(spark, path)
            raise
        return
    with ExitStack() as stack:
        batch = stack.enter_context(staged(source, "merge"))
        assert_unique(batch, keys, path)
        target = _read_target(spark, path, schema)
        emptied: list[object] = []
        if partition_fixed_by_key:
            touched = _values(batch, partition)
        elif locate:
            touched = _values(batch.select(partition).unionByName(locate(batch).select(partition)), partition)
        else:
            changes = touched_partitions(target, batch, keys, partition).select(partition, "emptied").collect()
            touched = [r[0] for r in changes if not r["emptied"]]
            emptied = [r[0] for r in changes if r["emptied"]]
        changed = [*touched, *emptied]
        if before_change:
            before_change(changed)
        for value in emptied:
            drop_path(spark, partition_path(path, partition, value))
        if touched:
            current = spark.read.schema(target.schema).parquet(path).filter(in_partitions(partition, touched))
            if newer_by:
                batch = stack.enter_context(staged(not_older(batch, current, keys, newer_by), "merge-newer"))
            _rewrite(spark, path, merge_upsert(current, batch, keys), partition, touched)
        if after_change:
            after_change(batch, changed)


def not_older(source: DataFrame, target: DataFrame, keys: Sequence[str], newer_by: str) -> DataFrame:
    """Source rows but those whose key the target has with a greater ``newer_by``."""
    known = target.select(*keys, newer_by)
    return source.alias("s").join(
        known.alias("t"), same_key(keys, "s", "t") & (F.col(f"t.{newer_by}") > F.col(f"s.{newer_by}")), "left_anti"
    )


def _rewrite(spark: SparkSession, path: str, rows: DataFrame, partition: str, touched: Sequence[object]) -> None:
    """Write touched partitions beside the table with a note of those left without rows, then put them in place."""
    rewrite = beside(path, "rewrite")

    def note_emptied() -> None:
        written = set(list_folders(spark, rewrite))
        folders = [partition_path("", partition, v).lstrip("/") for v in touched]
        note = spark.createDataFrame([(f,) for f in folders if f not in written], "folder string")
        note.coalesce(1).write.mode("overwrite").parquet(beside(path, "emptied"))

    full_refresh(rows, rewrite, partition, before_complete=note_emptied)
    finish_rewrite(spark, path, partition)


def finish_rewrite(
    spark: SparkSession,
    path: str,
    partition: str,
    emptied_first: bool = True,
    arrange: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Put recorded new partitions in place, remove those noted as left without rows.

    What was not written to its end is dropped: the table is untouched. ``arrange`` says how rows are dealt to files.
    """
    rewrite, emptied = beside(path, "rewrite"), beside(path, "emptied")
    if not path_exists(spark, rewrite):
        return

    def drop_emptied() -> None:
        if path_exists(spark, emptied):
            for r in spark.read.schema("folder string").parquet(emptied).collect():  # at most one row per partition
                drop_path(spark, f"{path.rstrip('/')}/{r['folder']}")

    if is_committed(spark, rewrite):
        if emptied_first:
            drop_emptied()
        if list_folders(spark, rewrite):
            rows = spark.read.parquet(rewrite)
            write_partitions(rows if arrange is None else arrange(rows), path, partition, arrange is None)
        if not emptied_first:
            drop_emptied()
    drop_path(spark, rewrite)
    drop_path(spark, emptied)


def _values(df: DataFrame, partition: str) -> list[object]:
    """Distinct partition values: days or months, so few."""
    return [r[0] for r in df.select(partition).distinct().collect()]


def _read_target(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def partition_path(path: str, partition: str, value: object) -> str:
    """Folder of one partition, as Spark names it. Partition columns here are dates."""
    return f"{path.rstrip('/')}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace a whole table partition by partition: a reader always finds a full table, of old or new partitions.

    The new rows are written beside the table first. Then each partition is replaced by its new one, and those that no
    longer occur are removed. A first write, or one into a folder of another layout, is written in place.
    """
    spark = df.sparkSession
    finish_rewrite(spark, path, partition)
    old = [f for f in list_folders(spark, path) if f.startswith(f"{partition}=")] if is_committed(spark, path) else []
    if not old:
        full_refresh(df, path, partition)
        return
    rewrite = beside(path, "rewrite")

    def note_gone() -> None:
        written = set(list_folders(spark, rewrite))
        note = spark.createDataFrame([(f,) for f in old if f not in written], "folder string")
        note.coalesce(1).write.mode("overwrite").parquet(beside(path, "emptied"))

    full_refresh(df, rewrite, partition, before_complete=note_gone)
    finish_rewrite(spark, path, partition, emptied_first=False)


def compact(spark: SparkSession, path: str, partition: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Rewrite partitions that have more files than their size calls for; report files before and after.

    What is due is found from the listing alone. Each partition gets ``ceil(bytes / target)`` files. Rows are spread by
    a hash of the whole row, so a big partition is written by many tasks and a retried task writes the same rows
    again. The new files are written and counted beside the table and put in place as a merge's are, so a run that
    breaks off loses no row.
    """
    finish_rewrite(spark, path, partition)
    due = [
        (r["partition_value"], max(1, math.ceil(r["bytes"] / target_bytes)))
        for r in listed_files(spark, path, partition).collect()  # one row per partition
        if r["files"] > max(1, math.ceil(r["bytes"] / target_bytes))
    ]
    schema = T.StructType([T.StructField("partition_value", T.StringType()), T.StructField("wanted", T.IntegerType())])
    plan = spark.createDataFrame(due, schema)
    if not due:
        return plan.selectExpr("partition_value", "wanted", "0L AS files", "0L AS bytes", "0L AS row_count").limit(0)
    table = spark.read.parquet(path)
    value = F.col(partition).cast("string")
    part_of = in_partitions("_value", [v for v, _ in due])
    rows = table.withColumn("_value", value).filter(part_of).drop("_value")

    def spread(found: DataFrame) -> DataFrame:
        dealt = found.join(plan, value.eqNullSafe(F.col("partition_value")))  # one row per partition due; the size check decides on a broadcast
        dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*table.columns), F.col("wanted")))
        return dealt.repartition(sum(n for _, n in due), partition, "_file").select(*table.columns)

    def same_rows() -> None:
        before, after = rows.count(), spark.read.parquet(rewrite).count()  # from footers
        if before != after:
            raise RuntimeError(f"{path}: {before} rows before compaction, {after} after")

    rewrite = beside(path, "rewrite")
    drop_path(spark, beside(path, "emptied"))
    full_refresh(rows, rewrite, partition, before_complete=same_rows)
    finish_rewrite(spark, path, partition, arrange=spread)
    done = file_layout(spark.read.parquet(path).withColumn("_value", value).filter(part_of), partition)
    return (
        plan.alias("p")
        .join(done.alias("a"), F.col("p.partition_value").eqNullSafe(F.col("a.partition_value")))
        .select("a.partition_value", "wanted", "files", "bytes", "row_count")
    )
