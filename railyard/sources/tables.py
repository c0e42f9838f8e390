"""Layered Parquet tables: scan, create, append, full refresh, file layout, compaction."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.session import drop_path

# The layers, and the column each layer's tables are partitioned by.
LAYERS = ("bronze", "silver", "gold", "serving")
PARTITION = {"silver": "event_day", "gold": "report_month", "serving": "report_month"}

TARGET_FILE_BYTES = 128 * 1024 * 1024

# Whole tables are written once and read many times.
CODEC = "zstd"


def table_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            return False
        raise
    return True


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; one that is there is replaced."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True).close()


def _has_data(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(place) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(place))


def beside(path: str, kind: str) -> str:
    """A folder or file of the library's own beside a table."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/.{kind}-{name}"


@contextmanager
def recorded_write(spark: SparkSession, path: str) -> Iterator[None]:
    """Notes beside the table that a write began, and in the table that it ended."""
    touch(spark, beside(path, "begun"))
    yield
    touch(spark, f"{path.rstrip('/')}/_railyard_complete")
    drop_path(spark, beside(path, "begun"))


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` ever finished, by the library's own records.

    ``full_refresh`` notes beside the table that it began, and in the table that it ended. A table with Spark's own
    success marker counts too. Data with neither note is not the library's to replace: that raises.
    """
    if path_exists(spark, f"{path.rstrip('/')}/_railyard_complete"):
        return True
    if path_exists(spark, beside(path, "begun")):
        return False
    if path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        return True
    if _has_data(spark, path):
        raise RuntimeError(f"{path} holds data of which no load is recorded; remove it or add _SUCCESS")
    return False


def pending_mark(spark: SparkSession, path: str) -> object | None:
    """The lower bound of a load that began and has not been confirmed."""
    note = beside(path, "mark")
    if not path_exists(spark, f"{note}/_railyard_complete"):
        return None
    return spark.read.parquet(note).first()["mark"]


def note_mark(spark: SparkSession, path: str, mark: object) -> None:
    note = beside(path, "mark")
    spark.createDataFrame([(mark,)], ["mark"]).coalesce(1).write.mode("overwrite").parquet(note)
    touch(spark, f"{note}/_railyard_complete")


def clear_mark(spark: SparkSession, path: str) -> None:
    drop_path(spark, beside(path, "mark"))


def read_table(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(table_path(root, layer, table))


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Write an empty table with the given columns unless one is there. Returns whether it was created."""
    if table_exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def append_rows(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def typed_rows(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` with exactly the contract's columns and types, by name.

    A column too few or too many raises at once; a value that does not fit its type raises when it is written.
    """
    missing = sorted(set(contract.names) - set(df.columns))
    other = sorted(set(df.columns) - set(contract.names))
    if missing or other:
        raise ValueError(f"not the target's columns: {missing} missing, {other} unknown")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def require_columns(target: T.StructType, rows: T.StructType, path: str) -> None:
    """Raises unless the table at ``path`` has the rows' columns and types; their order does not matter."""
    kinds = {f.name: f.dataType for f in rows.fields}
    for f in target.fields:
        if kinds.pop(f.name, None) != f.dataType:
            raise ValueError(f"{path}: column {f.name} is {f.dataType.simpleString()}, not as in the rows to append")
    if kinds:
        raise ValueError(f"{path}: no columns {sorted(kinds)}")


def typed_append(df: DataFrame, path: str, contract: T.StructType) -> None:
    """Append to a typed table: created if absent, refused before anything is written if its columns are others."""
    rows = typed_rows(df, contract)
    spark = df.sparkSession
    if not create_if_absent(spark, path, contract):
        require_columns(spark.read.parquet(path).schema, contract, path)
    append_rows(rows, path)


def full_refresh(df: DataFrame, path: str, partition: str | None = None, before_complete: Callable[[], None] | None = None) -> None:
    """Replace the whole table, partitions that no longer occur included. ``before_complete`` runs once the rows are
    written, before the write is recorded as complete."""
    with recorded_write(df.sparkSession, path):
        writer = df.hint("rebalance", partition) if partition else df
        sink = writer.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", CODEC)
        (sink.partitionBy(partition) if partition else sink).parquet(path)
        if before_complete:
            before_complete()


def listed_files(spark: SparkSession, path: str, partition: str | None = None) -> DataFrame:
    """Files and bytes per partition from the listing of the folder: no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    part = F.lit("all") if partition is None else F.regexp_extract("path", f"/{partition}=([^/]*)/", 1)
    value = F.when(part != "__HIVE_DEFAULT_PARTITION__", part)
    return files.groupBy(value.alias("partition_value")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def file_layout(table: DataFrame, partition: str | None = None) -> DataFrame:
    """Files, bytes and rows per partition of any DataFrame over files.

    Only footers are read (the scan has no data column). Rows are counted per file first (a map-side combine), then
    per partition. Where rows are not asked for, ``listed_files`` opens no file at all.
    """
    part = F.col(partition).cast("string") if partition else F.lit("all")
    files = (
        table.select(
            part.alias("partition_value"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("partition_value", "file_path", "file_size")
        .agg(F.count("*").alias("rows"))
    )
    return files.groupBy("partition_value").agg(
        F.count("*").alias("files"), F.sum("file_size").alias("bytes"), F.sum("rows").alias("row_count")
    )
