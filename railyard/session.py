"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
R = TypeVar("R")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "railyard", **extra: str) -> SparkSession:
    """A session with the settings the library relies on. On a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, bytes_per_scan_task: int = 1 << 30, bytes_per_reduce_task: int = 2 << 30) -> dict[str, str]:
    """Partition settings for a full pass over ``input_bytes``; adaptive execution joins what turns out small.

    100 TB gives about 93,000 scan and 47,000 reduce tasks. A reduce task sorts and spills; a skewed one
    is split. The defaults of 128 MB and 200 partitions would mean 800,000 scan tasks and 500 GB per
    reduce task.
    """
    reduce_tasks = max(200, -(-input_bytes // bytes_per_reduce_task))
    return {
        "spark.sql.files.maxPartitionBytes": str(max(128 << 20, min(bytes_per_scan_task, input_bytes // 200))),
        "spark.sql.shuffle.partitions": str(reduce_tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    }


# Spark's own setting, and what a pass over whole tables takes instead. A task that widens and sorts the
# rows it reads holds ten to thirty times the bytes of its Parquet split, several times those of its shuffled blocks.
SMALL_TASKS = {
    "spark.sql.files.maxPartitionBytes": ("134217728b", "16m"),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "24m"),
}


def small_tasks(spark: SparkSession) -> None:
    """Tasks whose sorts fit their memory, whatever the size of the tables: more tasks, not larger ones that spill.

    A session that has values of its own, such as those of ``sized_for``, keeps them.
    """
    for key, (unset, value) in SMALL_TASKS.items():
        if spark.conf.get(key) == unset:
            spark.conf.set(key, value)


def pin_utc(spark: SparkSession) -> None:
    """Event times carry no zone; every zoned value in the library is UTC. Overflows and bad casts raise."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


def require_ansi(spark: SparkSession) -> None:
    """Without ANSI mode an unreadable amount becomes 0 and a sum too large NULL, so nothing is written then."""
    if spark.conf.get("spark.sql.ansi.enabled", "true").lower() != "true":
        raise RuntimeError("set spark.sql.ansi.enabled to true")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: a cluster's executors could not
    see a folder on the driver's disk, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="railyard-")
    return _LOCAL_DIRS[application]


_LOCAL_DIRS: dict[str, str] = {}


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder and read back; removed at the end of the block.

    Cuts lineage and survives lost executors. The reader knows the written size, so a later join
    broadcasts it only when it really is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/railyard-stage/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the Hadoop file system that owns it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(hadoop_path, True)


def in_parallel(step: Callable[[T], R], items: Iterable[T], workers: int = 4) -> list[R]:
    """Run a step for several items at once, so that small jobs share the cluster. The first error is raised."""
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(in_session(step), items))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; none when it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())
