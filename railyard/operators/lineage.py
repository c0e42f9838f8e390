"""Lineage events turned into dataset edges and run states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.operators.dedup import latest_per_key
from railyard.sources import rejects

# Event layout, platforms by namespace prefix, run states, dataset name format.
_DATASETS = T.ArrayType(T.StructType([T.StructField("namespace", T.StringType()), T.StructField("name", T.StringType())]))
EVENT_SCHEMA = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("run", T.StructType([T.StructField("runId", T.StringType())])),
    T.StructField("job", T.StructType([T.StructField("name", T.StringType())])),
    T.StructField("inputs", _DATASETS),
    T.StructField("outputs", _DATASETS),
])
PLATFORMS = {
    "kafka://": "kafka",
    "iceberg://": "iceberg",
    "clickhouse://": "clickhouse",
    "postgresql://": "postgres",
}
DEFAULT_PLATFORM = "clickhouse"
RUN_STATES = {"START": "STARTED", "COMPLETE": "COMPLETE", "FAIL": "FAILED"}
DEFAULT_STATE = "COMPLETE"
DATASET_FORMAT = "urn:li:dataset:(urn:li:dataPlatform:%s,%s,PROD)"


def checked_events(events: DataFrame, column: str = "value") -> DataFrame:
    """``events`` with the parsed event in ``typed_record``, and for one that does not fit the reason (``rejects``)."""
    return rejects.checked(events, column, EVENT_SCHEMA)


def parse_events(events: DataFrame, column: str = "value") -> DataFrame:
    """Fields of the events that fit, and the other columns; ``rejected_events`` has the rest."""
    others = [c for c in events.columns if c != column]
    return rejects.accepted(checked_events(events, column), keep=others).select(*EVENT_SCHEMA.names, *others)


def rejected_events(events: DataFrame, column: str = "value") -> DataFrame:
    """Events that are cut off, not JSON, or hold something else where an event's parts should be."""
    return rejects.rejected(checked_events(events, column), events.columns)


def _lookup(choices: list[tuple[Column, str]], default: str) -> Column:
    found = F.lit(default)
    for condition, value in reversed(choices):
        found = F.when(condition, value).otherwise(found)
    return found


def dataset_urn(namespace: Column, name: Column) -> Column:
    platform = _lookup([(namespace.startswith(p), v) for p, v in PLATFORMS.items()], DEFAULT_PLATFORM)
    path = F.replace(F.coalesce(name, F.lit("")), F.lit("."), F.lit("/"))
    head, middle, tail = DATASET_FORMAT.split("%s")
    return F.concat(F.lit(head), platform, F.lit(middle), path, F.lit(tail))


def edges(events: DataFrame) -> DataFrame:
    """One row per output and input of each completed event. Events lacking either give none.

    The pairs are formed inside the event's own arrays and exploded once. ``explode_outer`` keeps the
    optimizer from adding a size filter below the explode, which would parse the JSON again.
    """

    def pair(output: Column) -> Column:
        down = dataset_urn(output["namespace"], output["name"])
        return F.transform(
            F.col("inputs"),
            lambda i: F.struct(down.alias("downstream"), dataset_urn(i["namespace"], i["name"]).alias("upstream")),
        )

    pairs = F.when(F.col("eventType") == "COMPLETE", F.flatten(F.transform("outputs", pair)))
    return events.select(F.explode_outer(pairs).alias("_pair")).filter(F.col("_pair").isNotNull()).select("_pair.*")


def distinct_edges(events: DataFrame) -> DataFrame:
    """Edges with how often each was reported."""
    return edges(events).groupBy("downstream", "upstream").agg(F.count("*").alias("reported"))


def run_status(events: DataFrame, order: list[str]) -> DataFrame:
    """Latest state per run. An unknown event type counts as complete; events without a run are left out."""
    state = _lookup([(F.col("eventType") == t, v) for t, v in RUN_STATES.items()], DEFAULT_STATE)
    runs = events.select(
        F.col("run.runId").alias("run_id"), state.alias("run_state"), *order
    ).filter(F.col("run_id") != "")
    return latest_per_key(runs, ["run_id"], order)
