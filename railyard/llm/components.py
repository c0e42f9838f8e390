"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm import tables


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links``; unlinked nodes are not in it.

    Every round points each node to the smallest node known around it, then hangs that node's own target below it.
    Nodes with many links are pre-aggregated; a round reads and writes one row per link.
    """
    edges = links.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    edges = tables.written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        # large step: all larger neighbours of u go below the smallest node next to u
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = tables.written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "low")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = tables.written(large.filter("u <> v"), "large")
        # small step: all smaller neighbours of u, and u, go below the smallest of them
        low = tables.written(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        small = tables.written(small.filter("u <> v").distinct(), "small")
        # a forest of stars: every u has one v, and no v is a u
        twice = small.count() - small.select("u").distinct().count()
        if twice == 0 and small.join(small.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            roots = small.select("v").distinct()
            return tables.written(small.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))), "roots")
        edges = small
