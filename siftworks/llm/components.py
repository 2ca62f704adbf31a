"""Connected components over an edge table, by alternating large-star and small-star rounds.

Each round keeps only minima per node (partial aggregation, no neighbour lists), and the nodes of most neighbours are
joined with their edges by a broadcast, so such a node costs no task more than its share; rounds are cut by checkpoints
and nothing but counters reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """(child, parent), child > parent. Every node links its larger neighbours to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
    least = both.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("low"), F.count(F.lit(1)).alias("degree")).withColumn("low", F.least("node", "low"))
    # (u, v) with v > u gives (v, low(u)); u is the parent side of the oriented edge
    return join_hot(edges.withColumnRenamed("parent", "node"), least, ["node"], "degree").select("child", F.col("low").alias("parent")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("low"))
    moved = edges.join(least, edges.child == least.node).where("parent <> low").select(F.col("parent").alias("child"), F.col("low").alias("parent"))
    return moved.unionByName(least.select(F.col("node").alias("child"), F.col("low").alias("parent"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(child, parent) of bigint edges, child > parent, to one row (child, parent) a node, parent the least node it reaches. Least nodes have no row."""
    now = materialize(edges.where("child > parent").distinct())
    while True:
        now = materialize(_small_star(_large_star(now)))
        # a forest of stars: no parent is itself a child, no child has two parents
        roots = now.select(F.col("parent").alias("child")).distinct()
        if now.join(roots, "child", "left_semi").isEmpty() and now.groupBy("child").count().where("count > 1").isEmpty():
            return now
