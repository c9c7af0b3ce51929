"""Connected components of a graph that stays on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stintlake.llm.common import stage


def _hung(edges: DataFrame) -> DataFrame:
    """Hang each node and its neighbours on the least of them; ``open`` marks the rows of nodes that
    were not in a star yet. It takes one shuffle, and puts out a row for each distinct neighbour."""
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.select(F.explode(ways).alias("e")).select("e.a", "e.b").repartition("a").distinct()
    met = both.withColumn("first", F.min("b").over(Window.partitionBy("a")))
    own = (F.col("b") == F.col("first")) & (F.col("b") < F.col("a"))
    return met.select(
        F.when(own, F.col("a")).otherwise(F.col("b")).alias("a"), F.least("a", "first").alias("b"),
        # in a star, a node has larger neighbours only, or a single one that is smaller
        ((F.col("first") < F.col("a")) & (F.col("b") != F.col("first"))).alias("open"),
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; the root is the smallest node reachable.

    All that is linked with a node moves to its smallest neighbour until every group is a star; the
    rounds grow with the logarithm of the longest path. Each round is written, so lineage stays short.
    """
    edges = edges.filter("a <> b")
    # Edges are two numbers: a task for each core holds them, whatever the number of shuffle partitions.
    tasks = 2 * edges.sparkSession.sparkContext.defaultParallelism
    while True:
        edges = stage(_hung(edges.select("a", "b")).coalesce(tasks), "stars")
        if edges.filter("open").isEmpty():
            break
    ends = F.array(F.struct(F.col("a").alias("node"), "b"), F.struct(F.col("b").alias("node"), "b"))
    return edges.select(F.explode(ends).alias("e")).select("e.node", F.col("e.b").alias("root")).distinct()
