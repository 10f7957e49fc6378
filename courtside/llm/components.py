"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is an aggregation and a join on node ids, written to the shared
folder; only a count and a checksum reach the driver.  A node with very many
neighbours is aggregated before the join, and the join may split it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.materialize import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b: long); label is the smallest node reachable."""
    spark = edges.sparkSession
    now, mark = materialize(edges.select("a", "b").where("a != b").distinct(), "edges"), None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == tuple(found) or found[0] == 0:
            break
        mark = tuple(found)
        now = materialize(_small_star(_large_star(now)).where("a != b").distinct(), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()) if found[0] else (
        spark.createDataFrame([], "node bigint, label bigint"))
