"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: link a node's larger neighbours to its least neighbour. Small: link a node and its smaller neighbours to the least of them.

    A hub's edges are combined before the shuffle for the minimum; the join back may be split by Spark.
    """
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long). Returns (u, v): every node but the least of its component, and that least node. Needs about log(nodes) rounds."""
    edges = stage(edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _is_done(edges):
        edges = stage(_star(_star(edges, True), False))
    return edges


def _is_done(edges: DataFrame) -> bool:
    """Every node has one edge down, and it leads to a node that has none."""
    total, nodes = edges.agg(F.count("*"), F.count_distinct("u")).first()
    return total == nodes and edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()
