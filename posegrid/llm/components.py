"""Connected components over an edge table, without collecting anything.

Alternating large-star and small-star rounds (Kiveris et al., 2014): every
round hooks neighbours to the least node they see, as grouped minima, so no
adjacency list is held; rounds grow with the logarithm of the graph's size.
Each round's edges are checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hook each node's larger (or not larger) neighbours to its least one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    if large:
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for nodes with an edge.

    ``edges`` has columns ``u`` and ``v``; nulls and loops are ignored.
    """
    edges = durable(edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct())
    seen = _signature(edges)
    while seen[0]:
        edges = durable(_star(_star(edges, True), False))
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
