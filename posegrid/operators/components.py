"""Connected components of an edge table, and of a mesh's triangles.

Edges are hooked to smaller nodes in alternating rounds (large and small stars):
a round sends every neighbour of a node to the least one it sees, by grouped
minima, so no list of neighbours is held and a node with many neighbours is no
more than many rows.  The rounds needed grow with the logarithm of the longest path; each
round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .export import scratch


def _written(rows: DataFrame) -> DataFrame:
    path = scratch(rows.sparkSession, "edges")
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("u").alias("n"), F.col("v").alias("m")), F.struct(F.col("v").alias("n"), F.col("u").alias("m")))
    return edges.select(F.explode(ends).alias("e")).select("e.n", "e.m")


def _hook(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger neighbours (or the others and itself) to the least node it sees."""
    seen = _both_ways(edges)
    seen = seen if larger else seen.where("m < n")
    least = seen.groupBy(F.col("n").alias("of")).agg(F.min("m").alias("least")).select("of", F.least("of", "least").alias("least"))
    moved = seen.where("m > n") if larger else seen
    hooked = moved.join(least, F.col("n") == F.col("of")).select(F.col("m").alias("u"), F.col("least").alias("v"))
    if not larger:
        hooked = hooked.unionByName(least.select(F.col("of").alias("u"), F.col("least").alias("v")))
    return hooked.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, component): the least node each node of an edge (u, v) reaches.

    Nulls and loops are ignored.  ``rounds`` is given the edges left after each round."""
    edges = _written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if rounds is not None and before is not None:
            rounds.append(mark["n"])
        if tuple(mark) == before or not mark["n"]:
            break
        before = tuple(mark)
        edges = _written(_hook(_hook(edges, True), False))
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def mesh_clusters(triangles: DataFrame) -> DataFrame:
    """(triangle, cluster, size): triangles (triangle, a, b, c: vertices) that
    share edges, directly or not; a cluster is named by its least triangle.

    A triangle with a null or repeated vertex has only the edges it still has."""
    corners = [("a", "b"), ("b", "c"), ("a", "c")]
    sides = F.array(*[F.struct(F.least(x, y).alias("low"), F.greatest(x, y).alias("high"), (F.col(x) != F.col(y)).alias("real")) for x, y in corners])
    held = triangles.select("triangle", F.explode(sides).alias("e")).where("e.real").select("triangle", "e.low", "e.high")
    first = held.groupBy("low", "high").agg(F.min("triangle").alias("first"))
    links = held.join(first, ["low", "high"]).select(F.col("triangle").alias("u"), F.col("first").alias("v"))
    found = components(links).select(F.col("node").alias("of"), "component")
    named = triangles.select("triangle").join(found, F.col("triangle") == F.col("of"), "left").select(
        "triangle", F.coalesce("component", "triangle").alias("cluster")
    )
    sizes = named.groupBy(F.col("cluster").alias("named")).agg(F.count("*").alias("size"))
    return named.join(sizes, F.col("cluster") == F.col("named")).select("triangle", "cluster", "size")


def clean_mesh(triangles: DataFrame, *, largest: int = 1, least: int = 50) -> DataFrame:
    """The clusters that stay: at least as large as the ``largest``-th largest
    one, and of ``least`` triangles."""
    found = mesh_clusters(triangles)
    top = found.groupBy("cluster").agg(F.first("size").alias("size")).orderBy(F.desc("size"), "cluster").limit(largest).collect()
    bound = max(least, min((r["size"] for r in top), default=0))
    return found.where(F.col("size") >= bound)
