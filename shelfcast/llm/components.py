"""Connected components of a graph given as edges, by stars that shrink towards the smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.sources.staging import discard, new_path, staged_at


def _toward_least(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: the neighbours of each node are linked to the least of them and the node.

    With ``larger_only`` only neighbours larger than the node move (large star), otherwise those
    not larger, the node included (small star).  Least neighbours are found by a combinable
    minimum and joined back, so a node of any degree is never gathered.
    """
    if larger_only:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # u > v in every edge
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); the component is its smallest node.

    Large and small stars alternate until no edge changes; each pair of steps is written to the
    shared folder, and the one before it removed.  An edge from a node to itself keeps that node.
    """
    spark = edges.sparkSession
    loops = edges.where("u = v").select(F.col("u").alias("node")).distinct()
    path = new_path(spark, "edges")
    now = staged_at(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), path)
    state = None
    while True:
        after = new_path(spark, "edges")
        now = staged_at(_toward_least(_toward_least(now, True), False), after)
        discard(spark, path)
        path = after
        # Number of edges and two sums over them tell whether anything moved.
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    reached = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = loops.join(reached.unionByName(roots).select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return reached.unionByName(roots).unionByName(alone)
