"""Connected components of a graph by repeated hooking to the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node and root, the least node of its component, for every node of edges (a, b).

    Every round hooks each root to the least of its neighbours, shortens the
    paths, and keeps edges between different roots only; it ends without edges.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "components-edges")
    roots = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    roots = stored(roots.withColumn("root", F.col("node")), "components-roots")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        parent = both.groupBy("a").agg(F.least("a", F.min("b")).alias("up"))
        parent = stored(parent, "components-up")
        for _ in range(2):
            above = parent.select(F.col("a").alias("up"), F.col("up").alias("top"))
            parent = parent.join(above, "up").select("a", F.col("top").alias("up"))
        parent = stored(parent, "components-up")
        roots = stored(
            roots.join(parent, roots["root"] == parent["a"], "left").select(
                "node", F.coalesce("up", "root").alias("root")
            ), "components-roots")
        left = parent.select("a", F.col("up").alias("x"))
        right = parent.select(F.col("a").alias("b"), F.col("up").alias("y"))
        moved = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "components-edges")
    return roots
