"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapharbor.llm.shared import stored


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("x", "y").cast("decimal(38,0)")), F.lit(0))
        ).first()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. Edges are (x, y) with x < y.

    Large: every larger neighbour of a node goes to the smallest of its neighbourhood.
    Small: every smaller neighbour, and the node, go to the smallest of them.
    """
    turned = edges.select(F.col("y").alias("x"), F.col("x").alias("y"))
    near = edges.unionByName(turned) if large else turned
    least = near.groupBy("x").agg(F.min("y").alias("m"))
    least = least.select("x", F.least("x", "m").alias("m"), F.xxhash64("x").alias("k"))
    # The second key makes both sides shuffle for the join, so that a hub can be split.
    joined = near.withColumn("k", F.xxhash64("x")).join(least, ["x", "k"])
    if large:
        out = joined.where("y > x").select(F.col("m").alias("x"), "y")
    else:
        out = joined.select(F.col("m").alias("x"), "y").unionByName(
            least.select(F.col("m").alias("x"), F.col("x").alias("y"))
        )
    return out.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node reachable.

    ``links`` has long columns x and y. Self-links and repeated links change nothing. The
    number of rounds grows with the square of the logarithm of the longest chain.
    """
    edges = links.where("x <> y").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")
    )
    edges = stored(edges.distinct(), "edges")
    mark = _mark(edges)
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("x").alias("node"), F.col("x").alias("root")).distinct()
    return edges.select(F.col("y").alias("node"), F.col("x").alias("root")).unionByName(roots)
