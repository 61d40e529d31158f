"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node move to its least neighbour; ``a`` lies above ``b`` again."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Neighbours below a node, and the node itself, move to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (
        moved.where("a <> b")
        .unionAll(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the component is its least node.

    Alternating stars: each round is two aggregations and two joins on a node, so a node with
    very many edges is combined map-side and split by the adaptive join.  Rounds end when the
    edge table holds separate stars only, after about the logarithm of the longest path; a table
    that comes as such takes none.  Each half of a round is written to the shared folder: as one
    plan, the first half would stand in it twice, and the driver holds the plans, stages and
    threads of all rounds.  NULL nodes and loops are ignored; no edges, no rows.
    """
    current = cut_lineage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b").distinct()
    )
    while not _settled(current):
        current = cut_lineage(_small_star(cut_lineage(_large_star(current))))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node above another has one edge down, to a node with none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down > 1 OR down = 1 AND up = 1").isEmpty()
