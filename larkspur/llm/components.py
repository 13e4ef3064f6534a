"""Connected components of an edge table by alternating star contractions.

Everything stays in DataFrames; each round's edges are written to the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace


def _hang(edges: DataFrame, larger: bool) -> DataFrame:
    """Hangs each node's larger (or smaller) neighbours, and itself, on its least neighbour.

    The least neighbour is a partial aggregate, so a node with many edges costs no
    task more than its rows; the join that follows can be split by key.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    t = both.join(least, "u")
    if larger:
        out = t.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = t.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node has two edges to smaller ones, or one to a smaller and one to a larger."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down")).union(edges.select("v", F.lit(0)))
    per = ends.groupBy("node").agg(F.sum("down").alias("downs"), F.min("down").alias("least"))
    return per.where((F.col("downs") > 1) | ((F.col("downs") > 0) & (F.col("least") == 0))).count() == 0


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """``node, root`` of every node with an edge in ``edges(u, v)``; root is the least node of its component.

    Nulls and loops are ignored; repeated and reversed edges count once.  The
    number of rounds is logarithmic in the longest path.
    """
    e = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = ws.save(e, "edges")
    while not _settled(e):  # asked of the edges, as a round that changes nothing costs as much as any other
        # after the large star u > v holds again, since a neighbour hangs on something no larger
        big = ws.save(_hang(e, larger=True), "large-star")
        new = ws.save(_hang(big, larger=False), "small-star")
        ws.drop(big)
        ws.drop(e)
        e = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
