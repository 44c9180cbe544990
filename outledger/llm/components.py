"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outledger.session import pin


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of the links ``a, b``.

    Each round points every node at its smallest neighbour, follows pointers twice, and contracts
    the links to the nodes pointed at; chains shorten by a constant factor a round, stars end after
    one. Every round is written, so lineage stays short; only row counts reach the driver. Links
    are distinct and directed to both sides before they are grouped, and grouping takes minima with
    map-side combine, so a node with very many links is no burden.
    """
    edges = pin(links.where("a <> b").select("a", "b").distinct())
    known = None
    while edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("b"))
        parent = pin(smallest.select(F.col("a").alias("node"), F.least("a", "b").alias("up")))
        for _ in range(2):
            parent = jump(parent, parent)
        parent = pin(parent)
        known = parent if known is None else pin(jump(known, parent))
        left = edges.join(parent.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
        right = left.join(parent.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
        moved = right.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = pin(moved.where("a <> b").distinct())
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return known.select("node", F.col("up").alias("component"))


def jump(table: DataFrame, parent: DataFrame) -> DataFrame:
    """``table`` with every pointer followed one step further."""
    then = parent.select(F.col("node").alias("up"), F.col("up").alias("further"))
    joined = table.join(then, "up", "left")
    return joined.select("node", F.coalesce("further", "up").alias("up"))
