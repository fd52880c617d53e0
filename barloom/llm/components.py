"""Connected components of a graph that lies in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import stored


#: Edges from which on a node is a hub, and how many hubs are sent to all tasks at most.
HUB, HUBS = 1_000, 1_000_000


def _settled(edges: DataFrame) -> bool:
    """Whether all edges lead from a node of one edge to a node that leads nowhere."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = up.union(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.filter("up > 1 or (up = 1 and down = 1)").agg(F.count(F.lit(1))).first()[0] == 0


def _with_least(edges: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """``a``, ``b`` and ``m``, what ``least`` has for ``a``, of every edge.

    The edges of a node with more than ``hub`` are not brought together: such nodes are
    few, and sent to all tasks.
    """
    least = stored(least, "least")
    many = least.filter(F.col("n") > hub).select("a", F.col("m").alias("_m"))
    marked = edges.join(F.broadcast(many), "a", "left")
    rest = marked.filter(F.col("_m").isNull()).select("a", "b").join(least.select("a", "m"), "a")
    return rest.union(marked.filter(F.col("_m").isNotNull()).select("a", "b", F.col("_m").alias("m")))


def _large_star(edges: DataFrame, hub: int) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour, or itself."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    count = F.count(F.lit(1)).alias("n")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), count)
    tied = _with_least(both.filter("b > a"), least, hub)
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _small_star(edges: DataFrame, hub: int) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    tied = _with_least(edges, least, hub).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return tied.filter("a > b").union(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) of all nodes of ``edges`` (``a``, ``b``).

    Edges are turned, by turns, into stars around larger and smaller least neighbours
    until only stars are left; each round is written, so that lineage stays short. Nodes are
    whole numbers, neither null. An edge may be given in either direction, and twice.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.filter("a > b").distinct(), "edges")
    # Rounds add no edges, and each is counted at both ends: no more than HUBS nodes have more.
    hub = max(HUB, 2 * edges.count() // HUBS)
    while not _settled(edges):
        edges = stored(_small_star(stored(_large_star(edges, hub), "edges"), hub), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
