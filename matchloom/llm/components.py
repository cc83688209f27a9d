"""Connected components of an edge list by alternating stars, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.session import in_few_files, store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below it are tied to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u != v")


def _unsettled(edges: DataFrame) -> tuple[int, int]:
    """Nodes that are tied to several nodes, or tied to one while others are tied to them (none in stars), and the edges."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("tied")).union(edges.select("v", F.lit(None)))
    found = ends.groupBy("node").agg(F.count("tied").alias("tied"), F.count("*").alias("n"))
    return tuple(found.agg(F.count_if((F.col("tied") > 1) | ((F.col("tied") == 1) & (F.col("n") > 1))), F.coalesce(F.sum("tied"), F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of an edge list (u, v); the component is its least node.

    Nothing but two numbers reach the driver in a round. A node with very many edges is aggregated
    before the shuffle, and its join partition is split by adaptive execution. The edges are stored
    after each round, which keeps the plan short and survives the loss of an executor. They lead from higher to
    lower nodes, so the rounds end when they form stars: a round that changes nothing isn't run to find out.
    A round has no more edges than the one before it, whose number tells how many files will do.
    """
    now = store(edges.filter("u != v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u")).distinct(), "edges")
    while (left := _unsettled(now))[0]:
        now = store(in_few_files(_small_star(_large_star(now).distinct()).distinct(), left[1]), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def stars(label: DataFrame) -> DataFrame:
    """Links (u, v) that connect the same nodes as (node, component)."""
    return label.filter("node != component").select(F.col("node").alias("u"), F.col("component").alias("v"))
