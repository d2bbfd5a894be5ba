"""Connected components of a link table by alternating large-star and small-star steps.

Each step is grouped minima and equi-joins; nothing gathers on the driver but two numbers a round. Minima are written
before they are joined, so that both sides of the join are plain exchanges and Spark can split the partition of a node
with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.storage import discard, materialize


def star_components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, root): the smallest node reachable, for every node that a link names; a written table."""
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            both = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")))
            out = materialize(both.distinct(), "star-roots")
            discard(edges)
            return out
        seen = tuple(state)
        large = _large_star(edges)
        small = _small_star(large)
        discard(large)
        discard(edges)
        edges = small


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is joined to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).where("m < a"), "star-m")
    # an edge whose lower end is the least neighbour already stays as it is
    moved = edges.join(least.select(F.col("a").alias("b"), "m"), "b", "left").select("a", F.coalesce("m", "b").alias("b"))
    out = materialize(moved.where("a <> b").distinct(), "star-l")
    discard(least)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, is joined to the node's smallest neighbour."""
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "star-m")
    moved = edges.join(least.where("n > 1").select("a", "m"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = materialize(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "star-s")
    discard(least)
    return out
