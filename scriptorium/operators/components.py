"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.sources.shared import discard, written


def _to_roots(parent: DataFrame) -> DataFrame:
    """(a, p) with p the end of a's chain of parents: chains halve in each round, so there are as many as the logarithm of the longest."""
    parent = written(parent, "parents")
    while True:
        above = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        jumped = written(parent.join(above, "p").select("a", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")), "parents")
        discard(parent)
        if not jumped.where("moved").take(1):
            return jumped
        parent = jumped.drop("moved")
        parent._scratch = jumped._scratch


def connected(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, root (the smallest node reachable) of every node that an edge names; a written table. In each round every node hangs on its smallest neighbour, trees become nodes, and edges within
    one go: what is left of a component is at most half as many nodes, so rounds are logarithmic. Nothing but single rows reaches the driver."""
    loops = edges.select("a", F.col("a").alias("b"))
    edges = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(loops).unionByName(edges.select(F.col("b").alias("a"), "b")).distinct(), "edges")
    roots = None
    while True:
        parent = _to_roots(edges.groupBy("a").agg(F.min("b").alias("p")))
        own = parent.select("a", "p")
        if roots is None:
            new = written(own.select(F.col("a").alias("node"), F.col("p").alias("root")), "roots")
        else:
            new = written(roots.join(own.withColumnRenamed("a", "root"), "root", "left").select("node", F.coalesce("p", "root").alias("root")), "roots")
            discard(roots)
        roots = new
        left = edges.join(own.withColumnRenamed("p", "pa"), "a").join(own.select(F.col("a").alias("b"), F.col("p").alias("pb")), "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
        left = written(left, "edges")
        discard(edges)
        discard(parent)
        edges = left
        if not edges.take(1):
            discard(edges)
            return roots
        # a tree whose neighbours are all greater stays its own parent
        edges = edges.unionByName(edges.select("a", F.col("a").alias("b"))).unionByName(edges.select(F.col("b").alias("a"), "b"))
        edges._scratch = left._scratch
