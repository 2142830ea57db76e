"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from coverbay.llm.shared import materialise


def _are_stars(edges: DataFrame) -> bool:
    """Each larger end has one smaller end, which is nobody's larger end."""
    end = lambda name, below: F.struct(F.col(name).alias("node"), F.lit(below).alias("below"))
    ends = edges.select(F.inline(F.array(end("a", 0), end("b", 1))))
    degree = ends.groupBy("node").agg(F.min("below").alias("least"), F.sum("below").alias("below"))
    return degree.where("below > 1 or below = 1 and least = 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``edges`` (a, b): root is the smallest node reachable.

    Large-star and small-star rounds: every node sends its larger neighbours, then its smaller ones,
    to the smallest neighbour it knows, until each component is a star around its smallest node. The
    number of rounds grows with the logarithm of a component's width, each round writes its edges to
    the shared folder, and a hot node's neighbours are combined on the map side only into their
    minimum; they are never gathered.
    """
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("node", "near")
        # large star: near > node goes to the least of node and its neighbours
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
        large = both.join(least, "node").where("near > node").select(F.col("near").alias("b"), F.col("least").alias("a"))
        # small star: a node and its smaller neighbours go to the least of these
        down = large.groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(down, "b").select(F.col("a").alias("x"), "b", "least")
        small = small.select("least", F.col("x").alias("other")).union(small.select("least", F.col("b").alias("other")))
        edges = materialise(small.where("least <> other").select(F.col("least").alias("a"), F.col("other").alias("b")).distinct())
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(edges.select("a", "a").distinct().toDF("node", "root"))
