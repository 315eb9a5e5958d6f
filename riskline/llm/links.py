"""Connected components of links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b); root is the component's smallest node.

    Large-star and small-star in turn, until the edges are stars: no node has both a smaller
    neighbour and another one.
    """
    stars = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        if not low.where("m < u and n > 1").agg(F.count(F.lit(1))).first()[0]:
            return low.select(F.col("u").alias("node"), F.col("m").alias("root"))
        # large star: larger neighbours move to the smallest of the neighbourhood
        large = both.where("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the node and its smaller neighbours move to the smallest of those
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        stars = checkpointed(small)


def grown(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root) after more edges (a, b): the components so far are stars already."""
    return components(roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
                      .unionByName(edges.select("a", "b")))
