"""Connected components of a graph given as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node reachable.

    Alternating stars: every node's larger neighbours are hung on its smallest neighbour, then its
    smaller ones, until nothing moves. A few rounds of joins and sums; each round is stored, so a
    lost executor costs that round at most. A node with very many neighbours is only ever one
    row of sums; its rows are spread by the join.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialize(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == now:
            break
        state = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
