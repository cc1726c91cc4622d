"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 50) -> DataFrame:
    """(node, component): for every node of a link the smallest node that it reaches.

    Each round is two joins on a hub with the smallest neighbour of every hub, which is summed before it is dealt; a hub
    with many links is an ordinary skewed join. Rounds end when all links are stars around roots, which is checked node by node; tables
    are cut between rounds, and more than most_rounds rounds are an error.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(most_rounds):
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up")))
        if not ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("down")).where("ups > 1 or (ups = 1 and down = 0)").limit(1).count():
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "large-star")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large, "large-star-links")
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), "small-star")
        joined = large.join(least, "u")
        edges = joined.select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = edges.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = cut(edges, "small-star-links")
    else:
        raise RuntimeError(f"components after {most_rounds} rounds aren't complete")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
