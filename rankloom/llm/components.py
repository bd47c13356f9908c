"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import join_salted
from rankloom.session import materialise


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """node and component (its smallest reachable node) of every node in links (a, b).

    A round hangs each node's neighbours below the smallest of them, once with the larger and once with the smaller
    neighbours, and depth shrinks by a factor. Smallest neighbours are partial minima; the links of a hot node are split
    where they meet it. It ends when every node hangs below one node that itself hangs below none.
    """
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        # Large star: all larger neighbours of u go below the smallest neighbour of u, or u itself.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.filter("b > a")
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.sum(F.when(F.expr("b > a"), 1).otherwise(0)).alias("many")), name)
        large = join_salted(up, least.drop("many"), ["a"], least.select("a", "many")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = materialise(large.distinct(), name)
        # Small star: smaller neighbours of u, and u, go below the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionByName(least.select("a", F.col("m").alias("b")))
        edges = materialise(small.distinct(), name)
        places = edges.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
        loose = places.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 - above")
        if loose.agg(F.count("*")).first()[0] == 0:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
