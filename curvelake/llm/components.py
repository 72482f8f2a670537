"""Connected components of an undirected graph held as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvelake.session import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, component) per node that has an edge; component is the smallest node it reaches.

    Alternates two contractions until nothing changes: every node links its larger neighbours to its smallest
    one (the neighbourhood's minimum), then every node links its smaller neighbours to it. Each round is
    two aggregations and joins over the edges, which never grow in number; rounds grow with the logarithm of
    the graph. Minima meet as partial aggregates and are joined back, so a node with any number of
    neighbours is never gathered. Edges with a null end or equal ends say nothing and are dropped.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
    )
    links = materialize(links.distinct())
    while True:
        # larger neighbours of u go to the smallest of u and its neighbours
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # smaller neighbours of u, and u, go to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new = materialize(small.where("u != v").distinct())
        if new.count() == links.count() and new.exceptAll(links).isEmpty():
            break
        links = new
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )
