"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for each node that has an edge; component is the smallest node in reach.

    Every round hangs the larger neighbours of a node under its smallest one, then the
    smaller ones, until the edges stay as they are: then each node hangs under the smallest
    of its component. Minima are combined before the shuffle, so a node with very many
    edges is no group in one task; the join back is one that adaptive execution may split.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges, before = stored(edges), None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(hung.union(least.select("u", F.col("m").alias("v"))).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
