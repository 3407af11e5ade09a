"""Connected components of a graph given by its edges, all steps as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored, stored_and_observed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the least node that it is connected to, for every node of the edges.

    Edges are directed to smaller nodes and rewired in turns: first every node's larger neighbours, then its
    smaller ones, are linked to its least neighbour, which halves paths and leaves stars in the end. Each round
    is stored and compared with the one before by its edge count and a checksum; nodes are never gathered.
    Loops and repeated edges do no harm, null ends are ignored, no edges give no rows.
    """
    links = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("u < v").distinct()
    links = stored(links)
    before = None
    while True:
        links = _small_star(_large_star(links))
        links, seen = stored_and_observed(
            links, n=F.count(F.lit(1)), check=F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))
        )
        if seen == before:
            break
        before = seen
    roots = links.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return roots.union(links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to its least neighbour, itself included."""
    both = links.select("v", "u").union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
    larger = both.where("u > v").join(least, "v")
    return larger.select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link the smaller neighbours of every node, and the node, to the least of them."""
    least = links.groupBy("v").agg(F.min("u").alias("m"))
    joined = links.join(least, "v")
    inner = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return inner.union(least.select("v", F.col("m").alias("u"))).distinct()
