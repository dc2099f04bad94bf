"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.session import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    tied = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) of numbers; the component is its smallest node.

    Both stars keep components and only shorten paths; when nothing changes, every node is tied to its smallest. That
    takes about as many rounds as the logarithm of the longest path, each written to the shared folder. Links of a node
    to itself do no harm; without links there are no rows.
    """
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    current, seen = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"), None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        current = stored(_small_star(stored(_large_star(current), "large")), "small")
    tied = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    alone = nodes.select("node", F.col("node").alias("component"))
    return tied.unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
