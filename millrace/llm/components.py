"""Connected components of a graph of links, by stars that are joined until nothing moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of `links` (a, b) but the roots: root is the smallest node reached.

    Large-star and small-star steps in turn, about log(n) of them: each node tells its neighbours of
    its smallest one. Smallest neighbours are aggregates, with partial ones in the map tasks. A hub's
    links are spread by AQE, as both sides of each join are plain scans of staged files. No link
    comes to the driver; only a count and a checksum do. NULL ends and loops are no links.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = links.where("a <> b").select(high, low)
    links = stage(links.distinct())
    state = None
    while (now := _checksum(links)) != state:
        state = now
        links = _small_star(_large_star(links))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest one."""
    both = links.union(links.select("b", "a"))
    lowest = stage(both.groupBy("a").agg(F.min("b").alias("_low")))
    told = both.where("b > a").join(lowest, "a")
    return stage(told.select(F.col("b").alias("a"), F.least("a", "_low").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    lowest = stage(links.groupBy("a").agg(F.min("b").alias("_low")))
    told = links.join(lowest, "a").where("b <> _low").select(F.col("b").alias("a"), "_low")
    return stage(told.union(lowest).toDF("a", "b").distinct())


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
