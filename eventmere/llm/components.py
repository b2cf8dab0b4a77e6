"""Connected components of a list of links, by rounds of star steps.

In each round every node is linked to the smallest node it knows, first among
larger, then among smaller neighbours; links of one component soon form a star
around its smallest node. Links are tables throughout; only the number of links
that moved is read by the driver. A node with very many links is handled by
aggregation and joins only, which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmere.llm import shared


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    kept = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kept.unionByName(low.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that has a link ``a``, ``b``."""
    links = shared.stored(_small_star(links).distinct(), "links")
    while True:
        now = shared.stored(_small_star(_large_star(links)).distinct(), "links")
        sizes = [x.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first() for x in (links, now)]
        links = now
        if tuple(sizes[0]) == tuple(sizes[1]):
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.distinct())
