"""Connected components of a link table by alternating stars.

Each round links every node's larger neighbours to its smallest one (large star)
and its smaller neighbours to the smallest (small star); the links become stars
around the smallest node of each component in a logarithmic number of rounds.  Only
minima are aggregated (with partial aggregation), neighbour lists are never
collected, so a node with very many links is spread like any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import stage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node hangs on one centre, and no centre hangs on another."""
    twice = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    chained = links.join(links.select(F.col("b").alias("a")), "a", "left_semi").select("a")
    return twice.unionByName(chained).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component: its smallest node."""
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    while not _stars(links):
        links = stage(_small_star(_large_star(links)), "links")
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
