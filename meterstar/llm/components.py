"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterstar.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of links ``a, b``.

    Alternating large and small stars: every node moves its larger neighbours
    to its smallest one, then its smaller ones, until each component is a star.
    Rounds grow with the logarithm of the longest path. Each round's links
    are written to the shared folder, so a lost executor repeats one round at most. Minima are aggregated before
    they are joined back, so a node with very many links is no bottleneck. Links with NULL ends are no links.
    """
    links = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        before = _digest(links)
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(low, "a")
        small = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            moved.select("a", F.col("low").alias("b"))).where("a <> b").distinct()
        links = materialise(small)
        if _digest(links) == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
