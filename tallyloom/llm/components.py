"""Connected components of a link table by alternating star contractions.

Each round hangs every neighbour that is larger than a node on the least node of that neighbourhood, first for all nodes and then towards smaller ones only,
until the links form stars. The number of rounds grows with the logarithm of the longest chain. Links never reach the driver, only their count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import stash


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(links: DataFrame) -> DataFrame:
    """(node, low): the least of each node and its neighbours. Written first, so that the join with it is one of two shuffles, whose large partitions Spark can split."""
    return stash(links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low")))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; `links` has columns a and b. The component is its least node."""
    links = stash(links.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = None
    while True:
        # Large star: of each node, the neighbours above it move to the least.
        both = _both_ways(links)
        least = _least(both)
        moved = stash(both.join(least, F.col("a") == F.col("node")).filter(F.col("b") > F.col("a")).select(F.col("low").alias("a"), "b").distinct())
        # Small star: of each node, the neighbours below it and itself move to the least.
        down = moved.select(F.col("b").alias("a"), F.col("a").alias("b"))
        least = _least(down)
        hung = down.join(least, F.col("a") == F.col("node"))
        ends = hung.select(F.col("low").alias("a"), "b").union(least.select(F.col("low").alias("a"), F.col("node").alias("b")))
        links = stash(ends.filter(F.col("a") != F.col("b")).distinct())
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state or now[0] == 0:
            break
        state = now
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(links.select("a", F.col("a").alias("component")).distinct())
