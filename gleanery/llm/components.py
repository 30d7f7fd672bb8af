"""Connected components by alternating stars.

Every round links the neighbours of a node to the smallest of them, first those
above the node, then those below. Only minima per node and equi-joins are needed; the
links become stars around the smallest node of each component within a
number of rounds that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialise


def _digest(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def roots(links: DataFrame) -> DataFrame:
    """(a, b) links between non-null nodes to (a, b): each linked node and the smallest node it reaches.

    Smallest nodes themselves are not listed. Each round is written as a scratch table when
    this is called; two numbers per round come to the driver.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = materialise(links.filter("a != b").select(larger, smaller).distinct())
    seen = _digest(links)
    while seen[0]:
        links = materialise(_small_star(_large_star(links)))
        now = _digest(links)
        if now == seen:
            break
        seen = now
    return links
