"""Distributed union-find over link tables, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludora.llm.common import materialise


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each pair with the smallest of `a` and all its partners.

    The minima are written first: then a hub's pairs are a skewed join side that AQE can split.
    """
    least = materialise(pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
    return pairs.join(least, "a")


def _mark(links: DataFrame):
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a, b); root is the smallest node it can reach.

    Alternating stars: first every partner above a node, then the node's
    partners below it, are hung onto the smallest node known; a fixed point is a
    forest of stars.  Rounds grow with the logarithm of the longest path.
    """
    links = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        large = _with_least(_both(links)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # partners below: a > b holds in every link
        small = _with_least(large).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        links = materialise(small, "links")
        if (now := _mark(links)) == mark:
            break
        mark = now
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
