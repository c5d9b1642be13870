"""Connected components of a table of links, by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestrata.sources.staging import stage


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link every node's larger (or smaller) neighbours to its least one."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else pairs
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    if larger:
        linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        linked = both.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        linked = linked.unionByName(least.select("a", F.col("least").alias("b")))
    return linked.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): for every node of ``links`` (a, b), the least node it is linked with.

    Rounds grow with the logarithm of the longest chain; each works on one row per link
    and is written to the shared folder, and one number per round reaches the driver.
    """
    tidy = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    pairs = stage(links.where("a <> b").select(*tidy).distinct(), "links")
    before = None
    while True:
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = mark
        pairs = stage(_star(_star(pairs, True), False), "links")
