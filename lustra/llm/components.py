"""Connected components of a table of links, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.stored import stored


def _stars(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours move to its least neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    moved = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _flat(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours point to the least of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a")
    kept = moved.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return kept.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node with a link to another.

    ``links`` has columns ``a`` and ``b`` of one ordered type; order, repeats and links
    to oneself don't matter, and rows with a NULL are left out. Two kinds of rewiring
    alternate until nothing changes; each halves long chains. Groups are aggregated and
    joined, never gathered, so a node may have any number of links.
    """
    links = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = stored(links.distinct(), "links")
    before, now = None, _state(links)
    while now != before:
        links = stored(_flat(_stars(links)), "links")
        before, now = now, _state(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select("b", F.col("b").alias("component")).distinct().toDF("node", "component")
    )
