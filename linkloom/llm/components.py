"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import checkpoint


def roots(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``: the root is the smallest node reachable.

    Each round hangs the larger neighbours of a node, then all its smaller ones, on the smallest of them, until
    every component is a star. Minima are aggregated before the shuffle; the joins that follow stand alone
    before a checkpoint, so that adaptive execution may split a hub's rows.
    """
    links = checkpoint(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .filter("a <> b").distinct())
    before = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                links.select("b", "b").distinct())
        before = state
        both = links.union(links.select("b", "a"))
        links = star(both, both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m")), "b > a")
        links = star(links, links.groupBy("a").agg(F.min("b").alias("m")), "true")


def star(links: DataFrame, minima: DataFrame, chosen: str) -> DataFrame:
    """Every chosen neighbour, and the node itself, hung on the node's minimum."""
    minima = checkpoint(minima)
    hung = links.filter(chosen).join(minima, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return checkpoint(hung.union(minima).filter("a <> b").distinct())
