"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``, not null): the least node it reaches.

    Each step replaces links by links to the least neighbour, so a group of any shape becomes a star in a number of steps
    logarithmic in its size. Least neighbours are aggregated before they are shuffled and joined back; a hub of many links
    is split by the adaptive join. No group is gathered.
    """
    edges = staged(_ordered(links.select("a", "b")), "links")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return labels.unionByName(roots)


def _ordered(links: DataFrame) -> DataFrame:
    """Each link once, from the greater to the lesser node."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the node's least neighbour, or to the node if that is less."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    linked = edges.select(F.col("b").alias("a"), F.col("a").alias("up")).join(least, "a")
    return linked.select(F.col("up").alias("a"), F.least("a", "low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("low").alias("b"))).distinct()
