"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step is two shuffles over the links; the number of steps grows with the logarithm of
the number of nodes.  Each step's links are a table in the shared folder.  A node that a
third of all links meet is no group in memory: a step takes a minimum per node (combined
before the shuffle) and joins it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept


def _large_star(links: DataFrame) -> DataFrame:
    """Connects every node's larger neighbours to the least of its neighbours and itself."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Connects every node's smaller neighbours and itself to the least of them (links have a < b)."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    moved = links.join(least, "b")
    return moved.select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b").union(moved.select(F.col("m").alias("a"), "b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link (a, b); the component is its least node."""
    now = kept(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while True:
        # a star forest: no node is both a centre and a leaf, and no leaf has two centres
        state = now.agg(F.count("*").alias("n"), F.count_distinct("b").alias("leaves")).first()
        chained = state["n"] and (state["n"] != state["leaves"] or now.select("a").join(now.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count())
        if not chained:
            break
        now = kept(_small_star(_large_star(now)), "links")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
