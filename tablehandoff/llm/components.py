"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.frames import stored

ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links of a star operation. The least neighbour of every node is an aggregate that
    combines before the shuffle; its join with the links splits a hot node."""
    both = links if not large else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link to a lesser node, which has none itself."""
    several = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    linked = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return several.unionByName(linked).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``a`` (a node that is not the least of its component) and ``b`` (the least node of it).

    Large-star and small-star steps until only stars are left: the number of rounds grows with the
    logarithm of the longest path, and no step collects a node's neighbours. Links to itself and
    repeated links change nothing; no links, no rows.
    """
    turned = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(turned.where(F.col("a") != F.col("b")).distinct(), "links")
    for _ in range(ROUNDS):
        if _stars(current):
            return current
        current = stored(_star(stored(_star(current, True), "large"), False), "small")
    raise RuntimeError("the components did not settle")
