"""Connected components of a graph given as links, by alternating stars.

Every round replaces the links of a vertex by links to its smallest neighbour, first
for larger neighbours, then for smaller ones, until the links form one star per
component. Links stay in Spark; each round is one checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from armorica.workspace import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Each vertex links its larger neighbours to the smallest of itself and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each vertex links itself and its smaller neighbours to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    least = materialise(down.groupBy("a").agg(F.min("b").alias("least")))
    moved = down.join(least, "a").filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` (numbers, any direction) to rows ``vertex``, ``root``.

    The root is the smallest vertex reachable. Only vertices with a link to another
    vertex are returned, roots included. No links: no rows.
    """
    stars = materialise(links.select("a", "b").filter("a != b").distinct())
    before = None
    while (now := _signature(stars)) != before:
        before = now
        stars = materialise(_small_star(_large_star(stars)))
    members = stars.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
    return members.unionByName(stars.select(F.col("b").alias("vertex"), F.col("b").alias("root"))).distinct()
