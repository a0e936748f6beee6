"""Connected components of a table of links, by alternating large and small stars.

Each round replaces links so that nodes point to smaller ones, in O(log n)
rounds; a round is two aggregations and joins over the links, cut by a
reliable checkpoint.  Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large(links: DataFrame) -> DataFrame:
    """Every neighbour above a node points to the least of the node and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small(links: DataFrame) -> DataFrame:
    """A node and its neighbours below point to the least of these."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    joined = down.join(least, F.col("u") == F.col("k"))
    hooks = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return hooks.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the least node of its component."""
    now = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    while not _stars(now):
        now = cut(_small(_large(now)))
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _stars(links: DataFrame) -> bool:
    """Whether each node points to one smaller node that itself points to none: the fixed point."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()
