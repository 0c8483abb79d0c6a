"""Connected components of a graph of links, as Spark joins over tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _stars(links: DataFrame, nodes: str, others: str) -> DataFrame:
    """For each node the least of it and its neighbours, next to each neighbour."""
    least = links.groupBy(nodes).agg(F.least(F.min(others), F.col(nodes)).alias("least"))
    return links.join(least, nodes).select(nodes, others, "least")


def _settled(pairs: DataFrame) -> bool:
    """Whether each node has one other node, and that has none itself."""
    ends = pairs.select(F.col("v").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        pairs.select("u", F.lit(0), F.lit(1))
    )
    ends = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return ends.where((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to stored rows (node, root), root being the least node that is linked with it.

    Roots themselves have no row. Two steps alternate until every node hangs on its root: a node hands
    its larger neighbours to its least one, then its smaller ones. The number of rounds grows with the
    logarithm of a chain's length, and a node with very many neighbours is a skewed join key, not a list.
    """
    pairs = stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("v <> u").distinct())
    while not _settled(pairs):
        both = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        large = _stars(both, "v", "u").where("u > v").select(F.col("u").alias("v"), F.col("least").alias("u"))
        large = stored(large.where("v <> u").distinct())
        lower = _stars(large, "v", "u")
        lower = lower.select(F.col("u").alias("v"), F.col("least").alias("u")).union(lower.select("v", "least"))
        pairs = stored(lower.where("v <> u").distinct())
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
