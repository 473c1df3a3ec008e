"""Connected components of a stored edge list, by large and small stars.

Each pass hangs the larger neighbours of every node on its least one, then the smaller ones; the edges end
as stars around the least node of each component. Least neighbours come from an aggregate that combines before the
shuffle and meet the edges in a join that Spark can split, so a node with very many edges is no
obstacle; every pass is stored, and only two numbers per pass reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    """Stored (u, m): the least of each node and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return cut_lineage(least.select("u", F.least("u", "m").alias("m")))


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``least``, the least node of its component, for edges ``u``, ``v``, each ``node`` once."""
    stars = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (now := _state(stars)) != before:
        before = now
        both = cut_lineage(stars.union(stars.select("v", "u")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.where("u <> v").distinct())
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        stars = cut_lineage(small.where("u <> v").distinct())
    return stars.select(F.col("u").alias("node"), F.col("v").alias("least"))
