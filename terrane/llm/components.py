"""Connected components of a graph of verified links, by alternating stars.

The large star of a node ties its greater neighbours to the least node around it, the small star its
lesser ones; repeated, every component becomes one star around its least node. Minima are combined on the
map side, so a node with very many links is one row per task in the shuffle; the joins leave a hot node to
the adaptive skew split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import stage


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node but the least ones.

    ``edges`` has columns u and v of one orderable type; loops don't matter.
    """
    now = stage(_small(edges.where(F.col("u") != F.col("v"))))
    seen = _sum(now)
    while True:
        now = stage(_small(_large(now)))
        before, seen = seen, _sum(now)
        if seen == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))


def rooted(parents: DataFrame) -> DataFrame:
    """``node`` and ``label``, the root of its tree, from rows (u, v) that name the one lesser parent u of v.

    Each round doubles how far a node sees, so there are as many as the logarithm of the deepest tree.
    """
    now = parents.select(F.col("v").alias("node"), F.col("u").alias("label"))
    while True:
        above = now.select(F.col("node").alias("label"), F.col("label").alias("_root"))
        seen = stage(now.join(above, "label", "left").select("node", F.coalesce("_root", "label").alias("label"), F.col("_root").isNotNull().alias("_moved")))
        now = seen.select("node", "label")
        if seen.where("_moved").isEmpty():
            return now
