"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from censusloom.plans.storage import settle


def _to_least(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _stars(edges: DataFrame) -> bool:
    """Whether every node that points to another one points to just one, which points to none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    each = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return each.where("out > 1 or out = 1 and into = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (node, component): the least node that each linked node reaches, itself included.

    Every step shrinks the links towards stars and is written out, so a lost executor repeats one step at most. The
    steps end when only stars are left; their number grows with the logarithm of the longest path.
    """
    edges = settle(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = _to_least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = settle(small.where("u <> v").distinct(), "links")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
