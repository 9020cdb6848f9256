"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from switchback.session import cut_lineage, drop_tables


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b), component the smallest node reachable.

    Both stars are an aggregate and a join on a node, so a node's neighbours
    are never gathered; large partitions of the joins can be split. The number
    of rounds grows with the logarithm of the longest path, and only the last
    round's table stays.
    """
    stars = cut_lineage(_down(edges.select("a", "b")))
    before = None
    while (now := _state(stars)) != before:
        before = now
        last, stars = stars, cut_lineage(_small_star(_large_star(stars)))
        drop_tables(last)
    roots = stars.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)


def _down(pairs: DataFrame) -> DataFrame:
    a, b = pairs.columns
    return pairs.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _down(both.filter(F.col("v") > F.col("u")).join(least, "u").select("v", "m"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    linked = edges.join(least, "hi").select("lo", "m")
    return _down(linked.union(least.select("hi", "m")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())
