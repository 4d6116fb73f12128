"""Connected components of a link table by alternating stars: every step is a minimum per vertex and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.session import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours v."""
    return materialize(pairs.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m")), "stars")


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.shiftrightunsigned(F.xxhash64("u", "v"), 24))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``(u, v)`` links between longs to ``(u, label)`` for every vertex with a link: label is the smallest vertex reachable.

    A hub's links are reduced to a minimum before they are shuffled; joins with the minima read written tables
    on both sides, so a hub's rows can be split.  The driver sees two numbers a step."""
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    links = materialize(links.filter("u != v").select(high, low).distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        # Large star: every larger neighbour of u is tied to the smallest vertex around u.
        both = materialize(links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "arcs")
        large = both.filter("v > u").join(_smallest(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        large = materialize(large.distinct(), "links")
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        tied = large.join(_smallest(large), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        links = materialize(tied.select("x.u", "x.v").filter("u != v").distinct(), "links")
    return links.select("u", F.col("v").alias("label")).union(links.select(F.col("v").alias("u"), F.col("v").alias("label")).distinct())
