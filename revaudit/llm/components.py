"""Connected components by alternating star contractions, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable, for each node of an edge.

    A large-star step links a node's larger neighbours to the smallest of its
    neighbourhood, a small-star step does so with the smaller ones; every edge set is written, so
    the plan does not grow.  The minima are partial aggregates, so a node with very many edges is
    no hot spot there; the join after it is left to adaptive skew handling.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                                 F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        now = stored(small, "links")
        again = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.count_distinct("a")).first())
        if again == mark or again[0] == again[2] and now.join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break  # stars: each node has one edge, to a node that has none
        mark = again
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(now.select("b", "b").distinct())
