"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialize


def _fingerprint(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)`` (longs): root
    is the smallest node reachable. Loops and repeated edges are allowed.

    Each round links every node's larger neighbours to its smallest one, then
    its smaller ones; rounds grow with the logarithm of the longest path. A
    node's smallest neighbour is an aggregate combined before the shuffle. It
    is written before the join with it, so that AQE may split a hub's rows
    over tasks. Rounds end in written tables.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .distinct(), "edges")
    seen = _fingerprint(now)
    while seen[0]:  # what a round has read is dropped once the next one is written
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select("a", F.least("a", "m").alias("m")), "low")
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large")
        discard(now, low)
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(small.unionByName(low.withColumnRenamed("m", "b")).distinct(), "edges")
        discard(large, low)
        if (after := _fingerprint(now)) == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
