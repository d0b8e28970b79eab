"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for each node of the edges ``a``, ``b``.

    Alternates two joins until nothing changes: every node hands the smallest
    of its neighbours to the larger ones, then to the smaller ones. The number
    of rounds grows with the logarithm of a component's size; each round's
    edges are stored, so that lost executors cost one round.
    """
    edges = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(least.select("a", F.col("least").alias("b")))
        edges = stored(small.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        now = tuple(edges.agg(F.count("*"), digest).first())
        if now == before:
            break
        before = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
