"""Connected components of a graph of numbered nodes, as alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.workspace import stage


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` (its smallest reachable node) of every node of `edges` (a, b: long).

    A large-star step links every larger neighbour of a node to its smallest neighbour, a small-star step
    every smaller one; both shuffle the edges by node, and a node with very many edges is aggregated before
    the shuffle and split by the skew join after it. Each round is written to the shared folder, which cuts
    the lineage; rounds grow with the logarithm of the longest path.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stage(pairs, "edges")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        pairs = stage(small.where("a <> b").distinct(), "edges")
        after = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
