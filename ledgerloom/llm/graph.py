"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialize, release


def connected_components(edges: DataFrame) -> DataFrame:
    """(u long, v long) -> (id, label): the smallest id of each node's component, for every node of an edge between two ids.

    Alternates large-star and small-star until no edge changes; the number of rounds follows the logarithm of the longest
    chain. A node with many edges is pre-aggregated to its smallest neighbour and joined back, never gathered.
    """
    spark = edges.sparkSession
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    keep: list[str] = []
    now = materialize(edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), keep)
    last = state(now)
    while last[0]:
        old = list(keep)
        # large star: every larger neighbour of u moves to the smallest of u and its neighbours
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        grown = both.join(least, F.col("u") == F.col("c")).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        # small star: every smaller neighbour of u moves to the smallest of them
        least = grown.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        met = grown.join(least, F.col("u") == F.col("c"))
        small = met.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
        keep.clear()
        now = materialize(small.distinct(), keep)
        release(spark, old)
        new = state(now)
        if new == last:
            break
        last = new
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).union(now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct())
