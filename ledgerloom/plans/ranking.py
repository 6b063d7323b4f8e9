"""Global ranks without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .scratch import materialize


def global_rank(df: DataFrame, order: list[Column], rank: str, partitions: int | None = None) -> DataFrame:
    """Rank from 1 in ``order``, over ranges that are sorted and numbered in parallel.

    Rows are dealt to ranges in that order, sorted and numbered within each, and counted; only one count a range
    meets in one task, and is sent to all. ``order`` should be total, else ties are numbered arbitrarily.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the ranges are drawn from a sample, so they are settled once, sorted and numbered within, before they are counted
    dealt = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    counts = dealt.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    upto = W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_start"))
    at = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return dealt.join(F.broadcast(starts), part == starts["_p"]).withColumn(rank, (F.col("_start") + at).cast("long")).drop("_p", "_start", "_id")
