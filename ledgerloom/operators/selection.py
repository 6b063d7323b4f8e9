"""Statistics of groups with an exact median that no group's size can break.

Rows are written once with a hash of their keys and counted by it; groups of a bounded number of rows are aggregated with their median,
in one exchange. In larger ones count, sum, least and largest value come from a hash aggregate and the median is selected: values are counted in slices between
the group's bounds, map-side first, the slice that holds the middle rank becomes the next bounds, until
it is one value or two slices meet at the middle. A round moves counts only, however many rows one key has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..plans.scratch import materialize

#: Rows of a group whose values one task may hold; slices of a round.
HELD, SLICES = 10_000, 256


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_k_{k}"]) for k in keys], a["_h"] == b["_kh"])


def _meet(fact: DataFrame, groups: DataFrame, keys: list[str], more: list[str], how: str = "inner") -> DataFrame:
    """Rows of fact (with _h, a hash of the keys) in the groups, with columns of these; null keys match null."""
    right = groups.select(F.col("_h").alias("_kh"), *[F.col(k).alias(f"_k_{k}") for k in keys], *more)
    return fact.join(right, _same(fact, right, keys), how).drop("_kh", *[f"_k_{k}" for k in keys])


def _round(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows(keys, _x, _rank, _two, _low, _high) within their bounds -> the slice that holds rank _rank (from 0): new bounds and rank, or the median."""
    share = (F.col("_x") - F.col("_low")) / (F.col("_high") - F.col("_low"))
    # halves first, so that bounds far apart cannot overflow; the order of values is kept either way
    share = F.when(F.col("_high") - F.col("_low") < F.lit(float("inf")), share).otherwise((F.col("_x") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2))
    at = F.least(F.floor(share * SLICES), F.lit(SLICES - 1)).cast("int")
    at = F.when(F.col("_x") >= F.col("_high"), SLICES).otherwise(at)  # the largest value alone: bounds always shrink
    counts = rows.groupBy("_h", *keys, "_rank", "_two", at.alias("_at")).agg(F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
    order = W.partitionBy("_h", *keys).orderBy("_at")
    upto = F.coalesce(F.sum("_c").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = counts.withColumn("_upto", upto).withColumn("_next", F.lead("_least").over(order))
    held = cut.filter((F.col("_upto") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto") + F.col("_c")))
    rank = F.col("_rank") - F.col("_upto")
    apart = F.col("_two") & (rank == F.col("_c") - 1)  # the upper of two middle values begins the next slice
    done = (F.col("_least") == F.col("_most")) | apart
    value = F.when(apart, F.col("_most") / 2 + F.col("_next") / 2).when(done, F.col("_least"))
    return held.select("_h", *keys, rank.alias("_rank"), "_two", F.col("_least").alias("_low"), F.col("_most").alias("_high"), "_c", value.alias("_median"))


def select_median(rows: DataFrame, keys: list[str], groups: DataFrame, held: int | None = None) -> DataFrame:
    """(_h, keys, _median) of groups(_h, keys, _n, _low, _high) with values in rows(_h, keys, _x), by rounds."""
    open_ = groups.select("_h", *keys, F.floor((F.col("_n") - 1) / 2).alias("_rank"), (F.col("_n") % 2 == 0).alias("_two"), "_low", "_high")
    done = []
    while True:
        mine = _meet(rows, open_, keys, ["_rank", "_two", "_low", "_high"]).filter(F.col("_x").between(F.col("_low"), F.col("_high")))
        told = materialize(_round(mine, keys))
        done.append(told.filter("_median is not null").select("_h", *keys, "_median"))
        open_ = told.filter("_median is null").drop("_c", "_median")
        few = told.filter("_median is null").filter(F.col("_c") <= (HELD if held is None else held))
        last = _meet(rows, few, keys, ["_rank", "_two", "_low", "_high"]).filter(F.col("_x").between(F.col("_low"), F.col("_high")))
        values = last.groupBy("_h", *keys, "_rank", "_two").agg(F.sort_array(F.collect_list("_x")).alias("_v"))
        upper = F.get("_v", (F.col("_rank") + F.col("_two").cast("int")).cast("int"))
        done.append(values.select("_h", *keys, (F.get("_v", F.col("_rank").cast("int")) / 2 + upper / 2).alias("_median")))
        open_ = told.filter("_median is null").filter(F.col("_c") > (HELD if held is None else held)).drop("_c", "_median")
        if not open_.head(1):
            return reduce(DataFrame.unionByName, done)


def group_stats(fact: DataFrame, keys: list[str], amount: str, held: int | None = None) -> DataFrame:
    """keys, _n, _total, _min, _max, _avg, _median of the amount; null is a value of a key, null amounts are not counted."""
    double = F.col(amount).cast("double")
    hashed = materialize(fact.select(*keys, amount, F.xxhash64(*keys).alias("_h")))  # joined once, read twice
    plain = [F.count(amount).alias("_n"), F.sum(amount).alias("_total"), F.min(amount).alias("_min"), F.max(amount).alias("_max"), F.avg(amount).alias("_avg"), F.min(double).alias("_low"), F.max(double).alias("_high")]
    # sizes by hash alone; the few that exceed what a task may hold go another way than all others, which meet once
    most = HELD if held is None else held
    large = materialize(hashed.groupBy("_h").agg(F.count(amount).alias("_n")).filter(F.col("_n") > most).select("_h"))
    if not large.head(1):
        return hashed.repartition("_h").groupBy("_h", *keys).agg(*plain, F.median(double).alias("_median")).drop("_h", "_low", "_high")
    mine = hashed.join(large, "_h", "left_anti").repartition("_h").groupBy("_h", *keys).agg(*plain, F.median(double).alias("_median"))
    rest = hashed.join(large, "_h", "left_semi")
    stats = materialize(rest.groupBy("_h", *keys).agg(*plain))
    closed = (F.col("_n") <= 2) | (F.col("_low") == F.col("_high"))
    out = [mine.select(*stats.columns, "_median"), stats.filter(closed).withColumn("_median", F.col("_low") / 2 + F.col("_high") / 2)]
    groups = stats.filter(~closed)
    if groups.head(1):
        found = select_median(rest.withColumn("_x", double).filter("_x is not null").select("_h", *keys, "_x"), keys, groups, held)
        out.append(_meet(groups, found, keys, ["_median"]))
    return reduce(DataFrame.unionByName, out).drop("_h", "_low", "_high")
