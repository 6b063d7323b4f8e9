"""Mixing sources to target weights by entropy balancing.

Every document gets the rate ``exp(sum of the duals of its categories)``: among all ways to spread tokens over the
documents that meet the token constraints, the one of least relative entropy to the corpus. The convex dual is solved
by Newton steps over a table of cells (one row a combination of categories, not a document), a margin at a time; a
margin's block of the Hessian is diagonal, so each step is one aggregation and one join, however many categories there
are. Rates become whole copies by error diffusion over the size histogram of each source, longest first.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..plans.ranking import global_rank
from .common import fresh, materialize, n_words, salted_rank, salts_for


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """(source, source_size) -> + weight, target: total size shared by weight, no target above cap times its source's size.

    Sources in code-point order, null last, take the weights in turn. Excess is shared again by weight among the rest
    until no target is above its bound; each pass of that loop is one aggregation over the sources.
    """
    n = len(weights)
    ranked = global_rank(sources, [F.col("source").asc_nulls_last()], "_rank")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(n)) + 1).cast("int"))
    keep: list[str] = []
    base = materialize(ranked.select("source", "source_size", pick.alias("weight")), keep)
    bound = F.col("source_size") * F.lit(float(cap))
    total = float(base.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = bound < F.col("weight") * F.lit(level)
        got = base.agg(F.sum(F.when(full, bound).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not got[1]:
            break
        new = (total - (got[0] or 0.0)) / got[1]
        if new <= level * (1 + 1e-15):
            break
        level = new
    return base.withColumn("target", F.least(bound, F.col("weight") * F.lit(level)))


def entropy_balance(cells: DataFrame, margins: dict[str, DataFrame], mass: str = "mass", tol: float = 1e-9, iterations: int = 100) -> DataFrame:
    """cells(categories..., mass) and, for each margin, a table (category, target) -> cells + log_rate.

    Newton steps on the dual, one margin's block at a time, until every constraint holds to ``tol``; steps are bounded
    so that far targets cannot overflow. A category of target 0 or mass 0 gets no tilt; the caller drops it.
    """
    keep: list[str] = []
    now = materialize(cells.withColumn("log_rate", F.lit(0.0)), keep)
    for _ in range(iterations):
        worst = 0.0
        for column, targets in margins.items():
            goal = targets.select(F.col(column).alias("_c"), F.col("target").cast("double").alias("_t"))
            taken = now.groupBy(column).agg(F.sum(F.col(mass) * F.exp("log_rate")).alias("_s"))
            step = taken.join(goal, taken[column].eqNullSafe(goal["_c"])).select(
                F.col("_c"), F.when((F.col("_s") > 0) & (F.col("_t") > 0), F.greatest(F.lit(-1.0), F.least(F.lit(2.0), F.col("_t") / F.col("_s") - 1))).otherwise(0.0).alias("_d")
            )
            now = materialize(now.join(step, now[column].eqNullSafe(step["_c"]), "left").withColumn("log_rate", F.col("log_rate") + F.coalesce("_d", F.lit(0.0))).withColumn("_d", F.coalesce("_d", F.lit(0.0))).drop("_c"), keep)
            worst = max(worst, float(now.agg(F.max(F.abs("_d"))).first()[0] or 0.0))
            now = now.drop("_d")
        if worst <= tol:
            return now
    raise ValueError(f"constraints do not hold after {iterations} rounds: a step of {worst} is left")


def to_copies(docs: DataFrame, rates: DataFrame, cap: int = 3, names: tuple[str, ...] = ("source", "size", "tie", "rate", "copies"), narrow: DataFrame | None = None) -> DataFrame:
    """docs(doc_id, source, size, tie, ...) and rates(source, rate) -> docs + rate, copies; ``names`` are these columns' names.
    ``narrow`` has the same rows with the first four columns only, for counts.

    Copies of a source's documents of one size are fixed for the whole cell, from the longest size down: each takes what
    keeps the sum of taken words nearest to the sum of rates, within the whole numbers next to the rate. The last
    difference is less than the smallest size that can still make up for it. Documents without words keep one copy.
    Which documents of a cell get one copy more follows hashes of doc_id and ``tie``; rows equal in both are interchangeable.
    """
    source, size, tie, rate, copies = names
    narrow = docs if narrow is None else narrow
    hist = narrow.groupBy(F.col(source).alias("source"), F.col(size).alias("size")).agg(F.count(F.lit(1)).alias("m"))
    rated = materialize(hist.join(rates.select(F.col("source").alias("_src"), "rate"), hist["source"].eqNullSafe(F.col("_src"))).drop("_src"))

    def fold(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("size", ascending=False)
        want, taken, total = 0.0, 0, []
        for n, m, rate in zip(cell["size"], cell["m"], cell["rate"]):
            want += rate * n * m
            low, high = int(rate) * m, min(cap, -int(-rate // 1)) * m
            k = m if n == 0 else max(min(low, high), min(high, int(round((want - taken) / n))))
            taken += k * n
            total.append(k)
        return cell.assign(k=total)

    plan = rated.groupBy("source").applyInPandas(fold, "source string, size long, m long, rate double, k long")
    m, k, rank = fresh(docs, "mix_m", "mix_k", "mix_rank")
    groups = plan.select(F.col("source").alias(source), F.col("size").alias(size), F.col("m").alias(m), F.col("rate").alias(rate), F.col("k").alias(k))
    salts = salts_for(rated.agg(F.max("m")).first()[0] or 0)
    ranked = salted_rank(docs, [source, size], [F.col("doc_id"), F.col(tie)], F.xxhash64("doc_id", tie), rank, salts, groups, narrow)
    times = F.expr(f"{k} div {m}") + F.when(F.col(rank) < F.col(k) % F.col(m), 1).otherwise(0)
    return ranked.withColumn(copies, times.cast("long")).drop(rank, m, k)


def mixing_rates(sized: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3) -> tuple[DataFrame, DataFrame]:
    """sized(source, size) -> goals (source, source_size, weight, target) and rates (source, rate)."""
    sources = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    goals = materialize(source_targets(sources, weights, cap))
    balanced = entropy_balance(sources.select("source", F.col("source_size").alias("mass")), {"source": goals})
    return goals, materialize(balanced.select("source", F.least(F.lit(float(cap)), F.exp("log_rate")).alias("rate")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Documents -> doc_id, source, size, source_size, target, rate, copies, one row a document.

    Null text has size 0; null sources form one source, null doc_ids and repeated rows are documents like others. An
    empty table gives an empty result.
    """
    sized = materialize(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")))
    goals, rates = mixing_rates(sized, weights, cap)
    copied = to_copies(sized, rates, cap).drop("tie")
    goal = goals.select(F.col("source").alias("_src"), "source_size", "target")
    return copied.join(goal, copied["source"].eqNullSafe(goal["_src"])).drop("_src")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document. See mix for nulls, repeats and empty tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as many times as the mix takes it, all columns kept, whatever their names.

    Rows are numbered where they are, so none is looked up by a key: repeated rows and ids, null sources, null and
    empty texts are documents like others. An empty table gives an empty one.
    """
    cols = docs.columns
    source, size, tie, rate, copies, i = fresh(docs, "mix_source", "mix_size", "mix_tie", "mix_rate", "mix_copies", "mix_i")
    rows = docs.withColumns({source: F.col("source").cast("string"), size: n_words(F.col("text")), tie: F.xxhash64("text")})
    narrow = materialize(rows.select("doc_id", source, size, tie))
    _, rates = mixing_rates(narrow.select(F.col(source).alias("source"), F.col(size).alias("size")))
    copied = to_copies(rows, rates, names=(source, size, tie, rate, copies), narrow=narrow)
    return copied.withColumn(i, F.explode(F.sequence(F.lit(1), F.lit(3)))).filter(F.col(i) <= F.col(copies)).select(*[F.col(f"`{c}`") for c in docs.columns])
