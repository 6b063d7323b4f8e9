"""Supplier names: overrides, clean-up, canonical spelling, context, type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import values as V
from ..functions.text import blank_to_null, comparison_key, initial_caps, strip, supplier_clean
from ..plans.scratch import materialize


def clean_suppliers(fact: DataFrame, overrides: DataFrame | None = None, acronyms: list[str] | None = None, column: str = "supplier", exact: dict[str, str] | None = None, patterns: list[tuple[str, str]] | None = None) -> DataFrame:
    """Fact + supplier_clean. The clean-up runs once a distinct name and is joined back; ``exact`` and ``patterns`` are those
    of values.py if not given.

    overrides(pos, supplier, supplier_clean): names that skip all rules, the last of equal keys wins; their spelling
    is still made canonical. Canonical is the greatest spelling of a comparison key, one with & before others.
    """
    exact, patterns = V.EXACT_NAMES if exact is None else exact, V.NAME_PATTERNS if patterns is None else patterns
    names = fact.select(F.col(column).alias("_name")).distinct().filter("_name is not null")
    cleaned = names.withColumn("_clean", supplier_clean(F.col("_name"), exact, patterns))
    if overrides is not None:
        key = lambda c: F.lower(strip(c))
        fixed = overrides.groupBy(key(F.col("supplier")).alias("_okey")).agg(F.max_by("supplier_clean", "pos").alias("_fixed"))
        cleaned = cleaned.join(fixed, key(F.col("_name")) == F.col("_okey"), "left").withColumn("_clean", F.coalesce("_fixed", "_clean"))
    else:
        cleaned = cleaned.withColumn("_fixed", F.lit(None).cast("string"))
    cleaned = cleaned.withColumn("_clean", F.nullif("_clean", F.lit(""))).withColumn("_key", comparison_key(F.col("_clean")))
    best = cleaned.filter("_clean is not null").groupBy(F.col("_key").alias("_ckey")).agg(F.max(F.struct(F.contains("_clean", F.lit("&")).alias("amp"), F.col("_clean").alias("v"))).alias("_best"))
    canonical = cleaned.join(best, F.col("_key") == F.col("_ckey"), "left").withColumn("_canon", F.coalesce("_best.v", "_clean"))
    if overrides is not None:
        told = overrides.select(F.col("supplier_clean").alias("_told")).distinct()
        canonical = canonical.join(told, F.col("_canon") == F.col("_told"), "left")
    else:
        canonical = canonical.withColumn("_told", F.lit(None).cast("string"))
    final = canonical.select("_name", F.when(F.col("_told").isNotNull(), F.col("_canon")).otherwise(initial_caps(F.col("_canon"), acronyms)).alias("supplier_clean"))
    return fact.join(final, fact[column] == final["_name"], "left").drop("_name")


def changes(df: DataFrame, before: str = "supplier", after: str = "supplier_clean") -> DataFrame:
    """Distinct pairs of names that differ."""
    return df.filter(~F.col(before).eqNullSafe(F.col(after))).select(before, after).distinct()


def _present(c: Column) -> Column:
    v = blank_to_null(c.cast("string"))
    return F.when(F.lower(v) != "nan", v)


TOP_FIELDS = ["service_area", "expense_type", "department", "supplier_category"]


def supplier_context(base: DataFrame, top: int = 3, cap: int = 120) -> DataFrame:
    """A row a supplier: number and sum of transactions, their mean, the top values of four fields by spend, one sentence.

    Field values are summed a supplier and value first, then ranked; a list longer than cap ends at its last whole value.
    """
    base = materialize(base.select("supplier_clean", "row_count", "total_amount", *TOP_FIELDS))  # read for the scale and for the lists
    scale = base.groupBy("supplier_clean").agg(F.sum("row_count").alias("no_of_transactions"), F.sum(F.col("total_amount").cast("decimal(28,2)")).alias("total_spend")).filter("supplier_clean is not null")
    out = scale.withColumn("avg_amount", F.round(F.try_divide("total_spend", "no_of_transactions"), 2).cast("double"))
    long = base.select("supplier_clean", F.col("total_amount").cast("decimal(28,2)").alias("amount"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), _present(F.col(f)).alias("value")) for f in TOP_FIELDS])).alias("x"))
    sums = long.select("supplier_clean", "x.field", "x.value", "amount").filter("value is not null and supplier_clean is not null").groupBy("supplier_clean", "field", "value").agg(F.sum("amount").alias("amount"))
    ranked = sums.withColumn("n", F.row_number().over(W.partitionBy("supplier_clean", "field").orderBy(F.desc("amount"), "value"))).filter(F.col("n") <= top)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "value"))), lambda x: x["value"]), "; ")
    lists = ranked.groupBy("supplier_clean", "field").agg(joined.alias("v")).withColumn("v", F.when(F.length("v") > cap, F.regexp_replace(F.substring("v", 1, cap), "; (?!.*; ).*$", "")).otherwise(F.col("v")))
    wide = lists.groupBy("supplier_clean").pivot("field", TOP_FIELDS).agg(F.first("v"))
    out = out.join(wide, "supplier_clean", "left")
    names = {"service_area": "Service areas", "expense_type": "Expense types", "department": "Departments", "supplier_category": "Supplier categories"}
    parts = [F.when(F.col(f).isNotNull(), F.concat(F.lit(f"{names[f]}: "), F.col(f))) for f in TOP_FIELDS]
    size = F.concat(F.lit("Scale: "), F.format_number("no_of_transactions", 0), F.lit(" no_of_transactions, £"), F.format_number("total_spend", 0))
    return out.select("supplier_clean", "no_of_transactions", F.col("total_spend").cast("double").alias("total_spend"), "avg_amount", *[F.col(f).alias(f"top_{f}") for f in TOP_FIELDS], F.concat_ws(" | ", *parts, size).alias("context_descriptor"))
