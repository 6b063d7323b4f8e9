"""Classification keys: aggregate, scope and flow, remediation findings, answers merged back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import values as V
from ..functions.money import round2
from ..functions.text import blank_to_null
from ..plans.ranking import global_rank
from ..plans.scratch import materialize
from .selection import group_stats


def require(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def taxonomy_base(fact: DataFrame, amount: str = "amount", keys: list[str] | None = None) -> DataFrame:
    """One row for each combination of keys (null is a value), with statistics of the amount and rq_id by total, largest first."""
    keys = keys or V.KEY_COLUMNS
    require(fact, [*keys, amount])
    stats = group_stats(fact, keys, amount)
    out = stats.select(*keys, F.col("_n").alias("row_count"), *[round2(F.col(f"_{k}")).alias(n) for k, n in (("total", "total_amount"), ("min", "min_amount"), ("max", "max_amount"), ("avg", "avg_amount"), ("median", "median_amount"))])
    ranked = global_rank(out, [F.col("total_amount").desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in keys]], "_n")
    return ranked.select(F.concat(F.lit("RQ_"), F.col("_n")).alias("rq_id"), *out.columns)


def _low(df: DataFrame, column: str) -> Column:
    return F.lower(F.coalesce(F.col(column).cast("string"), F.lit(""))) if column in df.columns else F.lit("")


def _level1(df: DataFrame) -> Column:
    return F.coalesce(F.col("Level 1"), F.lit("")) if "Level 1" in df.columns else F.lit("")


def drop_blank_rows(df: DataFrame) -> DataFrame:
    return df.filter(reduce(lambda a, b: a | b, [blank_to_null(F.col(c).cast("string")).isNotNull() for c in df.columns]))


def blank_lines(df: DataFrame, line: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """Rows with any text in a column other than ``line``, and the lines of those without: a row of a table dropped later is traced to its file."""
    text = reduce(lambda a, b: a | b, [blank_to_null(F.col(c).cast("string")).isNotNull() for c in df.columns if c not in (line, "path", "row_idx")])
    return df.filter(text), df.filter(~text).select(*[c for c in ("path", line) if c in df.columns])


def scope(df: DataFrame) -> Column:
    """Statutory transfer before ledger movement before in scope. Before enrichment there is no Level 1 and terms alone do not decide."""
    expense, l1 = _low(df, "expense_type"), _level1(df)
    statutory = (_low(df, "supplier_clean").rlike(V.STATUTORY_PAYEE) | (expense.rlike(V.STATUTORY_TERM) & (l1 == "Financial Services"))) & ~(expense.rlike(V.CONCESSION_TERM) & (l1 == "Passenger Transport"))
    return F.when(statutory, V.SCOPES["statutory"]).when(expense.rlike(V.LEDGER_TERM), V.SCOPES["ledger"]).otherwise(V.SCOPES["in"])


def flow(df: DataFrame, scope_column: str = "procurement_scope") -> Column:
    amount = F.coalesce(F.col("total_amount").try_cast("double"), F.lit(0.0))
    return F.when(amount >= 0, V.FLOWS["spend"]).when(F.col(scope_column) != V.SCOPES["in"], V.FLOWS["reversal"]).when(_low(df, "expense_type").rlike(V.INCOME_TERM), V.FLOWS["income"]).otherwise(V.FLOWS["refund"])


def flag_scope_flow(base: DataFrame, blank_rows: bool = False) -> DataFrame:
    """base + procurement_scope, flow_type_taxonomy_key_aggregate. A base has no blank rows; tables read from files may, and dropping
    them (``blank_rows``) needs every column."""
    scoped = (drop_blank_rows(base) if blank_rows else base).withColumn("procurement_scope", scope(base))
    return scoped.withColumn("flow_type_taxonomy_key_aggregate", flow(scoped))


def anchors(df: DataFrame) -> DataFrame:
    expense, l1 = _low(df, "expense_type"), _level1(df)
    return df.withColumn("anchor_accommodation", expense.rlike(V.ACCOMMODATION_TERM) & (l1 != "Housing Management")).withColumn("anchor_acquisition", expense.rlike(V.ACQUISITION_TERM) & l1.isin(V.CATCHALL_LEVELS))


def is_nec(code: Column) -> Column:
    return F.coalesce(F.pmod(code.try_cast("bigint"), F.lit(100)) == 99, F.lit(False))


def pin_hits(df: DataFrame, pins: DataFrame) -> DataFrame:
    """A row for each row and pin(pin_pattern, pin_code) whose pattern the supplier matches while its code differs.

    Pins are a rule table of a size fixed by hand, so they are sent to every task.
    """
    name = F.lower(F.coalesce("supplier_clean", F.lit("")))
    return df.join(F.broadcast(pins), F.regexp_like(name, F.col("pin_pattern")) & ~F.col("taxonomy_code").eqNullSafe(F.col("pin_code")))


def pin_summary(df: DataFrame, pins: DataFrame) -> DataFrame:
    """One row a pin: rows, amount, rows on target, their share, spread over Level 1, and a warning where it is diverse."""
    name = F.lower(F.coalesce("supplier_clean", F.lit("")))
    hit = df.join(F.broadcast(pins), F.regexp_like(name, F.col("pin_pattern")))
    l1 = F.coalesce("Level 1", F.lit("?"))
    per = hit.groupBy("pin_pattern", "pin_code", l1.alias("l1")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("total_amount").cast("decimal(28,2)")).alias("amount"), F.sum(F.when(F.col("taxonomy_code") == F.col("pin_code"), 1).otherwise(0)).alias("on"))
    spread = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "l1"))), lambda x: F.concat(x["l1"], F.lit(":"), (-x["k"]).cast("string"))), "; ")
    one = per.groupBy("pin_pattern", "pin_code").agg(F.sum("n").alias("rows"), F.sum("amount").alias("amount"), F.sum("on").alias("on"), spread.alias("level1_spread"))
    out = F.broadcast(pins).join(one, ["pin_pattern", "pin_code"], "left")
    conc = F.try_divide(F.col("on").cast("double"), F.col("rows"))
    return out.select(
        "pin_pattern", "pin_code", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("total_amount"), F.coalesce("on", F.lit(0)).cast("long").alias("already_on_target"),
        F.round(conc, 3).alias("concentration"), F.coalesce("level1_spread", F.lit("")).alias("level1_spread"), F.when(conc < 0.5, "DIVERSE VENDOR — review before apply").otherwise("").alias("warning"),
    )


def consensus(df: DataFrame, share: float = V.CONSENSUS_SHARE) -> DataFrame:
    """Rows of suppliers with several Levels 1, of which one has ``share`` of all rows or more, that lie outside of it.

    Ties for the most frequent level go to the first by name; the suggested code is the most frequent one in it, the
    smallest of several. A supplier is reduced to counts by level and code before rows meet it again.
    """
    known = df.filter(F.col("supplier_clean").isNotNull() & ~F.col("supplier_clean").rlike(V.REDACTED_SUPPLIER))
    codes = known.groupBy("supplier_clean", "Level 1", "taxonomy_code").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.when(F.col("taxonomy_code").isNotNull(), F.struct((-F.col("n")).alias("k"), F.col("taxonomy_code").alias("code"))))
    levels = codes.groupBy("supplier_clean", "Level 1").agg(F.sum("n").alias("n"), best.alias("b"))
    entry = F.struct((-F.col("n")).alias("k"), F.col("Level 1").alias("l1"), F.col("b.code").alias("code"))
    firms = levels.groupBy("supplier_clean").agg(F.sum("n").alias("total"), F.count("Level 1").alias("kinds"), F.min(F.when(F.col("Level 1").isNotNull(), entry)).alias("top"))
    firms = firms.filter((F.col("kinds") >= 2) & (-F.col("top.k") >= F.lit(share) * F.col("total"))).select(F.col("supplier_clean").alias("_s"), F.col("top.l1").alias("consensus_l1"), F.col("top.code").alias("consensus_code"))
    out = known.join(firms, F.col("supplier_clean") == F.col("_s")).drop("_s").filter(~F.col("Level 1").eqNullSafe(F.col("consensus_l1")))
    return out.withColumn("kind", F.when(F.col("Level 1").isin(V.CATCHALL_LEVELS), "CATCHALL").otherwise("REVIEW"))


def nec_fallback(answers: DataFrame, taxonomy: DataFrame, code: str = "taxonomy_code") -> DataFrame:
    """Codes that the taxonomy lacks become the first that it has among their 4, 3, 2 and 1 leading digits filled with nines.

    Tried as four joins with the distinct codes, so no row is repeated; ``resolution_status`` tells which were replaced.
    """
    valid = taxonomy.select(F.col("code").cast("bigint").alias("code")).distinct()
    out = answers.withColumn("_c", F.col(code).try_cast("bigint"))
    text = F.col("_c").cast("string")
    for n in (6, 4, 3, 2, 1):
        want = F.col("_c") if n == 6 else F.when(F.length(text) >= n, F.rpad(F.substring(text, 1, n), 6, "9").cast("bigint"))
        out = out.withColumn(f"_w{n}", want).join(valid.select(F.col("code").alias(f"_v{n}")), F.col(f"_w{n}") == F.col(f"_v{n}"), "left")
    found = F.coalesce("_v6", "_v4", "_v3", "_v2", "_v1")
    replaced = F.col("_v6").isNull() & found.isNotNull()
    return out.withColumn(code, F.coalesce(found, "_c")).withColumn("resolution_status", F.when(replaced, "NEC_FALLBACK").otherwise(F.col("resolution_status"))).select(*answers.columns)


def merge_results(base: DataFrame, answers: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Base rows with their answer (by rq_id) and the taxonomy's levels (by code); rows without keep nulls."""
    fixed = nec_fallback(answers, taxonomy)
    return base.join(fixed, "rq_id", "left").join(taxonomy.withColumn("taxonomy_code", F.col("code").cast("bigint")).drop("code"), "taxonomy_code", "left")


def enrich_fact(fact: DataFrame, enriched: DataFrame, keys: list[str] | None = None, metrics: tuple[str, ...] = ("rq_id", "row_count", "total_amount", "min_amount", "max_amount", "avg_amount", "median_amount")) -> DataFrame:
    """Fact rows with what their key row gained; null keys match null. The first of rows with one key (by all columns) is used,
    so the number of fact rows stays."""
    keys = keys or V.KEY_COLUMNS
    gained = [c for c in enriched.columns if c not in keys and c not in metrics]
    first = enriched.groupBy(*keys).agg(F.min(F.struct(*gained)).alias("_g"))
    right = first.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(f"_g.{c}").alias(c) for c in gained])
    cond = reduce(lambda a, b: a & b, [fact[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])
    return fact.join(right, cond, "left").drop(*[f"_k_{k}" for k in keys])


def incremental_replace(fact: DataFrame, fresh: DataFrame, key: str = "borough") -> DataFrame:
    """Fact with all rows of the publishers in fresh replaced; columns that only one side has are null on the other."""
    gone = fresh.select(F.col(key).alias("_k")).distinct()
    return fact.join(gone, fact[key].eqNullSafe(gone["_k"]), "left_anti").unionByName(fresh, allowMissingColumns=True)


def reconcile(before: DataFrame, after: DataFrame, targets: DataFrame, key: str = "borough") -> DataFrame:
    """Rows before and after a replacement for each publisher; those that were no target must be equal."""
    a = before.groupBy(key).agg(F.count(F.lit(1)).alias("n_before"))
    b = after.groupBy(key).agg(F.count(F.lit(1)).alias("n_after"))
    t = targets.select(F.col(key)).distinct().withColumn("target", F.lit(True))
    out = a.join(b, key, "full").join(t, key, "left")
    n0, n1 = F.coalesce("n_before", F.lit(0)), F.coalesce("n_after", F.lit(0))
    return out.select(key, n0.alias("n_before"), n1.alias("n_after"), (n1 - n0).alias("diff"), F.when(F.coalesce("target", F.lit(False)), "REPLACED").when(n0 == n1, "PASS").otherwise("FAIL").alias("status"))


def running_share(df: DataFrame, amount: str, order: list[Column], name: str = "cum_amount_pct") -> DataFrame:
    """Cumulative share of the amount in the given order. Sums run within ranges; only a sum a range meets in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    sums = dealt.groupBy("_part").agg(F.sum(amount).alias("_s"))
    upto = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_s").over(upto), F.lit(0)).alias("_before"), F.sum("_s").over(W.partitionBy()).alias("_total"))
    within = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return dealt.withColumn("_run", F.sum(amount).over(within)).join(starts, F.col("_part") == F.col("_p")).withColumn(name, F.try_divide((F.col("_before") + F.col("_run")).cast("double"), F.col("_total").cast("double"))).drop("_part", "_p", "_run", "_before", "_total")
