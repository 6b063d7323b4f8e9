"""Reports on matching and loading runs, as tables: money first, tiers, one-sided tokens, verdicts, homonyms, run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PLAUSIBLE = ["clean", "head_modifier"]
FIXED = ["FIXED", "TOP"]
FLAGS = ["abbrev_expansion", "trailing_generic", "plural_stem", "prefix_abbrev", "extra_token_only", "block_miss"]


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def money_first(suppliers: DataFrame, spend: DataFrame, floor: float = 0.0, threshold: float = 50_000.0, n: int | None = None) -> DataFrame:
    """Suppliers with their spend (supplier_clean, amount), largest first and unknown last, and whether it reaches the
    threshold. A floor above 0 drops those below it or unknown; n is the length of the report, all without it."""
    out = suppliers.join(spend.select("supplier_clean", "amount"), "supplier_clean", "left")
    if floor > 0:
        out = out.filter(F.col("amount") >= floor)
    out = out.withColumn("large", F.coalesce(F.col("amount") >= threshold, F.lit(False))).orderBy(F.desc_nulls_last("amount"), "supplier_clean")
    return out if n is None else out.limit(n)


def new_vs_production(pairs: DataFrame, production: DataFrame) -> DataFrame:
    """Pairs (supplier_clean, company_number, …) + new_vs_production: the supplier had no such number before."""
    known = production.select("supplier_clean", "company_number").distinct().withColumn("_known", F.lit(True))
    return pairs.join(known, ["supplier_clean", "company_number"], "left").withColumn("new_vs_production", F.col("_known").isNull()).drop("_known")


def _best(pairs: DataFrame, spend: DataFrame) -> DataFrame:
    return pairs.filter("rank = 1").join(spend.select("supplier_clean", "amount"), "supplier_clean", "left")


def tier_summary(pairs: DataFrame, spend: DataFrame, threshold: float = 50_000.0) -> DataFrame:
    """Best pairs of each tier: suppliers, their spend, and how many reach the threshold."""
    amount = F.coalesce(F.sum("amount"), F.lit(0)).cast("double")
    return _best(pairs, spend).groupBy("match_tier").agg(F.count(F.lit(1)).alias("suppliers"), amount.alias("amount"), _count(F.col("amount") >= threshold).alias("large"), F.first(F.col("match_tier").isin(PLAUSIBLE)).alias("plausible"))


def family_summary(pairs: DataFrame, spend: DataFrame) -> DataFrame:
    """Plausible best pairs by primary category, and by each flag that they carry (a pair can carry several)."""
    kinds = [F.struct(F.lit("category").alias("kind"), F.col("primary_category").alias("name"))]
    kinds += [F.when(F.col(f"cat_{f}"), F.struct(F.lit("flag").alias("kind"), F.lit(f).alias("name"))) for f in FLAGS]
    rows = _best(pairs, spend).filter(F.col("match_tier").isin(PLAUSIBLE)).select("amount", F.explode(F.filter(F.array(*kinds), lambda k: k.isNotNull())).alias("k"))
    return rows.groupBy("k.kind", "k.name").agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("amount"))


def one_sided_tokens(pairs: DataFrame, column: str, spend: DataFrame, top: int = 30) -> DataFrame:
    """The most frequent tokens that only one side of the best pairs has, with the spend of their suppliers."""
    tokens = _best(pairs, spend).select("amount", F.explode(column).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("amount"), F.lit(0)).cast("double").alias("amount"))
    return counts.orderBy(F.desc("pairs"), "token").limit(top)


def verdict_summary(scored: DataFrame) -> DataFrame:
    """Rows of each label by verdict; fixed_rate: resolved or first candidate, of those with a known right number."""
    counts = [_count(F.col("verdict") == v).alias(v.lower()) for v in ("FIXED", "TOP", "PRESENT", "ABSENT", "UNKNOWN")]
    out = scored.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), *counts)
    return out.withColumn("fixed_rate", F.round((F.col("fixed") + F.col("top")) / F.nullif(F.col("rows") - F.col("unknown"), F.lit(0)), 4))


def verdict_delta(before: DataFrame, after: DataFrame, label: str = "N") -> DataFrame:
    """Rows of the label that were, and are, resolved or first candidate, and the difference."""
    both = before.withColumn("_now", F.lit(False)).select("label", "verdict", "_now").unionByName(after.withColumn("_now", F.lit(True)).select("label", "verdict", "_now"))
    good = both.filter((F.col("label") == label) & F.col("verdict").isin(FIXED)).agg(_count(~F.col("_now")).alias("before"), _count(F.col("_now")).alias("after"))
    return good.withColumn("delta", F.col("after") - F.col("before"))


def regressions(labels: DataFrame, resolved: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows of label Y whose confirmed number is now neither the resolved one nor among the candidates."""
    padded = lambda df: df.select("supplier_clean", F.lpad("company_number", 8, "0").alias("_number"))
    now = padded(resolved).unionByName(padded(candidates)).distinct().withColumnRenamed("supplier_clean", "_supplier")
    sure = labels.filter("label = 'Y' and trim(company_number) <> ''")
    return sure.join(now, (F.col("supplier_clean") == F.col("_supplier")) & (F.lpad("company_number", 8, "0") == F.col("_number")), "left_anti")


def homonyms_at_cap(candidates: DataFrame, k: int = 5) -> DataFrame:
    """Candidates a supplier, and whether they reach the cap of k, so that more could exist."""
    return candidates.groupBy("supplier_clean").agg(F.count(F.lit(1)).alias("candidates"), (F.count(F.lit(1)) >= k).alias("at_cap"))


def homonym_share(candidates: DataFrame, k: int = 5) -> DataFrame:
    """Suppliers with homonyms, how many sit at the cap, and their share in percent."""
    out = homonyms_at_cap(candidates, k).agg(F.count(F.lit(1)).alias("suppliers"), _count(F.col("at_cap")).alias("at_cap"))
    return out.withColumn("pct", F.round(100.0 * F.col("at_cap") / F.nullif("suppliers", F.lit(0)), 1))


def run_stats(listing: DataFrame, chosen: DataFrame, judged: DataFrame) -> DataFrame:
    """Files found (borough, file), files kept with the way their mapping was found (…, match_type) and judged rows
    (…, fate) -> a row a borough: files by match, left out and empty, rows written and rejected."""
    fates = {"rows_written": "ok", "bad_dates": "bad_date", "bad_amounts": "bad_amount", "bad_suppliers": "bad_supplier"}
    per = judged.groupBy("borough", "file").agg(F.count(F.lit(1)).alias("_rows"), *[_count(F.col("fate") == v).alias(k) for k, v in fates.items()])
    files = listing.select("borough", "file").distinct().join(chosen.select("borough", "file", "match_type").distinct(), ["borough", "file"], "left").join(per, ["borough", "file"], "left")
    way = lambda m: _count(F.col("match_type") == m)
    kept = F.col("match_type").isNotNull()
    return files.groupBy("borough").agg(
        F.count(F.lit(1)).alias("files"), way("FILE").alias("matched_by_file"), way("HEADER").alias("matched_by_header"), way("FALLBACK").alias("fallback_used"),
        _count(~kept).alias("files_skipped"), _count(kept & F.col("_rows").isNull()).alias("empty_files"), *[F.coalesce(F.sum(F.when(kept, F.col(k))), F.lit(0)).alias(k) for k in fates],
    )
