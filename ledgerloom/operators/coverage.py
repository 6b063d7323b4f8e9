"""Download links and what months they cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import text as T
from ..functions.dates import months_covered

ANCHOR = r"(?is)<a\b[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
TYPE_ORDER = {"CSV": 0, "XLSX": 1, "XLS": 1, "UNKNOWN": 2, "PDF": 3}


def links(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """All anchors of pages in order: pos, href, link_text without noise, file_type by address or text."""
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("body"))
    out = pages.select(*keep, F.posexplode(pairs).alias("pos", "a"))
    text = T.strip(T.squeeze(F.regexp_replace(F.col("a.body"), r"<[^>]*>", " ")))
    return out.select(*keep, "pos", F.col("a.href").alias("href"), text.alias("raw_text")).withColumn("link_text", T.link_text(F.col("raw_text"))).withColumn("file_type", file_type(F.col("href"), F.col("raw_text")))


def file_type(href: Column, text: Column) -> Column:
    h, t = F.lower(F.regexp_replace(href, r"[?#].*$", "")), F.lower(text)
    out = F.lit(None).cast("string")
    for kind in ("csv", "xlsx", "xls", "pdf"):
        out = F.coalesce(out, F.when(F.endswith(h, F.lit(f".{kind}")), kind.upper()))
    for kind in ("csv", "xlsx", "xls", "pdf"):
        out = F.coalesce(out, F.when(t.rlike(rf"\b{kind}\b"), kind.upper()))
    return F.coalesce(out, F.lit("UNKNOWN"))


def matching_links(found: DataFrame, pattern: str, exclude: list[str] | None = None) -> DataFrame:
    """Links whose text or address fits a publisher's pattern and none of its exclusions."""
    out = found.filter(F.col("link_text").rlike(f"(?i){pattern}") | F.col("href").rlike(f"(?i){pattern}"))
    for e in exclude or []:
        out = out.filter(~F.col("href").rlike(f"(?i){e}") & ~F.col("raw_text").rlike(f"(?i){e}"))
    return out


def distinct_pages(found: DataFrame, pattern: str, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Addresses that fit a pattern, once a page, at their first place."""
    return found.filter(F.col("href").rlike(pattern)).groupBy(*keep, "href").agg(F.min("pos").alias("pos"))


def preferred(found: DataFrame, by: list[Column]) -> DataFrame:
    """One link for each value of by: CSV before spreadsheets before others before PDF, then the first."""
    order = F.coalesce(*[F.when(F.col("file_type") == k, v) for k, v in TYPE_ORDER.items()])
    return found.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(order, "pos", "href"))).filter("_n = 1").drop("_n")


def follow(first: DataFrame, second: DataFrame) -> DataFrame:
    """Intermediate pages: for each link of first, the first direct file link of the page it names (second has url), else the
    first link that says download or export."""
    direct = F.col("file_type") != "UNKNOWN"
    hint = F.lower("href").rlike("download|export") | F.lower("raw_text").rlike("download|export")
    best = second.filter(direct | hint).groupBy("url").agg(F.min_by(F.struct("href", "file_type"), F.struct(F.when(direct, 0).otherwise(1), "pos", "href")).alias("b"))
    return first.join(best.select(F.col("url").alias("_u"), F.col("b.href").alias("file_href"), F.col("b.file_type").alias("found_type")), F.col("href") == F.col("_u")).drop("_u")


def covered_months(manifest: DataFrame, text: str = "link_text") -> DataFrame:
    """(…, month) a row for each month a link text covers."""
    return manifest.withColumn("month", F.explode(months_covered(F.col(text))))


def coverage_matrix(months: DataFrame, key: str = "borough") -> DataFrame:
    """Publishers by months: number of files, a column m1..m12 for each calendar month, and a row Total."""
    cells = months.withColumn("_m", F.month("month")).groupBy(key, F.year("month").alias("year")).pivot("_m", list(range(1, 13))).agg(F.count(F.lit(1)))
    cols = [F.coalesce(F.col(str(i)), F.lit(0)).alias(f"m{i}") for i in range(1, 13)]
    body = cells.select(key, "year", *cols)
    total = body.groupBy("year").agg(*[F.sum(f"m{i}").alias(f"m{i}") for i in range(1, 13)]).select(F.lit("Total").alias(key), "year", *[f"m{i}" for i in range(1, 13)])
    return body.unionByName(total)


def coverage_summary(months: DataFrame, key: str = "borough") -> DataFrame:
    """First and last month, months covered and missing, and how often a publisher publishes."""
    per = months.groupBy(key).agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.countDistinct("month").alias("months"), F.count(F.lit(1)).alias("files"))
    span = (F.months_between("last_month", "first_month") + 1).cast("long")
    rate = F.col("files").cast("double") / F.col("months")
    return per.withColumn("span", span).withColumn("missing", span - F.col("months")).withColumn("frequency", F.when(F.col("months") < 3, "unknown").when(rate >= 1, "monthly").otherwise("quarterly"))


def with_months(links_: DataFrame) -> DataFrame:
    """One link for each month and label."""
    return preferred(covered_months(links_), [F.col("page_id"), F.col("month")])
