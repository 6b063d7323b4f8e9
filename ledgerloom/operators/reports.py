"""Selections, orders, headers of canonical files, logs and summaries as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import text as T, values as V
from .conform import header_rows
from .diagnostics import homonyms_at_cap

CANONICAL = "AMOD_"


# ---- selections ----------------------------------------------------------------------------------------------------


def named(df: DataFrame, boroughs: list[str] | None = None, files: list[str] | None = None) -> DataFrame:
    """Rows whose publisher and file name have any of the given parts, whatever the case; no parts keep all."""
    for column, parts in (("borough", boroughs), ("file", files)):
        if parts:
            df = df.filter(F.lower(column).rlike("|".join(rf"\Q{p.lower()}\E" for p in parts)))
    return df


def since(df: DataFrame, least: float, year: str = "year") -> DataFrame:
    """Rows of that year or later, the year as a number; years that are none go."""
    return df.withColumn(year, F.trim(F.col(year).cast("string")).try_cast("double")).filter(F.col(year) >= least)


def renamed(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns named by position; raises where the number differs."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def businesses(df: DataFrame, typed: DataFrame, key: str = "supplier_clean") -> DataFrame:
    """Rows of suppliers that are typed Business."""
    return df.join(typed.filter("type = 'Business'").select(key), key, "left_semi")


def requested(context: DataFrame) -> DataFrame:
    """Suppliers that are marked for the next batch."""
    return context.filter(F.upper(F.trim("include_in_batch")) == "Y")


def tiers_together(pairs: DataFrame, tiers: list[str]) -> DataFrame:
    """Pairs of the given tiers, with the place of their tier; one pass, no union of reads."""
    place = F.array_position(F.array(*[F.lit(t) for t in tiers]), F.col("match_tier"))
    return pairs.withColumn("tier_place", place.cast("int")).filter("tier_place > 0")


def by_publisher(links: DataFrame, configs: DataFrame) -> DataFrame:
    """links(borough, pos, href, link_text, raw_text, file_type) that fit a pattern of their publisher -> with its label.

    configs(borough, place, pattern, label, exclude, exclude_pdf, force_ext): patterns are tried in the order of place,
    the first that fits labels the link; exclude is a pattern or null; force_ext, where given, is the link's type.
    """
    c = configs.select("borough", "place", "pattern", "label", "exclude", "exclude_pdf", "force_ext")
    fits = "(link_text rlike concat('(?i)', pattern) or href rlike concat('(?i)', pattern)) and not coalesce(href rlike concat('(?i)', exclude) or raw_text rlike concat('(?i)', exclude), false)"
    found = links.join(c, "borough").filter(F.expr(fits) & ~(F.coalesce("exclude_pdf", F.lit(False)) & (F.col("file_type") == "PDF")))
    first = found.withColumn("_n", F.row_number().over(W.partitionBy("borough", "pos", "href").orderBy("place"))).filter("_n = 1")
    kind = F.coalesce(F.upper(F.regexp_replace("force_ext", r"^\.", "")), F.col("file_type"))
    return first.withColumn("file_type", kind).select(*links.columns, "label")


def portal_export(links: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The first link of each page whose text speaks of an export, as a CSV address."""
    low = F.lower(F.trim("raw_text"))
    found = links.filter(low.rlike("|".join(V.EXPORT_WORDS))).groupBy(*keep).agg(F.min(F.struct("pos", "href")).alias("a"))
    return found.select(*keep, F.col("a.pos").alias("pos"), F.col("a.href").alias("href"), F.lit("CSV").alias("file_type"), F.lit("main").alias("label"))


def latest_inventory(files: DataFrame) -> DataFrame:
    """The path that sorts last among the workbooks named inventory_*; null where there is none."""
    return files.filter(F.element_at(F.split("path", "/"), -1).rlike(r"^inventory_.*\.xlsx$")).agg(F.max("path").alias("path"))


# ---- orders --------------------------------------------------------------------------------------------------------


def fact_order() -> list[Column]:
    return [F.lower("borough"), F.lower("source_file")]


def supplier_order() -> list[Column]:
    return [F.col("supplier").desc()]


def context_order() -> list[Column]:
    return [F.col("total_spend").desc_nulls_last()]


def header_order() -> list[Column]:
    return [F.lower("borough"), F.col("num_columns"), F.lower(F.array_join("header", "|"))]


# ---- canonical files -----------------------------------------------------------------------------------------------


def canonical_files(listing: DataFrame) -> DataFrame:
    """listing(borough, folder, file) without originals that have a canonical copy beside them; + canonical."""
    mark = F.startswith("file", F.lit(CANONICAL))
    copies = listing.filter(mark).select("borough", "folder", F.substr("file", F.lit(len(CANONICAL) + 1)).alias("file")).distinct()
    return listing.join(copies, ["borough", "folder", "file"], "left_anti").withColumn("canonical", mark)


def header_index(files: DataFrame, rows: DataFrame, least: int = 3, within: int = 100) -> DataFrame:
    """files(borough, file, canonical) and rows(borough, file, row_idx, cells) -> header, columns and files of each header.

    The first row that is not blank is a canonical file's header; elsewhere it is found by its words. Files without one
    have a mark in its place. Blank cells at the end are no part of a header.
    """
    solid = rows.filter(F.exists("cells", lambda c: T.strip(F.coalesce(c, F.lit(""))) != ""))
    first = solid.groupBy("borough", "file").agg(F.min_by("cells", "row_idx").alias("first_row"))
    found = rows.join(header_rows(rows, least, within), ["borough", "file"]).filter(F.col("row_idx") == F.col("header_idx")).select("borough", "file", F.col("cells").alias("found_row"))
    head = F.when(F.col("canonical"), F.col("first_row")).otherwise(F.col("found_row"))
    plain = F.transform(head, lambda c: T.strip(F.coalesce(c, F.lit(""))))
    last = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(plain), F.lit(1))), F.lit(0), lambda a, i: F.when(F.coalesce(F.get(plain, i - 1), F.lit("")) != "", i).otherwise(a))
    missing = F.array(F.when(F.col("canonical"), V.HEADERLESS[True]).otherwise(V.HEADERLESS[False]))
    out = files.join(first, ["borough", "file"], "left").join(found, ["borough", "file"], "left")
    out = out.withColumn("header", F.coalesce(F.when(head.isNotNull(), F.slice(plain, F.lit(1), last)), missing))
    return out.groupBy("borough", "canonical", "header").agg(F.array_sort(F.collect_list("file")).alias("files")).withColumn("num_files", F.size("files")).withColumn("num_columns", F.size("header"))


# ---- logs and summaries --------------------------------------------------------------------------------------------


def _tenths(n: Column, unit: int) -> Column:
    """n / unit with one digit, exact ties to the even digit, from whole numbers alone."""
    div = lambda a, b: F.call_function("div", a.cast("long"), F.lit(b).cast("long"))
    whole = div(n, unit)
    rest = (n - whole * unit) * 10
    down = div(rest, unit)
    twice = (rest - down * unit) * 2
    tenth = whole * 10 + down + F.when((twice > unit) | ((twice == unit) & (down % 2 == 1)), 1).otherwise(0)
    return F.concat(div(tenth, 10).cast("string"), F.lit("."), (tenth % 10).cast("string"))


def human_size(n: Column) -> Column:
    """Bytes as 512B, 1.5KB, … up to TB; exact ties go to the even digit."""
    n = n.cast("long")
    out = F.concat(n.cast("string"), F.lit("B"))
    for i, unit in enumerate(("KB", "MB", "GB", "TB"), 1):
        out = F.when(n >= 1024**i, F.concat(_tenths(n, 1024**i), F.lit(unit))).otherwise(out)
    return F.when(n.isNotNull(), out)


def job_state(state: Column) -> Column:
    """A job's state without the names before it."""
    return F.regexp_replace(F.replace(state, F.lit("JOB_STATE_"), F.lit("")), r"JobState\.", "")


def error_log(errors: DataFrame) -> DataFrame:
    """errors(timestamp, borough, path, size, error, detail) -> log lines: name and extension apart, size as text or '?'."""
    name = F.element_at(F.split("path", "/"), -1)
    n = F.col("size")
    size = F.when(n > 1 << 20, F.concat(_tenths(n, 1 << 20), F.lit("MB"))).when(n > 1024, F.concat(_tenths(n, 1024), F.lit("KB"))).when(n.isNotNull(), F.concat(n.cast("string"), F.lit("B"))).otherwise("?")
    return errors.select("timestamp", "borough", name.alias("filename"), F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1)).alias("ext"), size.alias("size"), "error", "detail")


def error_summary(log: DataFrame) -> DataFrame:
    """Errors of each publisher by message."""
    return log.groupBy("borough", "error").agg(F.count(F.lit(1)).alias("errors"), F.countDistinct("filename").alias("files"))


def first_errors(judged: DataFrame, file: str | None = None) -> DataFrame:
    """The first row of each kind of failure in each file (or in the one given), and how many there are."""
    bad = judged.filter("fate != 'ok'")
    if file is not None:
        bad = bad.filter(F.col("file") == file)
    return bad.groupBy("borough", "file", "fate").agg(F.min("row_idx").alias("first_row"), F.count(F.lit(1)).alias("rows"))


def keymap(ids: DataFrame) -> DataFrame:
    return ids.select("supplier_id", "supplier_clean")


def named_answers(answers: DataFrame, keys: DataFrame, fields: list[str]) -> DataFrame:
    """answers(line_no, key, fields…) and keys(line_no, supplier_id, supplier_clean) -> fields by supplier.

    The last line of an id counts, on both sides; where ids share a supplier, that of the id that came first last counts.
    """
    last = answers.groupBy("key").agg(F.max_by(F.struct(*fields), "line_no").alias("a"), F.min("line_no").alias("_first"))
    ids = keys.groupBy(F.col("supplier_id").alias("key")).agg(F.max_by("supplier_clean", "line_no").alias("supplier_clean"))
    return last.join(ids, "key").filter("supplier_clean is not null").groupBy("supplier_clean").agg(F.max_by("a", "_first").alias("a")).select("supplier_clean", *[F.col(f"a.{f}").alias(f) for f in fields])


def most_collided(candidates: DataFrame, k: int = 5, top: int = 10) -> DataFrame:
    """The suppliers with most candidates of one name."""
    return homonyms_at_cap(candidates, k).orderBy(F.desc("candidates"), "supplier_clean").limit(top)


def choice_summary(answers: DataFrame) -> DataFrame:
    """answers(company_number, confidence, error): all, resolved, none, errors, and each level of confidence; one row."""
    n = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    sound = F.col("error").isNull()
    number, level = F.upper(F.trim(F.coalesce("company_number", F.lit("")))), F.upper(F.trim("confidence"))
    yes = ~number.isin("", "NONE")
    return answers.agg(F.count(F.lit(1)).alias("total"), n(sound & yes).alias("resolved"), n(sound & ~yes).alias("none"), n(~sound).alias("errors"), *[n(sound & (level == c)).alias(c.lower()) for c in ("HIGH", "MEDIUM", "LOW")])


def directory_tree(files: DataFrame, skipped: list[str] | None = None) -> DataFrame:
    """files(path from the root, size) -> lines of a tree: folder (parts), is_file, name, depth, line; in their order by
    folder, is_file and name a folder's files come before the folders in it. What lies in a ``skipped`` folder is left out."""
    parts = F.split("path", "/")
    files = files.filter(~F.arrays_overlap(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(*[F.lit(x) for x in (V.SKIPPED_FOLDERS if skipped is None else skipped)])))
    folder = F.slice(parts, F.lit(1), F.size(parts) - 1)
    inner = files.select(F.explode(F.transform(F.sequence(F.lit(0), F.size(folder)), lambda i: F.slice(folder, F.lit(1), i))).alias("folder")).distinct()
    dirs = inner.select("folder", F.lit(False).alias("is_file"), F.coalesce(F.try_element_at("folder", F.lit(-1)), F.lit(".")).alias("name"), F.size("folder").alias("depth"), F.lit(None).cast("long").alias("size"))
    leaves = files.select(folder.alias("folder"), F.lit(True).alias("is_file"), F.element_at(parts, -1).alias("name"), F.size(parts).alias("depth"), F.col("size").cast("long").alias("size"))
    label = F.when(F.col("is_file"), F.concat("name", F.lit("  ("), F.coalesce(human_size(F.col("size")), F.lit("?")), F.lit(")"))).otherwise(F.concat("name", F.lit("/")))
    return dirs.unionByName(leaves).withColumn("line", F.concat(F.repeat(F.lit("    "), F.col("depth")), label)).drop("size")
