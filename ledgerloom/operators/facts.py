"""Publisher files to one fact table: mapping, dates, amounts, rejects, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T, values as V
from ..functions.dates import date_in_filename, standard_date, year_of
from ..functions.money import clean_amount, is_number, resolve_amount
from ..plans.scratch import materialize

FALLBACK = V.HEADER_TARGETS
TARGETS = ["date", "amount", "vat", "amount_formula", "department", "expense_type", "service_area", "supplier_category", "supplier"]


def mapping_rows(sheet: DataFrame) -> DataFrame:
    """Mapping sheet (Borough, Header, Affected Files, do_not_process, and a column a target) -> (borough, header_key, file,
    skip_file, mapping): a row for each listed file; ``--``, blank and None are missing."""
    none = lambda c: F.when(F.lower(T.strip(c)) != "none", T.cell(c))
    files = lambda c: F.filter(F.transform(F.split(F.coalesce(none(F.col(c)), F.lit("")), "\n"), T.strip), lambda f: f != "")
    pairs = F.filter(F.array(*[F.struct(F.lit(t).alias("k"), none(F.col(t)).alias("v")) for t in TARGETS]), lambda p: p["v"].isNotNull())
    header = F.array_join(F.transform(F.split("Header", ","), T.column_key), "|")
    return sheet.select(F.lower(T.strip(F.col("Borough"))).alias("borough"), header.alias("header_key"), files("Affected Files").alias("files"), files("do_not_process").alias("skip_files"), F.map_from_entries(pairs).alias("mapping"))


def choose_mapping(files: DataFrame, maps: DataFrame) -> DataFrame:
    """files(borough, file, header ARRAY) + mapping and match_type: by file, else by header, else FALLBACK; files to be
    left out are dropped."""
    skip = maps.select(F.col("borough").alias("_b"), F.explode("skip_files").alias("_f"))
    kept = files.join(skip, (F.lower("borough") == F.col("_b")) & (F.col("file") == F.col("_f")), "left_anti")
    by_file = maps.select("borough", F.explode("files").alias("file"), "mapping").groupBy("borough", "file").agg(F.min_by("mapping", F.to_json("mapping")).alias("m1")).select(F.col("borough").alias("_b1"), F.col("file").alias("_f1"), "m1")
    by_head = maps.groupBy("borough", "header_key").agg(F.min_by("mapping", F.to_json("mapping")).alias("m2")).select(F.col("borough").alias("_b2"), F.col("header_key").alias("_h2"), "m2")
    out = kept.withColumn("_key", F.array_join(F.transform("header", T.column_key), "|"))
    out = out.join(by_file, (F.lower("borough") == F.col("_b1")) & (F.col("file") == F.col("_f1")), "left").join(by_head, (F.lower("borough") == F.col("_b2")) & (F.col("_key") == F.col("_h2")), "left")
    return out.withColumn("match_type", F.when(F.col("m1").isNotNull(), "FILE").when(F.col("m2").isNotNull(), "HEADER").otherwise("FALLBACK")).withColumn("mapping", F.coalesce("m1", "m2")).drop("_b1", "_f1", "_b2", "_h2", "_key", "m1", "m2")


def column_index(header: Column, mapping: Column, fallback: dict[str, str]) -> Column:
    """Map target -> position in the header. The mapping comes first (the last of equal headers wins); what it leaves open
    is looked up in the fallback dictionary (the first header wins). A formula "A - B" gives lhs and rhs and no amount."""
    keys = F.transform(header, T.column_key)
    last = lambda name: F.nullif(F.size(keys) - F.array_position(F.reverse(keys), name).cast("int"), F.size(keys))
    table = F.create_map(*[F.lit(x) for k, v in fallback.items() for x in (k, v)]) if fallback else F.lit(None).cast("map<string,string>")
    named = F.transform(keys, lambda k: F.try_element_at(table, k))
    formula = F.try_element_at(mapping, F.lit("amount_formula"))
    halves = F.when(F.contains(formula, F.lit(" - ")), F.split(formula, " - "))
    found = lambda target: F.coalesce(last(T.column_key(F.try_element_at(mapping, F.lit(target)))), F.nullif(F.array_position(named, F.lit(target)).cast("int") - 1, F.lit(-1)))
    out = {t: found(t) for t in ("date", "vat", "department", "expense_type", "service_area", "supplier_category", "supplier", "txn_id", "payment_type_col")}
    out["amount"] = F.when(halves.isNull(), found("amount"))
    out["lhs"], out["rhs"] = last(T.column_key(F.get(halves, F.lit(0)))), last(T.column_key(F.get(halves, F.lit(1))))
    out["gross"] = F.when(halves.isNull(), F.coalesce(last(T.column_key(formula)), F.nullif(F.array_position(named, F.lit("amount_formula")).cast("int") - 1, F.lit(-1))))
    return F.map_filter(F.create_map(*[x for k, v in out.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())


def map_rows(rows: DataFrame, index: Column) -> DataFrame:
    """rows(…, cells) + the target columns as text, read by position; blanks, ``--`` and short rows give null."""
    at = lambda t: T.cell(F.get("cells", F.try_element_at(index, F.lit(t))))
    names = ["date", "amount", "lhs", "rhs", "gross", "vat", "department", "expense_type", "service_area", "supplier_category", "supplier", "txn_id", "payment_type_col"]
    return rows.withColumns({f"raw_{t}": at(t) for t in names})


def header_exempt(header: Column) -> Column:
    """Is this the header under which suppliers may be blank?"""
    return F.coalesce(F.transform(header, T.strip) == F.array(*[F.lit(h) for h in V.EALING_EXEMPT_HEADER]), F.lit(False))


def judge(raw: DataFrame, year: int | None = None) -> DataFrame:
    """Rows with raw_ columns, borough, file + the 15 fact columns and ``fate``: ok, or why the row is left out.

    Dates fall back to the file name; amounts are resolved and must be numbers; suppliers must look like names. A column
    ``header`` (the file's header) tells where suppliers may be blank; it is left out of the result.
    """
    date = F.coalesce(standard_date(F.col("raw_date")), date_in_filename(F.col("file")))
    amount = clean_amount(resolve_amount(F.col("raw_amount"), F.col("raw_lhs"), F.col("raw_rhs"), F.col("raw_gross"), F.col("raw_vat")))
    supplier = T.gateway_clean(F.col("raw_supplier"))
    exempt = F.col("header_exempt") if "header_exempt" in raw.columns else header_exempt(F.col("header")) if "header" in raw.columns else F.lit(False)
    out = raw.withColumn("_date", date).withColumn("_amount", amount).withColumn("_supplier", supplier).withColumn("_year", year_of(F.col("_date")))
    fate = (
        F.when(F.col("_date").isNull() & F.col("raw_date").isNull(), "no_date").when(F.col("_date").isNull(), "bad_date")
        .when(F.lit(False) if year is None else F.col("_year") != str(year), "other_year")
        .when(F.coalesce("_amount", F.lit("")).isin("", "-", "."), "no_amount").when(~is_number(F.col("_amount")), "bad_amount")
        .when(~T.is_supplier(F.col("_supplier"), F.col("borough"), F.col("file"), F.col("_amount"), exempt), "bad_supplier").otherwise("ok")
    )
    text = lambda c: T.strip_junk(F.coalesce(F.col(f"raw_{c}"), F.lit("")))
    blank = F.lit(True)
    for c in ("department", "expense_type", "service_area", "supplier_category"):
        blank = blank & F.lower(F.coalesce(F.col(f"raw_{c}"), F.lit(""))).isin("", "nan")
    label = F.coalesce("raw_payment_type_col", T.payment_label(F.col("file")))
    return out.select(
        *[c for c in raw.columns if not c.startswith("raw_") and c != "header"], "raw_date", label.alias("payment_type"), F.col("_date").alias("date"), F.col("_year").alias("year"), F.col("_amount").alias("amount"),
        F.coalesce(clean_amount(F.col("raw_vat")), F.lit("")).alias("vat"), F.coalesce("_supplier", F.lit("")).alias("supplier"), *[text(c).alias(c) for c in ("department", "expense_type", "service_area", "supplier_category", "txn_id")],
        F.col("file").alias("source_file"), F.when(blank, "Y").otherwise("").alias("blank_taxonomy"), fate.alias("fate"),
    )


def accepted(judged: DataFrame, batch_start: str) -> DataFrame:
    return judged.filter("fate = 'ok'").withColumn("batch_start_date", F.lit(batch_start)).select(*V.FACT_COLUMNS)


def excluded(judged: DataFrame) -> DataFrame:
    return judged.filter("fate in ('bad_date', 'bad_amount', 'bad_supplier')")


def error_rates(judged: DataFrame) -> DataFrame:
    """Per file: rows kept, rows of each kind of error, and the share of errors, worst first."""
    count = lambda f: F.sum(F.when(F.col("fate") == f, 1).otherwise(0))
    per = judged.groupBy("borough", F.col("source_file").alias("file")).agg(count("ok").alias("ok"), *[count(f).alias(f) for f in ("bad_date", "bad_amount", "bad_supplier")])
    bad = F.col("bad_date") + F.col("bad_amount") + F.col("bad_supplier")
    return per.withColumn("error_rate", F.round(F.try_divide(bad.cast("double"), (bad + F.col("ok")).cast("double")), 4))


def drop_repeated_headers(rows: DataFrame, header: str = "header") -> DataFrame:
    """Without blank rows and rows that repeat the header's first cell (where that is not blank itself)."""
    solid = F.exists("cells", lambda c: T.strip(c) != "")
    first = T.strip(F.get(F.col(header), F.lit(0)))
    return rows.filter(solid & ~((first != "") & (T.strip(F.get("cells", F.lit(0))) == first)))


def build_fact(rows: DataFrame, maps: DataFrame, batch_start: str, year: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of cells as files have them (borough, file, row_idx, cells) and mapping_rows -> (accepted facts, excluded rows).

    Every file gets its header on top by its publisher's rule, its columns by mapping sheet or HEADER_TARGETS, and each
    row is judged. Headers are one row a file; rows meet them by file.
    """
    from .conform import conform, first_rows

    shaped = materialize(conform(rows).select("borough", "file", "row_idx", "cells"))
    heads = first_rows(shaped).select("borough", "file", F.col("first").alias("header"), "first_idx")
    index = column_index(F.col("header"), F.col("mapping"), V.HEADER_TARGETS)
    mapped = choose_mapping(heads, maps).withColumn("_index", index)
    body = shaped.join(mapped, ["borough", "file"]).filter(F.col("row_idx") > F.col("first_idx"))
    raw = map_rows(drop_repeated_headers(body), F.col("_index"))
    judged = materialize(judge(raw.drop("mapping", "match_type", "_index", "cells", "first_idx"), year))
    return accepted(judged, batch_start), excluded(judged)
