"""Files of any layout as rows of cells: header detection, publisher rules, schema profiles.

Rows are (borough, file, row_idx, cells); every rule is a projection or a filter with values of its file, taken by one
aggregation a file, so files of any size are never gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import text as T, values as V
from ..functions.dates import period_month
from ..plans.scratch import materialize

MARKER = r"(?i)(^|[^a-z])(" + "|".join(V.HEADER_MARKERS) + r")($|[^a-z])"


def is_header(cells: Column, least: int = 3) -> Column:
    """At least so many short non-empty cells, one of which names a date, period, amount or payment."""
    short = F.filter(cells, lambda c: (T.strip(c) != "") & (F.length(c) <= 200))
    return (F.size(short) >= least) & F.exists(cells, lambda c: c.rlike(MARKER))


def header_rows(rows: DataFrame, least: int = 3, within: int = 100, fill: dict[str, float] | None = None) -> DataFrame:
    """(borough, file, header_idx, header): the first header row of each file among its first ``within`` rows.

    fill: publishers whose header must also have that share of its cells filled."""
    share = F.try_divide(F.size(F.filter("cells", lambda c: T.strip(c) != "")).cast("double"), F.size("cells").cast("double"))
    need = F.coalesce(*[F.when(F.lower("borough") == b, F.lit(v)) for b, v in (fill or {"croydon": 0.6}).items()], F.lit(0.0))
    ok = rows.filter((F.col("row_idx") < within) & is_header(F.col("cells"), least) & (share >= need))
    return ok.groupBy("borough", "file").agg(F.min("row_idx").alias("header_idx"), F.min_by("cells", "row_idx").alias("header"))


def strip_preamble(rows: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Without rows above the header; files in which none is found stay whole."""
    h = (headers if headers is not None else header_rows(rows)).select("borough", "file", "header_idx")
    return rows.join(h, ["borough", "file"], "left").filter(F.col("row_idx") >= F.coalesce("header_idx", F.lit(0))).drop("header_idx")


def trim_cells(cells: Column) -> Column:
    """Without empty cells at the end."""
    last = F.size(cells) - F.coalesce(F.array_position(F.reverse(F.transform(cells, lambda c: T.strip(c) != "")), F.lit(True)).cast("int") - 1, F.size(cells))
    return F.slice(cells, F.lit(1), F.greatest(last, F.lit(0)))


def same_header(cells: Column, header: list[str]) -> Column:
    """Equal in length and, but for case and gaps, in text."""
    plain = F.transform(cells, lambda c: F.lower(T.strip(T.squeeze(c))))
    return plain == F.array(*[F.lit(" ".join(h.split()).lower()) for h in header])


def first_rows(rows: DataFrame) -> DataFrame:
    """(borough, file, first_idx, first): the first row of each file that is not blank."""
    solid = rows.filter(F.exists("cells", lambda c: T.strip(c) != ""))
    return solid.groupBy("borough", "file").agg(F.min("row_idx").alias("first_idx"), F.min_by("cells", "row_idx").alias("first"))


def _with_first(rows: DataFrame) -> DataFrame:
    return rows.join(first_rows(rows), ["borough", "file"])


def prepend_header(rows: DataFrame, header: list[str], when: Column | None = None) -> DataFrame:
    """With a header row above files that lack it; ``when`` on (first, first_idx) limits it to some."""
    f = first_rows(rows).filter(~same_header(F.col("first"), header))
    f = f if when is None else f.filter(when)
    top = f.select("borough", "file", F.lit(-1).cast(rows.schema["row_idx"].dataType).alias("row_idx"), F.array(*[F.lit(h) for h in header]).alias("cells"))
    return rows.select("borough", "file", "row_idx", "cells").unionByName(top)


def replace_header(rows: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    """Files whose first row is the old header (empty cells at its end do not count) get the new one."""
    hit = (F.col("row_idx") == F.col("first_idx")) & same_header(trim_cells(F.col("first")), old)
    return _with_first(rows).withColumn("cells", F.when(hit, F.array(*[F.lit(h) for h in new])).otherwise(F.col("cells"))).drop("first", "first_idx")


def fix_first_cell(rows: DataFrame, sign: str = "`", to: str = "Date", width: int = 8) -> DataFrame:
    hit = (F.col("row_idx") == F.col("first_idx")) & (F.size("first") == width) & F.contains(F.get("first", F.lit(0)), F.lit(sign))
    return _with_first(rows).withColumn("cells", F.when(hit, F.concat(F.array(F.lit(to)), F.slice("cells", 2, width))).otherwise(F.col("cells"))).drop("first", "first_idx")


def from_marker(rows: DataFrame, names: list[str]) -> DataFrame:
    """From the first row whose leading cells are names; files without it are dropped, as they do not conform."""
    lead = F.transform(F.slice("cells", 1, len(names)), lambda c: F.lower(T.strip(T.squeeze(c)))) == F.array(*[F.lit(n.lower()) for n in names])
    at = rows.filter(lead).groupBy("borough", "file").agg(F.min("row_idx").alias("_from"))
    return rows.join(at, ["borough", "file"]).filter(F.col("row_idx") >= F.col("_from")).drop("_from")


def strip_blank_column(rows: DataFrame, header: list[str]) -> DataFrame:
    """Files whose header is a blank cell and then these names lose the first column and what is above the header."""
    want = F.transform(F.slice("cells", 1, len(header) + 1), lambda c: F.lower(T.strip(c))) == F.array(F.lit(""), *[F.lit(h.lower()) for h in header])
    at = rows.filter(want).groupBy("borough", "file").agg(F.min("row_idx").alias("_at"))
    out = rows.join(at, ["borough", "file"], "left").filter(F.col("_at").isNull() | (F.col("row_idx") >= F.col("_at")))
    return out.withColumn("cells", F.when(F.col("_at").isNotNull(), F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))).otherwise(F.col("cells"))).drop("_at")


def match_variants(rows: DataFrame, variants: list[tuple[list[str], int]]) -> DataFrame:
    """Header variants (names, columns to strip from the left): the first that fits the file's first row decides; data rows
    are cut or padded to its width. Leading query blocks (a row with "select" or "query" up to a row with "columns") go first."""
    low = lambda c: F.lower(T.strip(c))
    first = rows.groupBy("borough", "file").agg(F.min("row_idx").alias("_i"), F.min_by("cells", "row_idx").alias("_c"))
    sql = first.filter(F.exists("_c", lambda c: F.contains(low(c), F.lit("select")))).select("borough", "file")
    cut = rows.join(sql, ["borough", "file"]).filter(F.exists(F.slice("cells", 1, 3), lambda c: low(c) == "columns")).groupBy("borough", "file").agg(F.min("row_idx").alias("_cut"))
    query = first.filter(F.exists("_c", lambda c: F.contains(low(c), F.lit("query")))).select("borough", "file", F.col("_i").alias("_q"))
    body = rows.join(cut, ["borough", "file"], "left").filter(F.col("_cut").isNull() | (F.col("row_idx") > F.col("_cut"))).drop("_cut")
    body = body.join(query, ["borough", "file"], "left").filter(F.col("_q").isNull() | (F.col("row_idx") > F.col("_q")))
    body = body.withColumn("cells", F.when(F.col("_q").isNotNull(), F.slice("cells", F.lit(3), F.greatest(F.size("cells") - 2, F.lit(0)))).otherwise(F.col("cells")))
    kind = F.coalesce(*[F.when(same_header(trim_cells(F.when(F.col("_q").isNotNull() | F.lit(n == 0), F.col("first")).otherwise(F.slice("first", F.lit(n + 1), F.greatest(F.size("first") - n, F.lit(0))))), h), F.lit(i)) for i, (h, n) in enumerate(variants)])
    out = _with_first(body).withColumn("_v", kind).filter("_v is not null and row_idx >= first_idx")
    widths, strips = F.array(*[F.lit(len(h)) for h, _ in variants]), F.array(*[F.lit(n) for _, n in variants])
    skip = F.when(F.col("_q").isNotNull(), 0).otherwise(F.get(strips, F.col("_v")))
    wide = F.get(widths, F.col("_v"))
    padded = F.slice(F.concat(F.slice("cells", skip + 1, F.greatest(F.size("cells") - skip, F.lit(0))), F.array_repeat(F.lit(""), wide)), F.lit(1), wide)
    return out.withColumn("cells", padded).select("borough", "file", "row_idx", "cells")


def first_duplicate(rows: DataFrame, name: str = "payment amount", to: str = "Payment Date") -> DataFrame:
    """Where the header has a name twice, its first occurrence is another column."""
    low = F.transform("first", lambda c: F.lower(T.strip(c)))
    twice = F.size(F.filter(low, lambda c: c == name)) >= 2
    at = F.array_position(low, F.lit(name)).cast("int") - 1
    hit = (F.col("row_idx") == F.col("first_idx")) & twice
    return _with_first(rows).withColumn("cells", F.when(hit, F.transform("cells", lambda c, i: F.when(i == at, F.lit(to)).otherwise(c))).otherwise(F.col("cells"))).drop("first", "first_idx")


def periods_to_dates(rows: DataFrame, column: str = "period") -> DataFrame:
    """In files with such a column, YYYYMM becomes the first of the month."""
    at = F.array_position(F.transform("first", lambda c: F.lower(T.strip(c))), F.lit(column)).cast("int") - 1
    hit = (F.col("row_idx") > F.col("first_idx")) & (at >= 0)
    return _with_first(rows).withColumn("cells", F.when(hit, F.transform("cells", lambda c, i: F.when(i == at, period_month(c)).otherwise(c))).otherwise(F.col("cells"))).drop("first", "first_idx")


def split_tabs(rows: DataFrame) -> DataFrame:
    """Rows with all text in one cell, tabs between fields."""
    single = ~F.exists(F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0))), lambda c: T.strip(c) != "")
    return rows.withColumn("cells", F.when(single, F.transform(F.split(F.get("cells", F.lit(0)), "\t"), T.strip)).otherwise(F.col("cells")))


def infer_columns(rows: DataFrame, evidence: dict[str, str], fields: list[str], sample: int = 200) -> DataFrame:
    """(borough, file, names): an order of fields for files without a header, by what their cells look like.

    evidence: pattern of each field, most telling first. A field takes the free column with most matching cells among
    the first rows; fields without evidence take what is left, in order. One row a file and column meets in the end.
    """
    head = rows.filter(F.exists("cells", lambda c: T.strip(c) != "")).withColumn("_n", F.row_number().over(W.partitionBy("borough", "file").orderBy("row_idx"))).filter(F.col("_n") <= sample)
    long = head.select("borough", "file", F.posexplode("cells").alias("col", "value")).filter(F.col("col") < len(fields))
    score = long.groupBy("borough", "file", "col").agg(*[F.sum(F.when(T.strip(F.col("value")).rlike(p), 1).otherwise(0)).alias(f"s{i}") for i, p in enumerate(evidence.values())])
    per = score.groupBy("borough", "file").agg(F.array_sort(F.collect_list(F.struct("col", F.array(*[F.col(f"s{i}") for i in range(len(evidence))]).alias("s")))).alias("cols"))
    got = F.array_repeat(F.lit(None).cast("string"), len(fields))

    def taking(got: Column, i: int, field: str) -> Column:
        left = F.filter("cols", lambda c: F.get(got, c["col"]).isNull() & (c["s"][i] > 0))
        best = F.array_min(F.transform(left, lambda c: F.struct((-c["s"][i]).alias("k"), c["col"].alias("col"))))["col"]
        return F.transform(got, lambda g, j: F.when(j == best, F.lit(field)).otherwise(g))

    for i, field in enumerate(evidence):
        per = per.withColumn("_got", taking(F.col("_got") if i else got, i, field))
    rest = F.filter(F.array(*[F.lit(f) for f in fields]), lambda f: ~F.array_contains(F.filter("_got", lambda g: g.isNotNull()), f))
    per = per.withColumn("_rest", rest)
    free = lambda j: F.size(F.filter(F.slice("_got", F.lit(1), j), lambda g: g.isNull()))
    return per.select("borough", "file", F.transform("_got", lambda g, j: F.coalesce(g, F.get("_rest", free(j)))).alias("names"))


def clean_cells(rows: DataFrame) -> DataFrame:
    """ASCII signs in all cells, title case in headers."""
    c = F.transform("cells", T.plain_cell)
    return _with_first(rows).withColumn("cells", F.when(F.col("row_idx") == F.col("first_idx"), F.transform(c, T.title_header)).otherwise(c)).drop("first", "first_idx")


# --- fixed values -------------------------------------------------------------------------------------------------
_BODY = ["Body Name", "Organisation Code", "Service Label", "Service Code", "Organisation Unit", "Expenditure Category", "Expenditure Code", "Narrative", "Date", "Transaction No", "Net Amount", "Supplier ID"]
EALING = [
    ([*_BODY, "Amended Supplier Name"], 0), ([*_BODY, "Relation", "Amended Supplier Name", "Cost Centre"], 2), ([*_BODY, "Supplier Name", "Relation", "Amended Supplier Name", "Cost Centre"], 2),
    ([*_BODY, "Supplier Name"], 2), ([*_BODY, "Amended Supplier Name"], 2), ([*_BODY, "Name"], 2),
]
SOUTHWARK = ["date", "department", "beneficiary", "amount", "summary of purpose", "category", "Transaction number", "SAP vendor number"]
GREENWICH = ["Creditor_Name", "Invoice Line Amount", "Payment_Date", "Expenditure Category/Description", "LA Department"]
SUTTON_OLD, SUTTON_NEW = ["Account (T)", "Cat1 (T)", "Amount", "Text"], ["Account", "Cat1", "Amount", "Date", "Supplier", "narrative"]
HOUNSLOW = ["OrganisationalUnit", "ServiceCategoryLabel", "BeneficiaryName", "SupplierID", "PaymentDate", "TransactionNumber", "Amount", "IrrecoverableVATAmount", "Purpose", "CategoryInternalName"]
MERTON = ["Directorate", "Supplier Name", "Supplier Invoice No", "Payment Date", "Gross Invoice Value", "Vat Amount", "Vendor Id", "Purpose Of Expenditure", "Description", "Redact Flag", "Year", "Period"]
TOWER_HAMLETS = ["Directorate", "Service", "Division", "Responsible Unit", "Expense Type", "Payment Date", "Trans No", "Net Amount", "Supplier Name"]
TOWER_EVIDENCE = {
    "TRANS DATE": r"\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|\d{4}[/\-]\d{1,2}[/\-]\d{1,2}", "TRANS ORIGINAL NET AMT": r"^[+-]?[\d,]*\.?\d+$", "DIRECTORATE": r"(?i)RESOURCES|CHILDRENS.SERVICES",
    "MERCHANT NAME": r"(?i)AMAZON", "TRANS CAC DESC 1": r"(?i)COMMUNITY.EQUIP", "TRANS CAC DESC 2": r"(?i)EARLY.HELP",
}
TOWER_FIELDS = ["DIRECTORATE", "TRANS DATE", "TRANS ORIGINAL NET AMT", "MERCHANT NAME", "TRANS CAC DESC 1", "TRANS CAC DESC 2"]
# --- end of fixed values ------------------------------------------------------------------------------------------


def tower_hamlets(rows: DataFrame) -> DataFrame:
    """By the number of filled columns in rows 5 and 10 (else in the first row): 5 or 6 have their order inferred, 9 get the
    header, 18 are cut to 9; other files are dropped, as they do not conform."""
    n = F.size(trim_cells(F.col("cells")))
    probe = rows.filter(F.col("row_idx").isin(5, 10)).groupBy("borough", "file").agg(F.max(n).alias("_probe"))
    width = first_rows(rows).select("borough", "file", F.size("first").alias("_w")).join(probe, ["borough", "file"], "left")
    width = width.withColumn("_n", F.when(F.col("_w").isin(5, 6, 18), F.col("_w")).when(F.col("_probe").isin(5, 6), F.col("_probe")).otherwise(F.col("_w"))).filter(F.col("_n").isin(5, 6, 9, 18)).select("borough", "file", "_n")
    cut = F.when(F.col("_n") == 18, 9).otherwise(F.col("_n"))
    body = rows.join(width, ["borough", "file"]).withColumn("cells", F.slice("cells", F.lit(1), cut))
    parts = []
    for k in (5, 6):
        fields = TOWER_FIELDS[6 - k :]
        mine = body.filter(F.col("_n") == k).drop("_n")
        names = infer_columns(mine, {f: p for f, p in TOWER_EVIDENCE.items() if f in fields}, fields)
        low = lambda c: F.transform(c, lambda x: F.lower(T.strip(x)))
        lacking = first_rows(mine).join(names, ["borough", "file"]).filter(low(F.col("first")) != low(F.col("names")))
        parts += [mine.select("borough", "file", "row_idx", "cells"), lacking.select("borough", "file", F.lit(-1).cast(rows.schema["row_idx"].dataType).alias("row_idx"), F.col("names").alias("cells"))]
    parts.append(prepend_header(body.filter(F.col("_n").isin(9, 18)).drop("_n"), TOWER_HAMLETS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Rule of each publisher, after the preamble is gone.
PUBLISHER_RULES = {
    "tower hamlets": tower_hamlets,
    "southwark": lambda r: prepend_header(fix_first_cell(r), SOUTHWARK, (F.size("first") == 8) & ~F.contains(F.lower(F.get("first", F.lit(0))), F.lit("date"))),
    "greenwich": lambda r: prepend_header(r, GREENWICH, F.size("first") == 5),
    "ealing": lambda r: match_variants(r, EALING),
    "croydon": lambda r: from_marker(r, ["Payment Date", "Vendor Name"]),
    "sutton": lambda r: replace_header(r, SUTTON_OLD, SUTTON_NEW),
    "hounslow": lambda r: strip_blank_column(r, HOUNSLOW),
    "merton": lambda r: strip_blank_column(r, MERTON),
    "redbridge": periods_to_dates,
    "wandsworth": first_duplicate,
}


def known_header(rows: DataFrame, header: list[str]) -> DataFrame:
    """Files from the row on that starts with this header (blank cells left out); where none does, it is put on top."""
    cells = F.slice(trim_solid(F.col("cells")), 1, len(header))
    at = rows.filter(same_header(cells, header)).groupBy("borough", "file").agg(F.min("row_idx").alias("_at"))
    found = rows.join(at, ["borough", "file"], "left")
    top = found.filter("_at is null").select("borough", "file").distinct()
    added = top.select("borough", "file", F.lit(-1).cast(rows.schema["row_idx"].dataType).alias("row_idx"), F.array(*[F.lit(h) for h in header]).alias("cells"))
    return found.filter("_at is null or row_idx >= _at").select("borough", "file", "row_idx", "cells").unionByName(added)


def trim_solid(cells: Column) -> Column:
    return F.filter(cells, lambda c: T.strip(c) != "")


def from_first(rows: DataFrame) -> DataFrame:
    """Files from their first row with text on, which is their header."""
    return _with_first(rows).filter("row_idx >= first_idx").select("borough", "file", "row_idx", "cells")


def tab_card(rows: DataFrame) -> DataFrame:
    """Files whose fields are in one cell with tabs between; the header is put on top where it is not the first row."""
    split = split_tabs(rows).select("borough", "file", "row_idx", "cells")
    lacking = first_rows(split).filter(~same_header(trim_cells(F.col("first")), V.TAB_CARD_HEADER))
    added = lacking.select("borough", "file", F.lit(-1).cast(rows.schema["row_idx"].dataType).alias("row_idx"), F.array(*[F.lit(h) for h in V.TAB_CARD_HEADER]).alias("cells"))
    return split.unionByName(added)


#: Files that no publisher's rule fits: publisher, lower-case names, rule on the file as it is.
FILE_RULES = [
    *[("ealing", V.CARD_FILES, lambda r: known_header(r, V.CARD_HEADER)), ("ealing", V.CARD_FILES_2024, lambda r: known_header(r, V.CARD_HEADER_2024))],
    *[(b, [f for c, f in V.AS_IS_FILES if c == b], from_first) for b in ("greenwich", "southwark")],
    ("tower hamlets", V.TAB_FILES, tab_card),
]


def conform(rows: DataFrame) -> DataFrame:
    """Every file with its header on top: a rule for the file itself, else the publisher's rule on what the preamble strip
    leaves, else that result. Files that a rule cannot place (it returns none of their rows) fall back to the stripped rows."""
    rows = materialize(rows.select("borough", "file", "row_idx", "cells"))
    publisher, file = F.lower(T.strip(F.translate("borough", "_", " "))), F.lower("file")
    special, apart = F.lit(False), []
    for name, files, rule in FILE_RULES:
        here = (publisher == name) & file.isin(files)
        special = special | F.coalesce(here, F.lit(False))
        apart.append(rule(rows.filter(here)).select("borough", "file", "row_idx", "cells").withColumn("status", F.lit("file")))
    out = reduce(lambda a, b: a.unionByName(b), [_conform(rows.filter(~special)), *apart])
    return out.filter(F.col("cells").isNotNull())


def _conform(rows: DataFrame) -> DataFrame:
    stripped = materialize(strip_preamble(rows).select("borough", "file", "row_idx", "cells"))
    named = F.lower(T.strip(F.translate("borough", "_", " ")))
    out = stripped.filter(~F.coalesce(named.isin(list(PUBLISHER_RULES)), F.lit(False))).withColumn("status", F.lit("generic"))
    present = {r[0] for r in stripped.select(named.alias("b")).distinct().filter(F.col("b").isin(list(PUBLISHER_RULES))).collect()}  # of the rules' number
    for name in sorted(present):
        rule = PUBLISHER_RULES[name]
        mine = stripped.filter(named == name)
        done = rule(mine).select("borough", "file", "row_idx", "cells")
        lost = mine.join(done.select("borough", "file").distinct(), ["borough", "file"], "left_anti")
        out = out.unionByName(done.withColumn("status", F.lit("rule"))).unionByName(lost.withColumn("status", F.lit("fallback")))
    return out


# ---- schema profiles -----------------------------------------------------------------------------------------------

KEYWORDS = {"date": ["date", "period", "month", "year"], "amount": ["amount", "net", "gross", "value", "total", "spend", "sum"], "category": ["category", "type", "purpose", "description", "department", "directorate", "service"], "supplier": ["supplier", "vendor", "merchant", "beneficiary", "payee", "creditor"], "txn_id": ["transaction n", "trans no", "reference", "invoice n", "payment n"]}


def candidates(header: Column, kind: str) -> Column:
    """Header names that may hold this kind of value; codes are no categories."""
    plain = lambda h: F.replace(F.lower(h), F.lit("_"), F.lit(" "))
    hit = lambda h: F.exists(F.array(*[F.lit(k) for k in KEYWORDS[kind]]), lambda k: F.contains(plain(h), k))
    return F.filter(header, lambda h: hit(h) & (~plain(h).rlike(r"\bcode$") if kind == "category" else F.lit(True)))


def scan_schemas(headers: DataFrame) -> DataFrame:
    """headers(borough, file, header) -> a row for each header of a publisher and label: files, columns, candidates."""
    trimmed = headers.withColumn("header", trim_cells(F.col("header"))).withColumn("label", T.payment_label(F.col("file")))
    out = trimmed.groupBy("borough", "label", "header").agg(F.count(F.lit(1)).alias("file_count"), F.min("file").alias("example_file"), F.array_join(F.array_sort(F.collect_set("file")), "\n").alias("files"))
    return out.withColumn("column_count", F.size("header")).withColumns({f"{k}_candidates": F.array_join(candidates(F.col("header"), k), ", ") for k in KEYWORDS})


def value_distribution(rows: DataFrame, fields: dict[str, int]) -> DataFrame:
    """Counts of the values of some columns, a row for each field and value; blanks as (blank)."""
    pick = F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(T.blank_to_null(F.get("cells", F.lit(i))), F.lit("(blank)")).alias("value")) for f, i in fields.items()])
    return rows.select("borough", F.explode(pick).alias("x")).select("borough", "x.*").groupBy("borough", "field", "value").agg(F.count(F.lit(1)).alias("n"))


PLACE = ["borough", "district", "file"]


def schema_groups(headers: DataFrame, rows: DataFrame, examples: int = 10) -> DataFrame:
    """headers(borough, district, file, header) and rows(.., row_idx, cells) of data -> a row for each publisher, district,
    header and label: its files, and the first rows of the first file that has any. Files without a header are left out.

    The first rows of a file are told before rows are exchanged by file, so a file of any size sends a few from each task."""
    first = W.partitionBy(*PLACE).orderBy("row_idx", "cells")
    top = rows.select(*PLACE, "row_idx", "cells").withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= examples)
    tops = top.groupBy(*PLACE).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "cells"))), lambda x: x["cells"]).alias("examples"))
    files = _with_label(headers).join(tops, PLACE, "left")
    pick = F.min_by(F.struct("file", "examples"), F.struct(F.col("examples").isNull(), F.col("file")))
    out = files.groupBy("borough", "district", "label", "header").agg(F.count(F.lit(1)).alias("file_count"), F.array_sort(F.collect_list("file")).alias("files"), pick.alias("_x"))
    out = out.withColumns({"column_count": F.size("header"), "example_file": F.col("_x.file"), "examples": F.coalesce("_x.examples", F.array().cast("array<array<string>>"))}).drop("_x")
    return out.withColumns({f"{k}_candidates": candidates(F.col("header"), k) for k in KEYWORDS})


def category_values(headers: DataFrame, rows: DataFrame) -> DataFrame:
    """Values and their counts in each column that may hold a category, by publisher, district, label and header. A name that
    stands twice in a header is read at its first place; rows too short for it do not count, blanks count as (blank).

    Headers, a row for each file, are written once, so that their size is known where they meet the rows; cells are counted by file and place
    as they are, and only the different ones are cleaned and get their header."""
    plain = lambda h: F.lower(T.strip(h))
    at = F.transform(candidates(F.col("header"), "category"), lambda c: F.struct(c.alias("column"), (F.array_position(F.transform("header", plain), plain(c)) - 1).cast("int").alias("at")))
    wanted = materialize(_with_label(headers).select("*", F.explode(at).alias("_c")).select(*PLACE, "label", "header", "_c.column", "_c.at"))
    places = wanted.groupBy(*PLACE).agg(F.collect_set("at").alias("_at"))
    met = rows.select(*PLACE, "cells").join(places, PLACE).select(*PLACE, "cells", F.explode("_at").alias("at")).filter(F.size("cells") > F.col("at"))
    counts = met.groupBy(*PLACE, "at", F.get("cells", F.col("at")).alias("cell")).agg(F.count(F.lit(1)).alias("_n"))
    value = F.coalesce(T.blank_to_null(F.col("cell")), F.lit("(blank)"))
    return counts.join(wanted, [*PLACE, "at"]).groupBy("borough", "district", "label", "header", "column", value.alias("value")).agg(F.sum("_n").alias("n"))


def _with_label(headers: DataFrame) -> DataFrame:
    return headers.select(*PLACE, trim_cells(F.col("header")).alias("header"), T.payment_label(F.col("file")).alias("label")).filter(F.size("header") > 0)
