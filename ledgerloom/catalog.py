"""Registered queries of the engine, each with the SQL that says what it returns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import dates as D, money as M, text as T, values as V
from .operators import classify as C, conform as O, coverage as L, diagnostics as G, facts as A, matching as R, pairs as B, reports as P, requests as Q, retrieval as I, suppliers as S, taxonomy as X
from .plans.scratch import materialize, scratch_dir
from .plans.substrate import BASE, CODED, COMPANIES, MESSY, NAMES, SPEND, select, views
from .sources import delimited, snapshots
from .streaming import jobs as J

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def register(sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        _queries[fn.__name__] = fn
        if sql:
            _sql[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def spend(spark: SparkSession, d: str) -> DataFrame:
    return select(spark, d, "spend", SPEND)


KEYS = ", ".join(V.KEY_COLUMNS)


@register(f"""WITH {SPEND}, {BASE} SELECT 'RQ_' || row_number() OVER (ORDER BY total_amount DESC NULLS LAST, {", ".join(f"{k} NULLS LAST" for k in V.KEY_COLUMNS)}) AS rq_id, * FROM base""")
def taxonomy_base(spark, d):
    return X.taxonomy_base(spend(spark, d))


def base(spark, d):
    return select(spark, d, "base", SPEND, BASE)


_scope = f"CASE WHEN regexp_matches(lower(supplier_clean), '{V.STATUTORY_PAYEE}') THEN 'STATUTORY_TRANSFER' WHEN regexp_matches(lower(coalesce(expense_type, '')), '{V.LEDGER_TERM}') THEN 'LEDGER_CONTROL' ELSE 'IN_SCOPE' END"
_flow = f"CASE WHEN total_amount >= 0 THEN 'SPEND' WHEN procurement_scope <> 'IN_SCOPE' THEN 'ACCOUNTING_REVERSAL' WHEN regexp_matches(lower(coalesce(expense_type, '')), '{V.INCOME_TERM}') THEN 'INCOME' ELSE 'REFUND' END"


@register(f"WITH {SPEND}, {BASE}, s AS (SELECT *, {_scope} AS procurement_scope FROM base) SELECT {KEYS}, total_amount, procurement_scope, {_flow} AS flow_type_taxonomy_key_aggregate FROM s")
def scope_flow(spark, d):
    return X.flag_scope_flow(base(spark, d)).select(*V.KEY_COLUMNS, "total_amount", "procurement_scope", "flow_type_taxonomy_key_aggregate")


@register(f"WITH {SPEND}, {BASE}, s AS (SELECT *, {_scope} AS procurement_scope FROM base), f AS (SELECT *, {_flow} AS flow FROM s) SELECT procurement_scope, flow, count(*) AS keys, CAST(sum(CAST(total_amount AS DECIMAL(28,2))) AS DOUBLE) AS amount FROM f GROUP BY procurement_scope, flow")
def scope_flow_summary(spark, d):
    flagged = X.flag_scope_flow(base(spark, d)).withColumnRenamed("flow_type_taxonomy_key_aggregate", "flow")
    return flagged.groupBy("procurement_scope", "flow").agg(F.count(F.lit(1)).alias("keys"), F.sum(F.col("total_amount").cast("decimal(28,2)")).cast("double").alias("amount"))


#: Keys whose terms decide with their level alone, or do not.
LEVELLED = """levelled AS (SELECT supplier_clean, service_area, total_amount, CASE length(service_area) % 5 WHEN 0 THEN 'Pension ' || expense_type WHEN 1 THEN 'Concessionary precept' WHEN 2 THEN 'Freedom Pass Council tax' ELSE expense_type END AS expense_type,
  CASE length(coalesce(expense_type, '')) % 3 WHEN 0 THEN 'Financial Services' WHEN 1 THEN 'Passenger Transport' END AS "Level 1" FROM base)"""
_low = "lower(coalesce(expense_type, ''))"


@register(f"""WITH {SPEND}, {BASE}, {LEVELLED}, s AS (SELECT *, CASE WHEN (regexp_matches(lower(supplier_clean), '{V.STATUTORY_PAYEE}') OR (regexp_matches({_low}, '{V.STATUTORY_TERM}') AND coalesce("Level 1", '') = 'Financial Services')) AND NOT (regexp_matches({_low}, '{V.CONCESSION_TERM}') AND coalesce("Level 1", '') = 'Passenger Transport') THEN 'STATUTORY_TRANSFER'
  WHEN regexp_matches({_low}, '{V.LEDGER_TERM}') THEN 'LEDGER_CONTROL' ELSE 'IN_SCOPE' END AS procurement_scope FROM levelled)
 SELECT supplier_clean, expense_type, "Level 1" AS level_1, procurement_scope, {_flow} AS flow, count(*) AS keys FROM s GROUP BY ALL""")
def scope_flow_levels(spark, d):
    """Scope and flow where Level 1 is known: terms that need it, and concessions that it exempts."""
    flagged = X.flag_scope_flow(select(spark, d, "levelled", SPEND, BASE, LEVELLED))
    return flagged.groupBy("supplier_clean", "expense_type", F.col("Level 1").alias("level_1"), "procurement_scope", F.col("flow_type_taxonomy_key_aggregate").alias("flow")).agg(F.count(F.lit(1)).alias("keys"))


def coded(spark, d):
    return select(spark, d, "coded", SPEND, BASE, CODED)


@register(f"""WITH {SPEND}, {BASE}, {CODED} SELECT {KEYS}, taxonomy_code,
  regexp_matches(lower(coalesce(expense_type, '')), '{V.ACCOMMODATION_TERM}') AND coalesce("Level 1", '') <> 'Housing Management' AS anchor_accommodation,
  regexp_matches(lower(coalesce(expense_type, '')), '{V.ACQUISITION_TERM}') AND coalesce("Level 1", '') IN ('Consultancy', 'Financial Services') AS anchor_acquisition, taxonomy_code % 100 = 99 AS is_nec FROM coded""")
def anchors_and_nec(spark, d):
    return X.anchors(coded(spark, d)).select(*V.KEY_COLUMNS, "taxonomy_code", "anchor_accommodation", "anchor_acquisition", X.is_nec(F.col("taxonomy_code")).alias("is_nec"))


PINS = [("hmrc", 250000), ("supplier#0+1$", 101004), ("0{4,}2$", 105020)]
_pins = "pins(pin_pattern, pin_code) AS (VALUES " + ", ".join(f"('{p}', {c})" for p, c in PINS) + ")"


def pins(spark):
    return spark.createDataFrame(PINS, "pin_pattern string, pin_code long")


@register(f"WITH {SPEND}, {BASE}, {CODED}, {_pins} SELECT {KEYS}, taxonomy_code, pin_pattern, CAST(pin_code AS BIGINT) AS pin_code FROM coded JOIN pins ON regexp_matches(lower(supplier_clean), pin_pattern) AND taxonomy_code <> pin_code")
def vendor_pin_hits(spark, d):
    return X.pin_hits(coded(spark, d), pins(spark)).select(*V.KEY_COLUMNS, "taxonomy_code", "pin_pattern", "pin_code")


@register(f"""WITH {SPEND}, {BASE}, {CODED}, {_pins}, h AS (SELECT * FROM coded JOIN pins ON regexp_matches(lower(supplier_clean), pin_pattern)),
 l AS (SELECT pin_pattern, coalesce("Level 1", '?') AS l1, count(*) AS n FROM h GROUP BY ALL), sp AS (SELECT pin_pattern, string_agg(l1 || ':' || n, '; ' ORDER BY n DESC, l1) AS level1_spread FROM l GROUP BY 1),
 s AS (SELECT pin_pattern, count(*) AS n, sum(CAST(total_amount AS DECIMAL(28,2))) AS amount, count(*) FILTER (WHERE taxonomy_code = pin_code) AS onn FROM h GROUP BY 1)
 SELECT p.pin_pattern, CAST(p.pin_code AS BIGINT) AS pin_code, coalesce(n, 0) AS rows, coalesce(CAST(amount AS DOUBLE), 0.0) AS total_amount, coalesce(onn, 0) AS already_on_target, round(onn / n, 3) AS concentration,
 coalesce(level1_spread, '') AS level1_spread, CASE WHEN onn / n < 0.5 THEN 'DIVERSE VENDOR — review before apply' ELSE '' END AS warning FROM pins p LEFT JOIN s USING (pin_pattern) LEFT JOIN sp USING (pin_pattern)""")
def vendor_pin_summary(spark, d):
    return X.pin_summary(coded(spark, d), pins(spark))


@register(f"""WITH {SPEND}, {BASE}, {CODED}, k AS (SELECT * FROM coded WHERE supplier_clean IS NOT NULL AND NOT regexp_matches(supplier_clean, '{V.REDACTED_SUPPLIER.replace(chr(92), chr(92))}')),
 t AS (SELECT supplier_clean, count(*) AS n, count(DISTINCT "Level 1") AS kinds FROM k GROUP BY 1),
 l AS (SELECT supplier_clean, "Level 1" AS l1, count(*) AS n, row_number() OVER (PARTITION BY supplier_clean ORDER BY count(*) DESC, "Level 1") AS r FROM k WHERE "Level 1" IS NOT NULL GROUP BY 1, 2),
 m AS (SELECT l.supplier_clean, l.l1 FROM l JOIN t USING (supplier_clean) WHERE r = 1 AND kinds >= 2 AND l.n >= 0.6 * t.n),
 c AS (SELECT k.supplier_clean, taxonomy_code, row_number() OVER (PARTITION BY k.supplier_clean ORDER BY count(*) DESC, taxonomy_code) AS r FROM k JOIN m ON k.supplier_clean = m.supplier_clean AND k."Level 1" = m.l1 GROUP BY 1, 2)
 SELECT {", ".join("k." + x for x in V.KEY_COLUMNS)}, k.taxonomy_code, m.l1 AS consensus_l1, c.taxonomy_code AS consensus_code, CASE WHEN k."Level 1" IN ('Consultancy', 'Financial Services') THEN 'CATCHALL' ELSE 'REVIEW' END AS kind
 FROM k JOIN m USING (supplier_clean) JOIN c ON c.supplier_clean = k.supplier_clean AND c.r = 1 WHERE k."Level 1" IS DISTINCT FROM m.l1""")
def supplier_consensus(spark, d):
    return X.consensus(coded(spark, d)).select(*V.KEY_COLUMNS, "taxonomy_code", "consensus_l1", "consensus_code", "kind")


TAXONOMY = "taxonomy AS (SELECT DISTINCT CAST(100000 + 1000 * (p_partkey % 40) + 20 + p_partkey % 7 AS BIGINT) AS code, 'L' || CAST(p_partkey % 40 AS VARCHAR(3)) AS level_1 FROM part UNION ALL SELECT 139999, 'NEC 1' UNION ALL SELECT 125999, 'NEC 2' UNION ALL SELECT 199999, 'NEC 3')"
ANSWERS = "answers AS (SELECT 'RQ_' || CAST(p_partkey AS VARCHAR(10)) AS rq_id, CAST(100000 + 1000 * (p_partkey % 41) + p_size AS BIGINT) AS taxonomy_code, CASE WHEN p_size % 2 = 0 THEN 'CONFIDENT' ELSE 'AMBIGUOUS' END AS resolution_status FROM part)"


@register(f"""WITH {TAXONOMY}, {ANSWERS}, v AS (SELECT DISTINCT code FROM taxonomy), c AS (SELECT a.*, p.n, CASE WHEN p.n = 6 THEN taxonomy_code ELSE CAST(rpad(substr(CAST(taxonomy_code AS VARCHAR), 1, p.n), 6, '9') AS BIGINT) END AS want FROM answers a, (VALUES (6), (4), (3), (2), (1)) p(n)),
 f AS (SELECT rq_id, arg_max(want, n) AS found, max(n) AS n FROM c JOIN v ON want = code GROUP BY 1)
 SELECT a.rq_id, coalesce(found, a.taxonomy_code) AS taxonomy_code, CASE WHEN f.n < 6 THEN 'NEC_FALLBACK' ELSE resolution_status END AS resolution_status FROM answers a LEFT JOIN f USING (rq_id)""")
def nec_fallback(spark, d):
    return X.nec_fallback(select(spark, d, "answers", ANSWERS), select(spark, d, "taxonomy", TAXONOMY))


RANKED = f"ranked AS (SELECT 'RQ_' || CAST(row_number() OVER (ORDER BY total_amount DESC, {KEYS}) AS VARCHAR(12)) AS rq_id, b.* FROM base b)"


@register(f"""WITH {TAXONOMY}, {ANSWERS}, v AS (SELECT DISTINCT code FROM taxonomy), c AS (SELECT a.*, p.n, CASE WHEN p.n = 6 THEN taxonomy_code ELSE CAST(rpad(substr(CAST(taxonomy_code AS VARCHAR), 1, p.n), 6, '9') AS BIGINT) END AS want FROM answers a, (VALUES (6), (4), (3), (2), (1)) p(n)),
 f AS (SELECT rq_id, arg_max(want, n) AS found FROM c JOIN v ON want = code GROUP BY 1), r AS (SELECT a.rq_id, coalesce(found, a.taxonomy_code) AS taxonomy_code FROM answers a LEFT JOIN f USING (rq_id)),
 {SPEND}, {BASE}, {RANKED} SELECT b.rq_id, total_amount, r.taxonomy_code, t.level_1 FROM ranked b LEFT JOIN r USING (rq_id) LEFT JOIN taxonomy t ON r.taxonomy_code = t.code""")
def merge_results(spark, d):
    b = X.taxonomy_base(spend(spark, d))
    return X.merge_results(b, select(spark, d, "answers", ANSWERS), select(spark, d, "taxonomy", TAXONOMY)).select("rq_id", "total_amount", "taxonomy_code", "level_1")


@register(f"""WITH {SPEND}, {BASE}, {CODED} SELECT s.orderkey, s.linenumber, s.{", s.".join(V.KEY_COLUMNS)}, c.taxonomy_code, c."Level 1" AS level_1 FROM spend s LEFT JOIN coded c ON {" AND ".join(f"s.{k} IS NOT DISTINCT FROM c.{k}" for k in V.KEY_COLUMNS)}""")
def enrich_fact(spark, d):
    return X.enrich_fact(spend(spark, d), coded(spark, d)).select("orderkey", "linenumber", *V.KEY_COLUMNS, "taxonomy_code", F.col("Level 1").alias("level_1"))


FRESH = "fresh AS (SELECT borough, orderkey, linenumber, CAST(amount * 2 AS DECIMAL(18,2)) AS amount FROM spend WHERE borough IN ('NATION_6', 'NATION_18') AND amount > 20000)"


@register(f"WITH {SPEND}, {FRESH} SELECT borough, orderkey, linenumber, CAST(amount AS DOUBLE) AS amount FROM spend WHERE borough NOT IN (SELECT borough FROM fresh) UNION ALL SELECT borough, orderkey, linenumber, CAST(amount AS DOUBLE) FROM fresh")
def incremental_replace(spark, d):
    out = X.incremental_replace(spend(spark, d).select("borough", "orderkey", "linenumber", "amount"), select(spark, d, "fresh", SPEND, FRESH))
    return out.withColumn("amount", F.col("amount").cast("double"))


@register()
def snapshot_replace(spark, d):
    """The same replacement through a stored table of snapshots, read back."""
    root = f"{scratch_dir(spark)}/spend-{uuid.uuid4().hex}"
    files = lambda df: df.select("borough", "orderkey", "linenumber", F.col("amount").cast("double").alias("amount"), F.concat(F.lit("f"), F.col("orderkey") % 4, F.lit(".csv")).alias("source_file"))
    before, fresh = files(spend(spark, d)), files(select(spark, d, "fresh", SPEND, FRESH))
    snapshots.publish(before, root)
    snapshots.publish(fresh, root)
    return snapshots.read(spark, root, before.schema)


@register(f"""WITH {SPEND}, {FRESH}, a AS (SELECT borough FROM spend WHERE borough NOT IN (SELECT borough FROM fresh) UNION ALL SELECT borough FROM fresh), x AS (SELECT borough, count(*) AS n FROM spend GROUP BY 1), y AS (SELECT borough, count(*) AS n FROM a GROUP BY 1)
 SELECT borough, coalesce(x.n, 0) AS n_before, coalesce(y.n, 0) AS n_after, coalesce(y.n, 0) - coalesce(x.n, 0) AS diff, CASE WHEN borough IN (SELECT borough FROM fresh) THEN 'REPLACED' WHEN x.n = y.n THEN 'PASS' ELSE 'FAIL' END AS status FROM x FULL JOIN y USING (borough)""")
def reconcile(spark, d):
    before, fresh = spend(spark, d).select("borough", "orderkey", "linenumber", "amount"), select(spark, d, "fresh", SPEND, FRESH)
    return X.reconcile(before, X.incremental_replace(before, fresh), fresh)


@register(f"""WITH {SPEND}, s AS (SELECT supplier_clean, sum(amount) AS total FROM spend GROUP BY 1) SELECT supplier_clean, CAST(total AS DOUBLE) AS total, round(CAST(sum(total) OVER (ORDER BY total DESC, supplier_clean ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE), 6) AS cum_amount_pct FROM s""")
def cumulative_share(spark, d):
    s = spend(spark, d).groupBy("supplier_clean").agg(F.sum("amount").alias("total"))
    return X.running_share(s, "total", [F.desc("total"), F.asc("supplier_clean")]).select("supplier_clean", F.col("total").cast("double").alias("total"), F.round("cum_amount_pct", 6).alias("cum_amount_pct"))


# ---- facts ---------------------------------------------------------------------------------------------------------


def judged(spark, d):
    raw = select(spark, d, "messy", MESSY)
    more = {c: F.lit(None).cast("string") for c in ("raw_lhs", "raw_rhs", "raw_gross", "raw_vat", "raw_department", "raw_expense_type", "raw_service_area", "raw_supplier_category", "raw_txn_id", "raw_payment_type_col")}
    return A.judge(raw.withColumns(more))


_date = r"""
dated AS (SELECT *, trim(raw_date) AS r FROM messy),
parts AS (SELECT *, CASE
   WHEN regexp_matches(r, '^\d{4}-\d{2}-\d{2}$') THEN [r[1:4], r[6:7], r[9:10]] WHEN regexp_matches(r, '^\d{8}$') THEN [r[1:4], r[5:6], r[7:8]]
   WHEN regexp_matches(r, '^\d{2}[/.-]\d{2}[/.-]\d{4}$') THEN [r[7:10], r[4:5], r[1:2]] WHEN regexp_matches(r, '^\d{2}/\d{2}/\d{2}$') THEN [CASE WHEN CAST(r[7:8] AS INT) < 50 THEN '20' ELSE '19' END || r[7:8], r[4:5], r[1:2]]
   WHEN regexp_matches(r, '^\d{2}-Jul-\d{4}$') THEN [r[8:11], '07', r[1:2]] WHEN regexp_matches(r, '^\d{2} September \d{2}$') THEN [CASE WHEN CAST(r[14:15] AS INT) < 50 THEN '20' ELSE '19' END || r[14:15], '09', r[1:2]]
   WHEN regexp_matches(r, '^\d{5}$') THEN [strftime(DATE '1899-12-30' + CAST(r AS INT), '%Y'), strftime(DATE '1899-12-30' + CAST(r AS INT), '%m'), strftime(DATE '1899-12-30' + CAST(r AS INT), '%d')] END AS p FROM dated),
dates AS (SELECT *, coalesce(CASE WHEN CAST(p[2] AS INT) BETWEEN 1 AND 12 AND CAST(p[3] AS INT) BETWEEN 1 AND 31 AND CAST(p[1] AS INT) BETWEEN 1900 AND 2100 THEN p[3] || '/' || p[2] || '/' || p[1] END, CASE WHEN file LIKE '%mar2021%' THEN '01/03/2021' END) AS date FROM parts),
amounts AS (SELECT *, replace(regexp_replace(regexp_replace(trim(translate(raw_amount, '£$€,', '')), '(\d) (\d{3})$', '\1\2'), '(\d) (\d{1,2})$', '\1.\2'), ' ', '') AS amount FROM dates),
named AS (SELECT *, CASE linenumber % 7 WHEN 0 THEN s0 WHEN 1 THEN regexp_replace(s0, 'Ltd.*$', 'Ltd') WHEN 4 THEN '****' WHEN 5 THEN '7' ELSE s0 END AS sup FROM (
   SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(raw_supplier, '^PAYPAL \*', ''), '^stk\*', ''), '(^|\D)\d{4,}(\D|$)', '\1\2', 'g'), ' ,.*-') AS s0 FROM amounts)),
fated AS (SELECT *, CASE WHEN date IS NULL AND raw_date IS NULL THEN 'no_date' WHEN date IS NULL THEN 'bad_date' WHEN amount IN ('', '-', '.') THEN 'no_amount'
   WHEN NOT regexp_matches(amount, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN 'bad_amount' WHEN length(sup) < 2 THEN 'bad_supplier' ELSE 'ok' END AS fate FROM named)
"""


@register(f"WITH {MESSY}, {_date} SELECT orderkey, linenumber, date, amount, CASE WHEN file LIKE '%card%' THEN 'Card' ELSE 'Main' END AS payment_type, fate FROM fated")
def normalise_fact(spark, d):
    return judged(spark, d).select("orderkey", "linenumber", "date", "amount", "payment_type", "fate")


@register(f"""WITH {MESSY}, {_date}, e AS (SELECT borough, file, count(*) FILTER (WHERE fate = 'ok') AS ok, count(*) FILTER (WHERE fate = 'bad_date') AS bad_date, count(*) FILTER (WHERE fate = 'bad_amount') AS bad_amount, count(*) FILTER (WHERE fate = 'bad_supplier') AS bad_supplier FROM fated GROUP BY 1, 2)
 SELECT *, round((bad_date + bad_amount + bad_supplier) / nullif(bad_date + bad_amount + bad_supplier + ok, 0), 4) AS error_rate FROM e""")
def file_error_rates(spark, d):
    return A.error_rates(judged(spark, d))


@register(f"WITH {MESSY}, {_date} SELECT DISTINCT raw_date, date, substr(date, 7, 4) AS year, CAST(month(TRY_CAST(substr(date, 7, 4) || '-' || substr(date, 4, 2) || '-' || substr(date, 1, 2) AS DATE)) AS INT) AS month_number FROM (SELECT raw_date, CASE WHEN CAST(p[2] AS INT) BETWEEN 1 AND 12 AND CAST(p[3] AS INT) BETWEEN 1 AND 31 AND CAST(p[1] AS INT) BETWEEN 1900 AND 2100 THEN p[3] || '/' || p[2] || '/' || p[1] END AS date FROM parts)")
def standard_dates(spark, d):
    raw = select(spark, d, "messy", MESSY).select("raw_date").distinct()
    date = D.standard_date(F.col("raw_date"))
    return raw.select("raw_date", date.alias("date"), D.year_of(date).alias("year"), D.month_of(date).alias("month_number"))


@register()
def delimited_scan(spark, d):
    """Documents written as quoted CSV, whose texts have newlines and quotes, and read back by byte ranges."""
    views(spark, d)
    folder = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    spark.table("documents").select("doc_id", "lang", "source", "text").write.options(header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
    cell = lambda i: F.get("cells", F.lit(i))
    return delimited.scan(spark, folder).filter("row_idx > 0").select(cell(0).cast("long").alias("doc_id"), cell(1).alias("lang"), cell(2).alias("source"), F.length(cell(3)).alias("n_chars"), F.crc32(cell(3).cast("binary")).alias("text_crc"), F.size("cells").alias("n_cells"))


FILED = """filed AS (SELECT 'spend-' || c_nationkey || '.csv' AS file, c_custkey AS n, '0' || (1 + c_custkey % 9) || '/0' || (1 + c_nationkey % 9) || '/2024' AS paid,
 CASE WHEN c_acctbal < 0 THEN 'n/a' ELSE '' || CAST(round(c_acctbal * 100) AS BIGINT) END AS amount, 'Firm ' || c_mktsegment AS firm, 'Unit ' || (c_custkey % 5) AS unit FROM customer)"""
HEADED = [(0, ["Spend report"]), (1, ["", ""]), (2, ["Payment Date", "Amount £", "Published Supplier Name", "Organisation"])]


@register(f"WITH {FILED} SELECT 'Camden' AS borough, 'Main' AS payment_type, paid AS date, '2024' AS year, amount, firm AS supplier, unit AS department, file AS source_file FROM filed WHERE amount <> 'n/a'")
def build_fact(spark, d):
    filed = select(spark, d, "filed", FILED)
    body = filed.select("file", (F.col("n") + 10).cast("int").alias("row_idx"), F.array("paid", "amount", "firm", "unit").alias("cells"))
    files = filed.select("file").distinct()
    for i, cells in HEADED:
        body = body.unionByName(files.select("file", F.lit(i).alias("row_idx"), F.array(*[F.lit(c) for c in cells]).alias("cells")))
    sheet = spark.createDataFrame([("Barnet", "Paid, Net", "", "", "Paid", "Net")], "Borough string, Header string, `Affected Files` string, do_not_process string, date string, amount string")
    for t in A.TARGETS[2:]:
        sheet = sheet.withColumn(t, F.lit("--"))
    return A.build_fact(body.withColumn("borough", F.lit("Camden")), A.mapping_rows(sheet), "2024-01-01")[0].select("borough", "payment_type", "date", "year", "amount", "supplier", "department", "source_file")


# ---- suppliers -----------------------------------------------------------------------------------------------------

_suf = "['and','of','" + "','".join(V.LEGAL_SUFFIXES) + "']"
_legal = "['" + "','".join(V.LEGAL_SUFFIXES) + "']"
_tld = "|".join(t.replace(".", r"\.") for t in V.TLDS)


def _key_sql(source: str, column: str, out: str, clean: bool) -> str:
    """CTE text that gives the canonical key of names, written without look-around."""
    first = f"trim(regexp_replace(regexp_replace(regexp_replace({column}, '(?i)^(?:paypal\\s*\\*\\s*|stk\\*)', ''), '^[ *:/.-]+', ''), '(?i)\\.(?:co\\.uk|org\\.uk|com|co|org|net|io|biz|info)\\b.*$', ''))" if clean else column
    return f"""{out}_a AS (SELECT *, regexp_replace(regexp_replace(replace(regexp_replace(lower({first}), '["''`´“”‘’]', '', 'g'), '&', ' '), '\\.({_tld})($|[\\s,./])', ' \\2', 'g'), '\\.(\\w)', '\\1', 'g') AS k0 FROM {source}),
 {out}_b AS (SELECT *, list_filter(string_split(regexp_replace(k0, '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' AND NOT list_contains({_suf}, w)) AS k1 FROM {out}_a),
 {out}_c AS (SELECT *, string_split(regexp_replace(array_to_string(k1, ' '), '^(?:the|a|an) (?:(?:the|a|an) )*(\\S\\S)', '\\1'), ' ') AS k2 FROM {out}_b),
 {out}_d AS (SELECT *, array_to_string(list_transform(k2, lambda w, i: w || CASE WHEN length(w) = 1 AND length(k2[i + 1]) = 1 THEN '' ELSE ' ' END), '') AS k3 FROM {out}_c),
 {out} AS (SELECT *, list_filter(string_split(k3, ' '), lambda w: w <> '' AND NOT list_contains({_legal}, w)) AS toks FROM {out}_d)"""


_sig = "array_to_string(list_transform(list_filter(toks, lambda t: NOT regexp_matches(t, '^[0-9]+$')), lambda t: CASE WHEN length(t) <= 3 THEN t ELSE t[1:1] END), '')"


@register(f"WITH {NAMES}, {_key_sql('names', 'name', 'k', False)} SELECT id, name, array_to_string(toks, ' ') AS name_key, coalesce(toks[1], '') AS block_key, {_sig} AS initials, contains(name, '(') OR list_has_any(regexp_split_to_array(lower(name), '\\s+'), ['{"','".join(w.replace(chr(39), chr(39) * 2) for w in V.ADORNMENTS)}']) AS adorned FROM k")
def name_keys(spark, d):
    toks = T.name_tokens(F.col("name"))
    return select(spark, d, "names", NAMES).select("id", "name", F.array_join(toks, " ").alias("name_key"), F.coalesce(F.get(toks, F.lit(0)), F.lit("")).alias("block_key"), T.initials(toks).alias("initials"), T.is_adorned(F.col("name")).alias("adorned"))


OVERRIDES = "overrides AS (SELECT p_partkey AS pos, upper(p_name) AS supplier, 'Override ' || p_brand AS supplier_clean FROM part WHERE p_partkey % 50 = 11)"


@register()
def clean_suppliers(spark, d):
    names = select(spark, d, "names", NAMES).withColumnRenamed("name", "supplier")
    return S.clean_suppliers(names, select(spark, d, "overrides", OVERRIDES), ["UK", "PLC"]).select("id", "supplier", "supplier_clean")


_ranks = " UNION ALL ".join(f"SELECT supplier_clean, '{f}' AS field, {f} AS value, CAST(total_amount AS DECIMAL(28,2)) AS amount FROM base WHERE {f} IS NOT NULL" for f in S.TOP_FIELDS)


@register(f"""WITH {SPEND}, {BASE}, l AS ({_ranks}), g AS (SELECT supplier_clean, field, value, row_number() OVER (PARTITION BY supplier_clean, field ORDER BY sum(amount) DESC, value) AS n FROM l GROUP BY 1, 2, 3),
 t AS (SELECT supplier_clean, field, string_agg(value, '; ' ORDER BY n) AS v FROM g WHERE n <= 3 GROUP BY 1, 2), w AS (SELECT supplier_clean, max(v) FILTER (WHERE field = 'service_area') AS top_service_area, max(v) FILTER (WHERE field = 'supplier_category') AS top_supplier_category, max(v) FILTER (WHERE field = 'department') AS top_department FROM t GROUP BY 1)
 SELECT s.*, top_service_area, top_department, top_supplier_category FROM (SELECT supplier_clean, CAST(sum(row_count) AS BIGINT) AS no_of_transactions, CAST(sum(CAST(total_amount AS DECIMAL(28,2))) AS DOUBLE) AS total_spend FROM base GROUP BY 1) s LEFT JOIN w USING (supplier_clean)""")
def supplier_context(spark, d):
    return S.supplier_context(base(spark, d)).select("supplier_clean", "no_of_transactions", "total_spend", "top_service_area", "top_department", "top_supplier_category")


_cut = lambda f: f"CASE WHEN length({f}) > 120 THEN regexp_replace(substr({f}, 1, 120), '; [^;]*$', '') ELSE {f} END"
_names = {"service_area": "Service areas", "expense_type": "Expense types", "department": "Departments", "supplier_category": "Supplier categories"}


@register(f"""WITH {SPEND}, {BASE}, l AS ({_ranks}), g AS (SELECT supplier_clean, field, value, row_number() OVER (PARTITION BY supplier_clean, field ORDER BY sum(amount) DESC, value) AS n FROM l GROUP BY 1, 2, 3),
 t AS (SELECT supplier_clean, field, string_agg(value, '; ' ORDER BY n) AS v FROM g WHERE n <= 3 GROUP BY 1, 2), c AS (SELECT supplier_clean, field, {_cut('v')} AS v FROM t),
 w AS (SELECT supplier_clean, {", ".join(f"max(v) FILTER (WHERE field = '{f}') AS {f}" for f in S.TOP_FIELDS)} FROM c GROUP BY 1),
 s AS (SELECT supplier_clean, CAST(sum(row_count) AS BIGINT) AS n, sum(CAST(total_amount AS DECIMAL(28,2))) AS total FROM base GROUP BY 1)
 SELECT supplier_clean, CAST(round(CAST(total / n AS DECIMAL(28,8)), 2) AS DOUBLE) AS avg_amount, expense_type AS top_expense_type,
  concat_ws(' | ', {", ".join(f"'{_names[f]}: ' || {f}" for f in S.TOP_FIELDS)}, 'Scale: ' || format('{{:,}}', n) || ' no_of_transactions, £' || format('{{:,.0f}}', CAST(total AS DOUBLE))) AS context_descriptor FROM s LEFT JOIN w USING (supplier_clean)""")
def supplier_descriptors(spark, d):
    return S.supplier_context(base(spark, d)).select("supplier_clean", "avg_amount", "top_expense_type", "context_descriptor")


_sector = "CASE " + " ".join(f"WHEN regexp_matches(n, '(?i)\\b({p.replace(chr(39), chr(39) * 2)})\\b') THEN '{label.replace(chr(39), chr(39) * 2)}'" for label, p in C.SECTORS) + f" ELSE '{C.OTHER_SECTOR}' END"
_word = lambda p, c="n", f="(?i)": f"regexp_matches({c}, '{f}{p.replace(chr(39), chr(39) * 2)}')"
_entity = f"({_word(C.CORPORATE)} OR {_word(C.ORGANISATION)} OR {_word(C.LAW)})"
TYPED = "typed AS (SELECT p_partkey AS id, trim(CASE p_partkey % 11 WHEN 0 THEN '12 ' || p_name || ' Road' WHEN 1 THEN 'Redacted ' || p_name WHEN 2 THEN 'Mr ' || p_name WHEN 3 THEN 'Department for ' || p_name WHEN 4 THEN p_name || ' Council' WHEN 5 THEN 'nan' WHEN 6 THEN p_name || ' School Ltd' WHEN 7 THEN p_name || ' Transport' WHEN 8 THEN '4 ' || p_name || ' Walk Chambers' WHEN 9 THEN p_name || ' Roofing' ELSE p_name END) AS n FROM part)"


@register(f"""WITH {TYPED}, v AS (SELECT *, {_sector} AS sector, ({_word(C.REDACTED, 'lower(n)', '')} OR contains(lower(n), 'redact')) AS red, {_entity} AS entity, {_word(C.HOUSE_NUMBER, 'n', '')} AND {_word(C.STREET)} AND NOT {_word(C.CORPORATE)} AS address FROM typed),
 c AS (SELECT *, CASE WHEN lower(n) IN ('nan','none','null','n/a','na','') THEN 'Nan' WHEN red AND entity THEN 'Business' WHEN red THEN 'Redacted' WHEN {_word(C.DEPARTMENT, 'lower(n)', '')} THEN 'Department' WHEN {_word(C.AGENCY, 'lower(n)', '')} THEN 'Gov Agency'
  WHEN address AND {_word(C.LAW)} THEN 'Business' WHEN address THEN 'Personal Address' WHEN {_word(C.TITLE)} THEN 'Persons Name' ELSE 'Business' END AS type FROM v)
 SELECT id, n AS supplier_clean, type, CASE WHEN type = 'Business' AND NOT red AND address AND {_word(C.LAW)} THEN 'Legal services' WHEN type = 'Business' THEN sector WHEN type IN ('Department', 'Gov Agency') THEN n ELSE '' END AS business_type FROM c""")
def classify_suppliers(spark, d):
    return C.classify(select(spark, d, "typed", TYPED).withColumnRenamed("n", "supplier_clean"))


GAZETTEER = "gazetteer AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN upper(split_part(p_name, ' ', 1)) ELSE split_part(p_name, ' ', 2) END AS name, CASE WHEN p_partkey % 2 = 0 THEN 'given' ELSE 'family' END AS kind, CASE WHEN p_partkey % 3 = 0 THEN 'Atlantis' ELSE 'Ireland' END AS country, p_partkey * 400 AS rank FROM part)"
_plain = "regexp_matches(n, '^[A-Za-z][A-Za-z''.-]*( +[A-Za-z][A-Za-z''.-]*){1,3}$') AND NOT regexp_matches(n, '(^| )[A-Z.''-]{1,4}( |$)')"


@register(f"""WITH {TYPED}, {GAZETTEER}, k AS (SELECT DISTINCT lower(name) AS token, kind FROM gazetteer WHERE country = 'Ireland' AND rank <= 45000), t AS (SELECT *, string_split(regexp_replace(lower(n), ' +', ' ', 'g'), ' ') AS w FROM typed),
 v AS (SELECT *, {_sector} AS sector, ({_word(C.REDACTED, 'lower(n)', '')} OR contains(lower(n), 'redact')) AS red, {_entity} AS entity, {_word(C.HOUSE_NUMBER, 'n', '')} AND {_word(C.STREET)} AND NOT {_word(C.CORPORATE)} AS address,
  {_plain} AND NOT {_entity} AND NOT {_word(C.NOT_PERSON)} AND EXISTS (SELECT 1 FROM k WHERE kind = 'given' AND token IN (w[1], w[2])) AND EXISTS (SELECT 1 FROM k WHERE kind = 'family' AND token = w[-1]) AS person FROM t)
 SELECT id, n AS supplier_clean, CASE WHEN lower(n) IN ('nan','none','null','n/a','na','') THEN 'Nan' WHEN red AND entity THEN 'Business' WHEN red THEN 'Redacted' WHEN {_word(C.DEPARTMENT, 'lower(n)', '')} THEN 'Department' WHEN {_word(C.AGENCY, 'lower(n)', '')} THEN 'Gov Agency'
  WHEN address AND {_word(C.LAW)} THEN 'Business' WHEN address THEN 'Personal Address' WHEN {_word(C.TITLE)} OR person THEN 'Persons Name' ELSE 'Business' END AS type FROM v""")
def classify_people(spark, d):
    """Persons told by a gazetteer that is a table."""
    names = C.gazetteer(select(spark, d, "gazetteer", GAZETTEER))
    return C.classify(select(spark, d, "typed", TYPED).withColumnRenamed("n", "supplier_clean"), names=names).select("id", "supplier_clean", "type")


# ---- matching ------------------------------------------------------------------------------------------------------

MATCHED = "wanted AS (SELECT DISTINCT name AS supplier_clean FROM names)"


def registry(spark, d):
    return R.registry(R.spread(select(spark, d, "companies", COMPANIES), "ch_row"))


@register(f"WITH {COMPANIES}, {_key_sql('companies', 'company_name', 'k', False)} SELECT ch_row, array_to_string(toks, ' ') AS norm_name, coalesce(toks[1], '') AS block_key, {_sig} AS initials_sig, sic_1 || CASE WHEN sic_2 <> '' THEN '; ' || sic_2 ELSE '' END AS sic_raw FROM k")
def registry_build(spark, d):
    return registry(spark, d).select("ch_row", "norm_name", "block_key", "initials_sig", "sic_raw")


@register()
def registry_load(spark, d):
    """Companies written as registry files with records too long, too short and blank lines between, and loaded back."""
    folder = f"{scratch_dir(spark)}/registry-{uuid.uuid4().hex}"
    c = select(spark, d, "companies", COMPANIES)
    fields = ["company_name", "company_number", "status", "town", "sic_1", "sic_2", "former_1"]
    quoted = [F.concat(F.lit('"'), F.replace(F.col(x), F.lit('"'), F.lit('""')), F.lit('"')) for x in fields]
    cut = F.when(F.col("ch_row") % 10 == 3, F.concat_ws(",", *quoted[:4])).when(F.col("ch_row") % 10 == 7, F.concat_ws(",", *quoted, F.lit("x"), F.lit("y"))).otherwise(F.concat_ws(",", *quoted))
    head = ' CompanyName , CompanyNumber,CompanyStatus,RegAddress.PostTown,SICCode.SicText_1,SICCode.SicText_2 ,PreviousName_1.CompanyName,"URI\n"'
    body = c.groupBy((F.col("ch_row") % 3).alias("file")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ch_row", cut.alias("line")))), lambda x: x["line"]), "\n\n").alias("text"))
    body.select("file", F.concat(F.lit(head + "\n"), "text").alias("value")).write.partitionBy("file").text(folder)
    columns = {k: v for k, v in R.COMPANY_COLUMNS.items() if v in fields}
    good, aside = R.load_companies(delimited.scan(spark, folder), columns)
    return good.select(*fields, F.lit(None).cast("string").alias("reason")).unionByName(aside.select(*[F.get("cells", F.lit(i)).alias(x) for i, x in enumerate(fields)], "reason"))


_pref = f"""
 s AS (SELECT supplier_clean, array_to_string(toks, ' ') AS s_key, toks AS s_toks FROM sk), r AS (SELECT *, array_to_string(toks, ' ') AS norm_name, contains(lower(status), 'active') AS active, contains(company_name, '(') OR list_has_any(regexp_split_to_array(lower(company_name), '\\s+'), ['{"','".join(w.replace(chr(39), chr(39) * 2) for w in V.ADORNMENTS)}']) AS adorned FROM rk),
 al AS (SELECT DISTINCT array_to_string(f.toks, ' ') AS alias, f.ch_row FROM fk f JOIN r USING (ch_row) WHERE array_to_string(f.toks, ' ') NOT IN ('', r.norm_name)),
 e AS (SELECT s.*, r.*, 'exact' AS basis FROM s JOIN r ON s.s_key = r.norm_name WHERE s_key <> '' UNION ALL SELECT s.*, r.*, 'exact_prev' FROM s JOIN al ON s.s_key = al.alias JOIN r USING (ch_row) WHERE s_key <> '' AND s_key NOT IN (SELECT norm_name FROM r)),
 w AS (SELECT *, count(*) OVER p AS n, count(*) FILTER (WHERE active) OVER p AS n_active, count(*) FILTER (WHERE active AND NOT adorned) OVER p AS n_plain,
   row_number() OVER (PARTITION BY supplier_clean ORDER BY active DESC, adorned, len(list_filter(toks, lambda t: NOT list_contains(s_toks, t))), len(regexp_split_to_array(trim(company_name), '\\s+')), company_number) AS rank FROM e WINDOW p AS (PARTITION BY supplier_clean)),
 z AS (SELECT *, n = 1 AS one, n <> 1 AND n_active = 1 AS one_active, n <> 1 AND n_active <> 1 AND n_plain = 1 AS one_plain FROM w)
 SELECT supplier_clean, company_number, CASE WHEN one THEN basis WHEN one_active THEN basis || '_active' WHEN one_plain THEN basis || '_plain' ELSE basis END AS match_basis, CASE WHEN one OR one_active OR one_plain THEN CASE WHEN basis = 'exact' THEN 'high' ELSE 'medium' END ELSE 'low' END AS confidence,
   CASE WHEN one OR one_active OR one_plain THEN 'resolved' ELSE 'candidate' END AS outcome, CAST(rank AS INT) AS rank FROM z WHERE one OR (one_active AND active) OR (one_plain AND active AND NOT adorned) OR (NOT one AND NOT one_active AND NOT one_plain AND rank <= 5)"""


@register(f"WITH {NAMES}, {MATCHED}, {COMPANIES}, {_key_sql('wanted', 'supplier_clean', 'sk', True)}, {_key_sql('companies', 'company_name', 'rk', False)}, fo AS (SELECT ch_row, former_1 FROM companies WHERE former_1 <> ''), {_key_sql('fo', 'former_1', 'fk', False)}, {_pref}")
def exact_matches(spark, d):
    wanted, companies = select(spark, d, "wanted", NAMES, MATCHED), select(spark, d, "companies", COMPANIES)
    found = R.decide_exact(R.exact_matches(wanted, R.registry(companies), R.aliases(companies, ["former_1"])))
    return found.select("supplier_clean", "company_number", "match_basis", "confidence", "outcome", "rank")


@register()
def match_suppliers(spark, d):
    wanted, companies = select(spark, d, "wanted", NAMES, MATCHED), R.spread(select(spark, d, "companies", COMPANIES), "ch_row")
    return R.match_suppliers(R.spread(wanted, "supplier_clean"), R.registry(companies), R.aliases(companies, ["former_1"]))


@register()
def recall_probe(spark, d):
    found = match_suppliers(spark, d)
    misses = found.filter("outcome = 'no_match'").select("supplier_clean")
    return R.recall_probe(misses, registry(spark, d)).select("supplier_clean", "ch_row", "rank", "token_set", "weighted", "token_sort", "partial", "match_tier", "primary_category", "anchor_token", "anchor_df")


@register(f"WITH {COMPANIES}, {_key_sql('companies', 'company_name', 'k', False)} SELECT token, count(*) AS df FROM (SELECT DISTINCT ch_row, unnest(toks) AS token FROM k) GROUP BY 1")
def token_index(spark, d):
    return R.token_frequency(R.token_postings(registry(spark, d), "ch_row", F.split("norm_name", " ")))


_pool = """
 po AS (SELECT DISTINCT ch_row, unnest(toks) AS token FROM rk), df AS (SELECT token, count(*) AS df FROM po GROUP BY 1), o AS (SELECT DISTINCT supplier_clean, unnest(toks) AS token FROM sk),
 q AS (SELECT o.*, df, row_number() OVER (PARTITION BY supplier_clean ORDER BY df, token) AS n FROM o JOIN df USING (token)), u AS (SELECT supplier_clean, token, df, row_number() OVER (PARTITION BY supplier_clean ORDER BY df, token) AS n FROM q WHERE df <= 150000 OR n = 1),
 b AS (SELECT *, coalesce(sum(df) OVER (PARTITION BY supplier_clean ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u WHERE n <= 3), p AS (SELECT DISTINCT supplier_clean, ch_row FROM b JOIN po USING (token) WHERE before < 4000)
 SELECT supplier_clean, ch_row AS row FROM (SELECT *, row_number() OVER (PARTITION BY supplier_clean ORDER BY ch_row) AS r FROM p) WHERE r <= 4000"""


@register(f"WITH {NAMES}, {MATCHED}, {COMPANIES}, {_key_sql('wanted', 'supplier_clean', 'sk', True)}, {_key_sql('companies', 'company_name', 'rk', False)}, {_pool}")
def candidate_pool(spark, d):
    postings = R.token_postings(registry(spark, d), "ch_row", F.split("norm_name", " "))
    return R.candidate_pool(R.supplier_keys(select(spark, d, "wanted", NAMES, MATCHED)), postings, R.token_frequency(postings))


_all_weights = """ po AS (SELECT DISTINCT ch_row, unnest(toks) AS token FROM rk), n AS (SELECT count(*) AS n FROM rk), df AS (SELECT token, CAST(round(1000.0 * ln(n / count(*))) AS BIGINT) AS w FROM po, n GROUP BY token, n),
 o AS (SELECT DISTINCT supplier_clean, unnest(toks) AS token FROM sk), sc AS (SELECT supplier_clean, ch_row AS row, CAST(sum(w) AS BIGINT) AS weight FROM o JOIN df USING (token) JOIN po USING (token) GROUP BY 1, 2)
 SELECT *, CAST(row_number() OVER (PARTITION BY supplier_clean ORDER BY weight DESC, row) AS INT) AS rank FROM sc QUALIFY rank <= 5"""


@register(f"WITH {NAMES}, {MATCHED}, {COMPANIES}, {_key_sql('wanted', 'supplier_clean', 'sk', True)}, {_key_sql('companies', 'company_name', 'rk', False)}, {_all_weights}")
def token_retrieval(spark, d):
    reg, split = registry(spark, d), F.split("norm_name", " ")
    postings = R.token_postings(reg, "ch_row", split)
    return I.top_by_tokens(R.supplier_keys(select(spark, d, "wanted", NAMES, MATCHED)), postings, R.token_frequency(postings), reg.select(F.col("ch_row").alias("row"), split.alias("tokens")))


@register("SELECT a.p_partkey AS a, b.p_partkey AS b, CAST(levenshtein(a.p_type, b.p_type) AS INT) AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE levenshtein(a.p_type, b.p_type) <= 12")
def blocked_edit_distance(spark, d):
    views(spark, d)
    pairs = B.kind_pairs(spark.table("part"), ["p_brand", "p_size"], "p_type", "p_partkey")
    near = pairs.withColumn("distance", F.levenshtein("x", "y")).filter("distance <= 12")
    return B.expand(near).select("a", "b", "distance")


@register()
def fuzzy_scores(spark, d):
    """Names of one nation, every two of its suppliers."""
    views(spark, d)
    return B.scored_pairs(B.tiles(spark.table("supplier"), ["s_nationkey"], "s_suppkey", "s_name"))


TOKENS = "pairs AS (SELECT a.p_partkey AS id, a.p_name || ' services' AS x, b.p_name || CASE WHEN b.p_partkey % 3 = 0 THEN ' public' WHEN b.p_partkey % 3 = 1 THEN ' energies' ELSE ' group' END AS y FROM part a JOIN part b ON b.p_partkey = a.p_partkey + a.p_size % 3)"
_dull = "['" + "','".join(V.GENERIC_WORDS + V.RESIDUE_WORDS) + "']"
_stem = "CASE WHEN t LIKE '%ies' AND length(t) > 4 THEN t[1:length(t)-3] || 'y' WHEN t LIKE '%es' AND length(t) > 4 THEN t[1:length(t)-2] WHEN t LIKE '%s' AND length(t) > 3 THEN t[1:length(t)-1] ELSE t END"
_dist = lambda c: f"list_distinct(list_transform(list_filter(string_split({c}, ' '), lambda t: NOT list_contains({_dull}, t) AND NOT regexp_matches(t, '^[0-9]+$') AND length(t) > 1), lambda t: {_stem}))"


#: How many registry rows have the token that a pair's names share, here the pairs that have the first word of x.
_anchors = "anchors AS (SELECT string_split(x, ' ')[1] AS token, count(*) * 100 AS df FROM pairs GROUP BY 1)"


@register(f"""WITH {TOKENS}, {_anchors}, t AS (SELECT pairs.*, df, {_dist('x')} AS s, {_dist('y')} AS c, (SELECT {_stem} FROM (SELECT string_split(x, ' ')[1] AS t)) AS hx, (SELECT {_stem} FROM (SELECT string_split(y, ' ')[1] AS t)) AS hy FROM pairs JOIN anchors ON token = string_split(x, ' ')[1]),
 u AS (SELECT *, len(list_intersect(s, c)) AS shared, len(list_filter(s, lambda t: NOT list_contains(c, t))) AS ls, len(list_filter(c, lambda t: NOT list_contains(s, t))) AS lc FROM t)
 SELECT id, x, y, CASE WHEN shared = 0 THEN 'weak' WHEN df > 25000 THEN 'loose' WHEN ls = 0 AND lc = 0 THEN 'clean' WHEN hx = hy AND list_contains(s, hx) AND list_contains(c, hx) AND ls = 0 THEN 'head_modifier' ELSE 'loose' END AS match_tier FROM u""")
def match_tiers(spark, d):
    p = select(spark, d, "pairs", TOKENS).withColumn("token", F.get(F.split("x", " "), F.lit(0)))
    p = p.join(p.groupBy("token").agg((F.count(F.lit(1)) * 100).alias("df")), "token")
    return p.select("id", "x", "y", T.match_tier(F.split("x", " "), F.split("y", " "), F.col("df")).alias("match_tier"))


@register()
def token_differences(spark, d):
    p = select(spark, d, "pairs", TOKENS)
    got = T.differences(F.split("x", " "), F.split("y", " "))
    return p.select("id", *[(F.array_join(c, " ") if k in ("shared", "extra_registry", "extra_supplier") else c).alias(k) for k, c in got.items()])


SIC = "sic AS (SELECT CAST(p_partkey AS VARCHAR(10)) AS supplier_clean, lpad(CAST(p_partkey AS VARCHAR(8)), 8, '0') AS company_number, p_name AS company_name, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE lpad(CAST(1000 + p_size * 311 AS VARCHAR(5)), 5, '0') || ' - Activity ' || CAST(p_size AS VARCHAR(3)) || CASE WHEN p_partkey % 2 = 0 THEN '; 62020 - Other' ELSE '' END END AS sic_raw, 'exact' AS match_basis, 'high' AS confidence, p_size AS size FROM part)"
WORKBOOK = "workbook AS (SELECT DISTINCT 'Class ' || CAST(p_size AS VARCHAR(3)) AS \"Description\", 'A' AS \"SECTION\", substr(lpad(CAST(1000 + p_size * 311 AS VARCHAR(5)), 5, '0'), 1, 2) AS \"Division\", 'g' AS \"Group\", substr(lpad(CAST(1000 + p_size * 311 AS VARCHAR(5)), 5, '0'), 1, 4) AS \"Class\" FROM part WHERE p_size % 4 <> 0)"


@register(f"""WITH {SIC}, {WORKBOOK}, d AS (SELECT DISTINCT "Division" AS division FROM workbook), t AS (SELECT * REPLACE (CASE WHEN size % 12 IN (0, 3) THEN '' ELSE company_number END AS company_number, CASE WHEN size % 3 <> 0 OR (size % 12 NOT IN (0, 3) AND size % 5 <> 0) THEN sic_raw ELSE '' END AS sic_raw), CASE WHEN size % 3 <> 0 THEN 'exact' WHEN size % 12 = 0 THEN 'model_error' WHEN size % 12 = 3 THEN 'model_none' ELSE 'model' END AS way FROM sic), p AS (SELECT *, regexp_extract(sic_raw, '^(\\d{{4,5}})', 1) AS code FROM t), q AS (SELECT *, CASE WHEN code = '' THEN '' ELSE substr(lpad(code, 5, '0'), 1, 4) END AS cls, CASE WHEN code = '' THEN '' ELSE substr(lpad(code, 5, '0'), 1, 2) END AS div FROM p)
 SELECT supplier_clean, company_number, way AS resolution_method, code AS sic_code, cls AS sic_class, coalesce(w."Description", '') AS class_description, div AS sic_division, CASE WHEN d.division IS NULL THEN '' ELSE 'Division ' || div END AS division_description, CASE WHEN d.division IS NULL THEN '' ELSE 'A' END AS sic_section, CASE WHEN d.division IS NULL THEN '' ELSE 'Section A' END AS section_description,
 CAST(CASE WHEN sic_raw = '' THEN 0 ELSE len(string_split(sic_raw, ';')) END AS INT) AS sic_count FROM q LEFT JOIN workbook w ON q.cls = w."Class" LEFT JOIN d ON q.div = d.division""")
def resolve_sic(spark, d):
    views(spark, d)
    rows = spark.sql("WITH " + WORKBOOK.replace('"', "`") + " SELECT * FROM workbook")
    divisions = rows.select(F.concat(F.lit("Division "), "Division").alias("Description"), F.lit("A").alias("SECTION"), "Division", F.lit("na").alias("Group"), F.lit("na").alias("Class")).distinct()
    top = spark.createDataFrame([("Section A", "A", "na", "na", "na")], "Description string, SECTION string, Division string, `Group` string, Class string")
    levels = R.sic_levels(rows.unionByName(divisions).unionByName(top))
    sic = select(spark, d, "sic", SIC)
    told = F.when(F.expr("size % 12 = 3"), " none ").when(F.expr("size % 12 <> 0"), F.col("company_number"))
    answers = sic.select("supplier_clean", F.explode(F.array(F.struct(F.lit(1).alias("line_no"), F.lit("00000000").alias("company_number")), F.struct(F.lit(2).alias("line_no"), told.alias("company_number")))).alias("x")).select("supplier_clean", "x.*", F.lit("HIGH").alias("confidence"))
    out = R.resolve_sic(sic.filter("size % 3 <> 0"), sic.filter("size % 5 <> 0"), answers, levels)
    return out.select("supplier_clean", "company_number", "resolution_method", "sic_code", "sic_class", "class_description", "sic_division", "division_description", "sic_section", "section_description", "sic_count")


@register("SELECT CASE WHEN v < 60 THEN '0-60' WHEN v < 82 THEN '60-82' WHEN v < 95 THEN '82-95' WHEN v < 101 THEN '95-101' END AS bucket, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM (SELECT p_size * 2 AS v FROM part) GROUP BY 1")
def score_histogram(spark, d):
    views(spark, d)
    return R.score_histogram(spark.table("part").select((F.col("p_size") * 2).alias("v")), "v", [0, 60, 82, 95, 101])


@register("SELECT n.n_name AS supplier_clean, count(*) AS candidates, count(*) >= 5 AS at_cap FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1")
def homonyms_at_cap(spark, d):
    views(spark, d)
    return G.homonyms_at_cap(spark.table("supplier").join(spark.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("supplier_clean")))


LABELS = """labelled AS (SELECT CAST(p_partkey AS VARCHAR(10)) AS supplier_clean, CASE WHEN p_partkey % 3 = 0 THEN 'Y' ELSE 'N' END AS label, CASE p_partkey % 4 WHEN 0 THEN 'see ' || lpad(CAST(p_partkey + 1 AS VARCHAR(8)), 8, '0') WHEN 1 THEN 'maybe SC123456' WHEN 2 THEN 'no. ' || CAST(100000 + p_partkey AS VARCHAR(8)) ELSE NULL END AS note, lpad(CAST(p_partkey AS VARCHAR(8)), 8, '0') AS company_number FROM part)"""


@register(f"""WITH {LABELS}, r AS (SELECT *, CASE WHEN note LIKE 'see %' THEN [substr(note, 5)] WHEN note LIKE 'maybe%' THEN ['SC123456'] WHEN note LIKE 'no.%' THEN ['00' || substr(note, 5)] ELSE [] END AS nums FROM labelled),
 s AS (SELECT *, CASE WHEN label = 'Y' THEN list_append(nums, company_number) ELSE nums END AS rn, CAST(supplier_clean AS INT) AS id FROM r)
 SELECT supplier_clean, label, note, company_number, CASE WHEN len(rn) = 0 THEN 'UNKNOWN' WHEN id % 5 = 0 AND list_contains(rn, company_number) THEN 'FIXED' WHEN id % 5 <> 0 AND list_contains(rn, lpad(CAST(id + 1 AS VARCHAR), 8, '0')) THEN 'TOP' WHEN id % 5 <> 0 AND list_contains(rn, company_number) THEN 'PRESENT' ELSE 'ABSENT' END AS verdict FROM s""")
def score_labels(spark, d):
    l = select(spark, d, "labelled", LABELS)
    fifth = F.col("supplier_clean").cast("int") % 5 == 0
    resolved = l.filter(fifth).select("supplier_clean", "company_number")
    cand = l.filter(~fifth).select("supplier_clean", F.explode(F.array(F.struct(F.lpad((F.col("supplier_clean").cast("int") + 1).cast("string"), 8, "0").alias("company_number"), F.lit(1).alias("rank")), F.struct("company_number", F.lit(2).alias("rank")))).alias("x")).select("supplier_clean", "x.*")
    return R.score_labels(l, resolved, cand)


@register()
def stratified_sample(spark, d):
    views(spark, d)
    return R.stratified_sample(spark.table("part"), ["p_brand"], "p_partkey", 60).select("p_partkey", "p_brand")


MERGE = "given AS (SELECT CAST(p_partkey AS VARCHAR(10)) AS supplier_clean, CASE WHEN p_size % 2 = 0 THEN 'Design' ELSE 'Unheard of' END AS business_type, CASE WHEN p_partkey % 10 = 0 THEN 'Legal' WHEN p_partkey % 10 = 1 THEN 'Nonsense' END AS override_business_type FROM part), told AS (SELECT CAST(p_partkey AS VARCHAR(10)) AS supplier_clean, p_partkey AS line_no, CASE WHEN p_partkey % 3 = 0 THEN 'Security' ELSE 'Rubbish' END AS business_subtype, 'OK' AS status FROM part WHERE p_partkey % 2 = 0)"
SUBTYPES = [(1, "Professional", "Legal"), (2, "Property", "Security"), (3, "Media", "Media, marketing & design"), (4, "Other", "Other / unclassified")]


@register(f"""WITH {MERGE}, x(id, parent, sub) AS (VALUES {", ".join(f"({i}, '{p}', '{s}')" for i, p, s in SUBTYPES)}), m AS (SELECT g.*, CASE WHEN override_business_type = 'Legal' THEN 'Legal' END AS o, CASE WHEN t.business_subtype = 'Security' THEN 'Security' END AS mo, t.status AS st FROM given g LEFT JOIN told t USING (supplier_clean)),
 f AS (SELECT supplier_clean, coalesce(o, mo, CASE WHEN business_type = 'Design' THEN 'Media, marketing & design' ELSE 'Other / unclassified' END) AS business_subtype, CASE WHEN o IS NOT NULL THEN 'override' WHEN mo IS NOT NULL THEN 'model' ELSE 'baseline' END AS source, st FROM m)
 SELECT supplier_clean, business_subtype, parent AS parent_type, CAST(x.id AS INT) AS subtype_id, CASE WHEN source = 'model' THEN st ELSE upper(source) END AS status, source FROM f LEFT JOIN x ON f.business_subtype = x.sub""")
def merge_types(spark, d):
    taxonomy = spark.createDataFrame(SUBTYPES, "id int, business_type string, business_subtype string")
    return C.merge_types(select(spark, d, "given", MERGE), select(spark, d, "told", MERGE), taxonomy)


# ---- files, links, requests ----------------------------------------------------------------------------------------

ROWS = """rows_in AS (SELECT n.n_name AS borough, 'f' || CAST(c.c_custkey % 20 AS VARCHAR(3)) AS file, c.c_custkey AS row_idx, c.c_name AS a, c.c_mktsegment AS b, c.c_custkey AS k FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)"""


@register(f"WITH {ROWS}, x AS (SELECT borough, file, row_idx, k % 7 = 3 AS head FROM rows_in), h AS (SELECT borough, file, min(row_idx) AS header_idx FROM x WHERE head GROUP BY 1, 2) SELECT x.borough, x.file, row_idx FROM x LEFT JOIN h ON x.borough = h.borough AND x.file = h.file WHERE row_idx >= coalesce(header_idx, 0)")
def strip_preamble(spark, d):
    r = select(spark, d, "rows_in", ROWS)
    cells = F.when(F.col("k") % 7 == 3, F.array(F.lit("Payment_Date"), F.lit("Supplier"), F.lit("Net"))).when(F.col("k") % 7 == 4, F.array(F.lit("updated"), "a", "b")).otherwise(F.array("a", "b", F.lit("")))
    return O.strip_preamble(r.withColumn("cells", cells), O.header_rows(r.withColumn("cells", cells), within=1 << 40)).select("borough", "file", "row_idx")


@register(f"WITH {ROWS}, h AS (SELECT borough, file, CASE WHEN min(k) % 2 = 0 THEN 'Payment Date, Net Amount, Supplier Name' ELSE 'Period, Value' END AS header FROM rows_in GROUP BY 1, 2) SELECT borough, header, count(*) AS file_count, min(file) AS example_file, CAST(len(string_split(header, ', ')) AS INT) AS column_count FROM h GROUP BY borough, header")
def scan_schemas(spark, d):
    r = select(spark, d, "rows_in", ROWS).groupBy("borough", "file").agg(F.min("k").alias("m"))
    heads = r.select("borough", "file", F.when(F.col("m") % 2 == 0, F.array(F.lit("Payment Date"), F.lit("Net Amount"), F.lit("Supplier Name"), F.lit(""))).otherwise(F.array(F.lit("Period"), F.lit("Value"))).alias("header"))
    return O.scan_schemas(heads).select("borough", F.array_join("header", ", ").alias("header"), "file_count", "example_file", "column_count")


SHEETS = """cells_in AS (SELECT n_name AS borough, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE concat('D', l_suppkey % 3) END AS district, concat('spend_', year(l_shipdate), CASE WHEN l_linenumber = 1 THEN '_card' ELSE '' END, '.csv') AS file, year(l_shipdate) % 2 AS odd, l_orderkey * 8 + l_linenumber AS row_idx, l_returnflag AS a, CASE WHEN l_linestatus = 'O' THEN ' ' ELSE l_linestatus END AS b FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
 heads AS (SELECT DISTINCT borough, district, file, odd FROM cells_in UNION ALL SELECT DISTINCT borough, district, 'a_empty.csv', 0 FROM cells_in)"""


def _sheets(spark, d):
    cells = select(spark, d, "cells_in", SHEETS)
    files = materialize(cells.select("borough", "district", "file", "odd").distinct())  # SHEETS' heads, from one pass over the rows
    heads = files.unionByName(files.select("borough", "district", F.lit("a_empty.csv").alias("file"), F.lit(0).alias("odd")).distinct()).withColumn("header", F.when(F.col("odd") == 0, F.array(F.lit("Cost Type"), F.lit("Service Category"), F.lit(""))).otherwise(F.array(F.lit("Area"), F.lit("Purpose"))))
    return heads, cells.withColumn("cells", F.array("a", "b"))


@register(f"""WITH {SHEETS}, t AS (SELECT *, row_number() OVER (PARTITION BY borough, district, file ORDER BY row_idx, a, b) AS n FROM cells_in),
 e AS (SELECT borough, district, file, string_agg(a || '|' || b, '; ' ORDER BY n) AS examples FROM t WHERE n <= 10 GROUP BY 1, 2, 3),
 f AS (SELECT h.*, CASE WHEN h.file LIKE '%card%' THEN 'Card' ELSE 'Main' END AS label, CASE WHEN odd = 0 THEN 'Cost Type, Service Category' ELSE 'Area, Purpose' END AS header, e.examples FROM heads h LEFT JOIN e ON h.borough = e.borough AND h.district = e.district AND h.file = e.file)
 SELECT borough, district, label, header, count(*) AS file_count, string_agg(file, ', ' ORDER BY file) AS files, arg_min(file, CASE WHEN examples IS NULL THEN '1' ELSE '0' END || file) AS example_file, coalesce(arg_min(examples, CASE WHEN examples IS NULL THEN '1' ELSE '0' END || file), '') AS examples,
 CASE WHEN header LIKE 'Area%' THEN 'Purpose' ELSE header END AS category_candidates FROM f GROUP BY borough, district, label, header""")
def schema_groups(spark, d):
    text = F.array_join(F.transform("examples", lambda r: F.array_join(r, "|")), "; ").alias("examples")
    lists = {"header": ", ", "files": ", ", "category_candidates": ", "}
    return O.schema_groups(*_sheets(spark, d)).select("borough", "district", "label", "file_count", "example_file", text, *[F.array_join(c, by).alias(c) for c, by in lists.items()])


@register(f"""WITH {SHEETS}, x AS (SELECT borough, district, CASE WHEN file LIKE '%card%' THEN 'Card' ELSE 'Main' END AS label, odd, a, CASE WHEN b = ' ' THEN '(blank)' ELSE b END AS b FROM cells_in)
 SELECT borough, district, label, "column", "value", count(*) AS n FROM (SELECT borough, district, label, 'Cost Type' AS "column", a AS "value" FROM x WHERE odd = 0 UNION ALL SELECT borough, district, label, CASE WHEN odd = 0 THEN 'Service Category' ELSE 'Purpose' END, b FROM x) GROUP BY ALL""")
def category_values(spark, d):
    return O.category_values(*_sheets(spark, d)).drop("header")


@register(f"WITH {ROWS} SELECT borough, field, value, count(*) AS n FROM (SELECT borough, 'segment' AS field, b AS value FROM rows_in UNION ALL SELECT borough, 'odd', CASE WHEN k % 2 = 0 THEN '(blank)' ELSE 'odd' END FROM rows_in) GROUP BY ALL")
def value_distribution(spark, d):
    r = select(spark, d, "rows_in", ROWS).withColumn("cells", F.array("b", F.when(F.col("k") % 2 == 0, " ").otherwise("odd")))
    return O.value_distribution(r, {"segment": 0, "odd": 1})


@register(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h FROM pages), b AS (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos FROM a)
 SELECT page_id, CAST(pos AS INT) AS pos, href FROM b""")
def page_links(spark, d):
    views(spark, d)
    return L.links(spark.table("pages")).select("page_id", "pos", "href")


@register(r"""WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h FROM pages), b AS (SELECT page_id, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos FROM a)
 SELECT page_id, href, CAST(min(pos) AS INT) AS pos FROM b WHERE regexp_matches(href, '^/[a-m]') GROUP BY 1, 2""")
def page_discovery(spark, d):
    views(spark, d)
    return L.distinct_pages(L.links(spark.table("pages")), "^/[a-m]").select("page_id", "href", "pos")


MANIFEST = "manifest AS (SELECT n_name AS borough, date_trunc('month', o_orderdate) AS m, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"


@register(f"""WITH {MANIFEST}, c AS (SELECT borough, CAST(year(m) AS INT) AS year, {", ".join(f"count(*) FILTER (WHERE month(m) = {i}) AS m{i}" for i in range(1, 13))} FROM manifest GROUP BY 1, 2) SELECT * FROM c UNION ALL SELECT 'Total', year, {", ".join(f"CAST(sum(m{i}) AS BIGINT)" for i in range(1, 13))} FROM c GROUP BY year""")
def coverage_matrix(spark, d):
    return L.coverage_matrix(select(spark, d, "manifest", MANIFEST).select("borough", F.col("m").cast("date").alias("month")))


@register(f"""WITH {MANIFEST}, p AS (SELECT borough, CAST(min(m) AS DATE) AS first_month, CAST(max(m) AS DATE) AS last_month, count(DISTINCT m) AS months, count(*) AS files FROM manifest GROUP BY 1), s AS (SELECT *, CAST(datediff('month', first_month, last_month) + 1 AS BIGINT) AS span FROM p)
 SELECT *, span - months AS missing, CASE WHEN months < 3 THEN 'unknown' WHEN files / months >= 1 THEN 'monthly' ELSE 'quarterly' END AS frequency FROM s""")
def coverage_summary(spark, d):
    return L.coverage_summary(select(spark, d, "manifest", MANIFEST).select("borough", F.col("m").cast("date").alias("month")))


PERIODS = "periods AS (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'Q' || CAST(1 + o_orderkey % 4 AS VARCHAR(1)) || ' 2021 spend' WHEN 1 THEN 'October 2022' WHEN 2 THEN 'November to February 2023' WHEN 3 THEN 'Spend 2020' ELSE 'no date' END AS t FROM orders)"


@register(f"""WITH {PERIODS}, r AS (SELECT id, t, CASE id % 5 WHEN 0 THEN CASE 1 + id % 4 WHEN 1 THEN DATE '2021-04-01' WHEN 2 THEN DATE '2021-07-01' WHEN 3 THEN DATE '2021-10-01' ELSE DATE '2022-01-01' END WHEN 1 THEN DATE '2022-10-01' WHEN 2 THEN DATE '2022-11-01' WHEN 3 THEN DATE '2020-04-01' END AS s, CASE id % 5 WHEN 0 THEN 3 WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 12 ELSE 0 END AS n FROM periods)
 SELECT id, t AS link_text, CAST(s + to_months(CAST(i AS INT)) AS DATE) AS month FROM r, range(0, 12) x(i) WHERE i < n""")
def covered_months(spark, d):
    return L.covered_months(select(spark, d, "periods", PERIODS).withColumnRenamed("t", "link_text"))


@register(f"""WITH {SPEND}, {BASE}, t AS (SELECT *, row_number() OVER (ORDER BY total_amount DESC, {", ".join(f"{k} NULLS LAST" for k in V.KEY_COLUMNS)}) AS n FROM base),
 b AS (SELECT *, concat_ws(chr(10), 'department: ' || department, 'expense_type: ' || expense_type, 'service_area: ' || service_area, 'supplier_category: ' || supplier_category, 'supplier_clean: ' || supplier_clean) AS block FROM t)
 SELECT 'RQ_' || n AS key, n AS line_no, (n - 1) // 5000 + 1 AS file_no, CASE WHEN max(n) OVER () <= 5000 THEN 'batch.jsonl' ELSE 'batch_' || ((n - 1) // 5000 + 1) || '.jsonl' END AS file_name, block FROM b""")
def taxonomy_requests(spark, d):
    r = Q.taxonomy_requests(X.taxonomy_base(spend(spark, d)), None, 5000)
    return r.select("key", "line_no", "file_no", "file_name", F.get_json_object("line", "$.request.contents[0].parts[0].text").alias("block"))


@register(f"""WITH {NAMES}, {MATCHED}, {COMPANIES}, {_key_sql('wanted', 'supplier_clean', 'sk', True)}, {_key_sql('companies', 'company_name', 'rk', False)}, fo AS (SELECT ch_row, former_1 FROM companies WHERE former_1 <> ''), {_key_sql('fo', 'former_1', 'fk', False)}, mm AS (SELECT * FROM ({"WITH " + _pref.strip()})) SELECT supplier_clean, count(*) AS n_candidates, '["' || string_agg(company_number, '","' ORDER BY rank) || '","NONE"]' AS choices FROM mm WHERE outcome = 'candidate' GROUP BY 1""")
def choice_requests(spark, d):
    wanted, companies = select(spark, d, "wanted", NAMES, MATCHED), select(spark, d, "companies", COMPANIES)
    found = R.decide_exact(R.exact_matches(wanted, R.registry(companies), R.aliases(companies, ["former_1"]))).filter("outcome = 'candidate'")
    return Q.choice_requests(found).select("supplier_clean", F.col("n_candidates").cast("long").alias("n_candidates"), F.get_json_object("line", "$.request.generationConfig.responseSchema.properties.company_number.enum").alias("choices"))


RESPONSES = """replies AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '{"key":"K' || CAST(conv_id AS VARCHAR(10)) || '","response":{"candidates":[{"content":{"parts":[{"text":"{\\"TAXONOMY_CODE\\": \\"12\\", \\"RESOLUTION_STATUS\\": \\"CONFIDENT\\"}"}]}}]}}'
  WHEN 1 THEN '{"custom_id":"C' || CAST(conv_id AS VARCHAR(10)) || '","response":{"candidates":[{"content":{"parts":[{"text":"not json"}]}}]}}' WHEN 2 THEN 'garbage' ELSE '{"id":"I' || CAST(conv_id AS VARCHAR(10)) || '","response":{"candidates":[]}}' END AS value FROM conversations)"""


@register("SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'K' || conv_id WHEN 1 THEN 'C' || conv_id WHEN 3 THEN 'I' || conv_id END AS key, CASE turn % 4 WHEN 0 THEN '12' END AS \"TAXONOMY_CODE\", CASE turn % 4 WHEN 0 THEN 'CONFIDENT' END AS \"RESOLUTION_STATUS\", CASE turn % 4 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'no_key' WHEN 3 THEN 'no_text' END AS error FROM conversations")
def parse_answers(spark, d):
    return Q.parse_answers(select(spark, d, "replies", RESPONSES.replace("\\", "\\\\")), ["TAXONOMY_CODE", "RESOLUTION_STATUS"])


# ---- diagnostics ---------------------------------------------------------------------------------------------------

SPENT = "spent AS (SELECT CAST(p_partkey AS VARCHAR(10)) AS supplier_clean, CAST(p_retailprice * (10 + p_partkey % 90) AS DECIMAL(18,2)) AS amount FROM part WHERE p_partkey % 6 <> 0)"
PROBED = """probed AS (SELECT CAST(p_partkey AS VARCHAR(10)) AS supplier_clean, lpad(CAST(p_partkey AS VARCHAR(8)), 8, '0') AS company_number, 1 + p_size % 2 AS rank, p_name AS extra, p_partkey AS id,
  CASE p_partkey % 4 WHEN 0 THEN 'clean' WHEN 1 THEN 'head_modifier' WHEN 2 THEN 'loose' ELSE 'weak' END AS match_tier, CASE p_partkey % 3 WHEN 0 THEN 'plural_stem' WHEN 1 THEN 'block_miss' ELSE 'other' END AS primary_category FROM part)"""
PRODUCTION = "production AS (SELECT supplier_clean, CASE WHEN id % 5 = 0 THEN 'none' ELSE company_number END AS company_number FROM probed WHERE id % 2 = 0)"
_best = "best AS (SELECT p.*, amount FROM probed p LEFT JOIN spent USING (supplier_clean) WHERE rank = 1)"


def probed(spark, d):
    return select(spark, d, "probed", PROBED).withColumns({f"cat_{f}": F.col("id") % n == 0 for n, f in enumerate(G.FLAGS, 2)})


def spent(spark, d):
    return select(spark, d, "spent", SPENT)


@register(f"WITH {SPENT}, {PROBED} SELECT supplier_clean, CAST(amount AS DOUBLE) AS amount, coalesce(amount >= 60000, FALSE) AS large FROM probed JOIN spent USING (supplier_clean) WHERE amount >= 50000")
def money_first(spark, d):
    return G.money_first(probed(spark, d).select("supplier_clean"), spent(spark, d), 50_000, 60_000).withColumn("amount", F.col("amount").cast("double"))


@register(f"WITH {PROBED}, {PRODUCTION} SELECT supplier_clean, company_number, NOT EXISTS (SELECT 1 FROM production q WHERE q.supplier_clean = p.supplier_clean AND q.company_number = p.company_number) AS new_vs_production FROM probed p")
def new_vs_production(spark, d):
    return G.new_vs_production(probed(spark, d).select("supplier_clean", "company_number"), select(spark, d, "production", PROBED, PRODUCTION))


@register(f"WITH {SPENT}, {PROBED}, {_best} SELECT match_tier, count(*) AS suppliers, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount, count(*) FILTER (WHERE amount >= 60000) AS large, match_tier IN ('clean', 'head_modifier') AS plausible FROM best GROUP BY match_tier")
def tier_summary(spark, d):
    return G.tier_summary(probed(spark, d), spent(spark, d), 60_000)


@register(f"""WITH {SPENT}, {PROBED}, {_best}, k AS (SELECT * FROM best WHERE match_tier IN ('clean', 'head_modifier')), r AS (SELECT 'category' AS kind, primary_category AS name, amount FROM k{"".join(f" UNION ALL SELECT 'flag', '{f}', amount FROM k WHERE id % {n} = 0" for n, f in enumerate(G.FLAGS, 2))})
 SELECT kind, name, count(*) AS pairs, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount FROM r GROUP BY 1, 2""")
def family_summary(spark, d):
    return G.family_summary(probed(spark, d), spent(spark, d))


@register(f"WITH {SPENT}, {PROBED}, {_best}, t AS (SELECT unnest(string_split(extra, ' ')) AS token, amount FROM best) SELECT token, count(*) AS pairs, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS amount FROM t GROUP BY 1 ORDER BY pairs DESC, token LIMIT 30")
def one_sided_tokens(spark, d):
    return G.one_sided_tokens(probed(spark, d).withColumn("extra", F.split("extra", " ")), "extra", spent(spark, d))


VERDICTS = "verdicts AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN 'Y' ELSE 'N' END AS label, CASE p_size % 5 WHEN 0 THEN 'FIXED' WHEN 1 THEN 'TOP' WHEN 2 THEN 'PRESENT' WHEN 3 THEN 'ABSENT' ELSE 'UNKNOWN' END AS verdict, CASE p_size % 4 WHEN 0 THEN 'FIXED' ELSE 'ABSENT' END AS earlier FROM part)"


@register(f"""WITH {VERDICTS}, c AS (SELECT label, count(*) AS rows, {", ".join(f"count(*) FILTER (WHERE verdict = '{v}') AS {v.lower()}" for v in ("FIXED", "TOP", "PRESENT", "ABSENT", "UNKNOWN"))} FROM verdicts GROUP BY 1) SELECT *, round((fixed + top) / nullif(rows - unknown, 0), 4) AS fixed_rate FROM c""")
def verdict_summary(spark, d):
    return G.verdict_summary(select(spark, d, "verdicts", VERDICTS))


@register(f"WITH {VERDICTS}, n AS (SELECT count(*) FILTER (WHERE earlier IN ('FIXED', 'TOP')) AS before, count(*) FILTER (WHERE verdict IN ('FIXED', 'TOP')) AS after FROM verdicts WHERE label = 'N') SELECT *, after - before AS delta FROM n")
def verdict_delta(spark, d):
    v = select(spark, d, "verdicts", VERDICTS)
    return G.verdict_delta(v.select("label", F.col("earlier").alias("verdict")), v)


@register(f"WITH {LABELS}, {PROBED}, {PRODUCTION} SELECT supplier_clean, label, note, company_number FROM labelled l WHERE label = 'Y' AND NOT EXISTS (SELECT 1 FROM production p WHERE p.supplier_clean = l.supplier_clean AND lpad(p.company_number, 8, '0') = l.company_number) AND NOT EXISTS (SELECT 1 FROM probed p WHERE id % 2 = 1 AND p.supplier_clean = l.supplier_clean AND lpad(p.company_number, 8, '0') = l.company_number)")
def label_regressions(spark, d):
    found = select(spark, d, "production", PROBED, PRODUCTION)
    return G.regressions(select(spark, d, "labelled", LABELS), found, select(spark, d, "probed", PROBED).filter("id % 2 = 1"))


@register("WITH h AS (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) SELECT count(*) AS suppliers, count(*) FILTER (WHERE n >= 5) AS at_cap, round(100.0 * count(*) FILTER (WHERE n >= 5) / count(*), 1) AS pct FROM h")
def homonym_share(spark, d):
    views(spark, d)
    return G.homonym_share(spark.table("supplier").select(F.col("s_nationkey").alias("supplier_clean")))


LISTED = "listed AS (SELECT n.n_name AS borough, 'f' || CAST(c.c_custkey % 20 AS VARCHAR(3)) AS file, max(c.c_custkey) AS k FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name, c.c_custkey % 20)"
FATES = "fates AS (SELECT borough, file, CASE row_idx % 5 WHEN 0 THEN 'bad_date' WHEN 1 THEN 'bad_amount' WHEN 2 THEN 'bad_supplier' ELSE 'ok' END AS fate FROM rows_in WHERE row_idx % 3 <> 0)"
_way = "CASE WHEN k % 7 = 0 THEN NULL WHEN k % 3 = 0 THEN 'FILE' WHEN k % 3 = 1 THEN 'HEADER' ELSE 'FALLBACK' END"


@register(f"""WITH {ROWS}, {LISTED}, {FATES}, f AS (SELECT *, {_way} AS way FROM listed), j AS (SELECT f.borough, f.file, way, count(fate) AS n, {", ".join(f"count(*) FILTER (WHERE fate = '{v}') AS n{i}" for i, v in enumerate(("ok", "bad_date", "bad_amount", "bad_supplier")))} FROM f LEFT JOIN fates t ON f.borough = t.borough AND f.file = t.file GROUP BY 1, 2, 3)
 SELECT borough, count(*) AS files, count(*) FILTER (WHERE way = 'FILE') AS matched_by_file, count(*) FILTER (WHERE way = 'HEADER') AS matched_by_header, count(*) FILTER (WHERE way = 'FALLBACK') AS fallback_used, count(*) FILTER (WHERE way IS NULL) AS files_skipped, count(*) FILTER (WHERE way IS NOT NULL AND n = 0) AS empty_files,
 {", ".join(f"CAST(coalesce(sum(n{i}) FILTER (WHERE way IS NOT NULL), 0) AS BIGINT) AS {c}" for i, c in enumerate(("rows_written", "bad_dates", "bad_amounts", "bad_suppliers")))} FROM j GROUP BY 1""")
def run_stats(spark, d):
    listed = select(spark, d, "listed", LISTED)
    chosen = listed.withColumn("match_type", F.expr(_way)).filter("match_type is not null")
    return G.run_stats(listed, chosen, select(spark, d, "fates", ROWS, FATES))


@register("SELECT coalesce(CASE turn % 4 WHEN 1 THEN 'bad_json' WHEN 2 THEN 'no_key' WHEN 3 THEN 'no_text' ELSE 'CONFIDENT' END, '(none)') AS status, count(*) AS answers, count(DISTINCT CASE turn % 4 WHEN 0 THEN '12' END) AS distinct_values FROM conversations GROUP BY 1")
def answer_summary(spark, d):
    return Q.answer_summary(parse_answers(spark, d), "RESOLUTION_STATUS", "TAXONOMY_CODE")


@register(f"""WITH {NAMES}, {MATCHED}, {COMPANIES}, {_key_sql('wanted', 'supplier_clean', 'sk', True)}, {_key_sql('companies', 'company_name', 'rk', False)}, fo AS (SELECT ch_row, former_1 FROM companies WHERE former_1 <> ''), {_key_sql('fo', 'former_1', 'fk', False)}, mm AS (SELECT * FROM ({"WITH " + _pref.strip()})), per AS (SELECT supplier_clean, min(outcome) AS outcome, min(match_basis) AS match_basis FROM mm GROUP BY 1) SELECT outcome, match_basis, count(*) AS suppliers, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM per GROUP BY 1, 2""")
def match_report(spark, d):
    return R.match_report(exact_matches(spark, d))


#: A log of jobs, one an order: some polled to an end, some open, some polled after it, some never submitted.
JOB_EVENTS = """job_events AS (SELECT 'job-' || CAST(o_orderkey AS VARCHAR(12)) AS job_name, CAST(n AS BIGINT) AS seq, o_orderdate + n * INTERVAL '5' MINUTE AS told_at, CASE n WHEN 1 THEN CASE WHEN o_orderkey % 13 = 0 THEN 'polled' ELSE 'submitted' END WHEN 5 THEN 'downloaded' ELSE 'polled' END AS kind,
  CAST(o_orderkey AS BIGINT) AS index, 'batch_' || CAST(o_orderkey AS VARCHAR(12)) || '.jsonl' AS input_file,
  CASE WHEN n = 3 AND o_orderkey % 4 = 1 THEN 'JOB_STATE_FAILED' WHEN n = 3 AND o_orderkey % 4 = 2 THEN 'JobState.JOB_STATE_SUCCEEDED' WHEN n = 4 AND o_orderkey % 4 > 0 THEN 'JOB_STATE_PARTIALLY_SUCCEEDED' WHEN n IN (2, 3, 4) THEN 'JOB_STATE_RUNNING' END AS state,
  CASE WHEN n = 5 THEN 'r' || CAST(o_orderkey AS VARCHAR(12)) END AS result_file FROM orders, (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) k)"""


@register(f"""WITH {JOB_EVENTS}, e AS (SELECT *, replace(replace(state, 'JobState.', ''), 'JOB_STATE_', '') AS s FROM job_events), b AS (SELECT job_name, min(seq) AS n0, arg_min(index, seq) AS index, arg_min(input_file, seq) AS input_file, arg_min(told_at, seq) AS submitted_at FROM e WHERE kind = 'submitted' GROUP BY 1),
 f AS (SELECT e.job_name, min(seq) AS n1, arg_min(s, seq) AS s, arg_min(told_at, seq) AS completed_at FROM e JOIN b USING (job_name) WHERE kind = 'polled' AND seq > n0 AND s IN ('SUCCEEDED', 'PARTIALLY_SUCCEEDED', 'FAILED', 'CANCELLED', 'EXPIRED') GROUP BY 1),
 l AS (SELECT e.job_name, arg_max(s, seq) AS s FROM e JOIN b USING (job_name) WHERE kind = 'polled' AND seq > n0 GROUP BY 1), r AS (SELECT e.job_name, arg_min(result_file, seq) AS result_file FROM e JOIN f USING (job_name) WHERE kind = 'downloaded' AND seq > n1 AND f.s IN ('SUCCEEDED', 'PARTIALLY_SUCCEEDED') GROUP BY 1)
 SELECT b.job_name, b.index, b.input_file, coalesce(f.s, l.s, 'SUBMITTED') AS state, submitted_at, completed_at, result_file FROM b LEFT JOIN f USING (job_name) LEFT JOIN l USING (job_name) LEFT JOIN r USING (job_name)""")
def job_manifest(spark, d):
    return J.job_manifest(select(spark, d, "job_events", JOB_EVENTS).withColumn("told_at", F.col("told_at").cast("timestamp")))


@register()
def job_stream(spark, d):
    """The same log landed in three lots and followed as a stream, started twice on one checkpoint."""
    top = f"{scratch_dir(spark)}/jobs-{uuid.uuid4().hex}"
    events = select(spark, d, "job_events", JOB_EVENTS).withColumn("told_at", F.col("told_at").cast("timestamp"))
    for lots in (((1, 2), (3, 3)), ((4, 5),)):
        for low, high in lots:
            events.filter(F.col("seq").between(low, high)).write.mode("append").parquet(f"{top}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{top}/events")
        J.follow_jobs(stream, f"{top}/manifest", f"{top}/checkpoint").awaitTermination()
    return J.current_jobs(spark.read.option("recursiveFileLookup", "true").schema(J.MANIFEST + ", batch long").parquet(f"{top}/manifest"))


@register()
def cascade_report(spark, d):
    """Suppliers by outcome and basis of the whole cascade: exact, former names, fuzzy, initials and none."""
    return R.match_report(match_suppliers(spark, d))


@register("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    from .streaming.ingest import windowed_counts

    views(spark, d)
    return windowed_counts(spark.table("events"))


@register("SELECT event_id, CAST(regexp_extract(props, '\"k\"\\s*:\\s*(-?\\d+)', 1) AS BIGINT) AS k FROM events")
def event_properties(spark, d):
    views(spark, d)
    return spark.table("events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


# ---- selections, orders, logs --------------------------------------------------------------------------------------


@register(f"WITH {ROWS} SELECT borough, file, row_idx FROM rows_in WHERE (contains(lower(borough), 'ion_1') OR contains(lower(borough), '_7')) AND (contains(file, '1') OR contains(file, '7'))")
def name_filters(spark, d):
    return P.named(select(spark, d, "rows_in", ROWS), ["ION_1", "_7"], ["1", "7"]).select("borough", "file", "row_idx")


YEARS = "years AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN ' ' || CAST(year(o_orderdate) AS VARCHAR(4)) ELSE CAST(year(o_orderdate) AS VARCHAR(4)) END AS year FROM orders)"


@register(f"WITH {YEARS} SELECT k, TRY_CAST(trim(year) AS DOUBLE) AS year FROM years WHERE TRY_CAST(trim(year) AS DOUBLE) >= 1995")
def since_year(spark, d):
    return P.since(select(spark, d, "years", YEARS), 1995)


@register(f"WITH {ROWS} SELECT borough, file, row_idx FROM rows_in WHERE b IN (SELECT b FROM rows_in WHERE k % 2 = 0 AND b < 'F')")
def business_rows(spark, d):
    r = select(spark, d, "rows_in", ROWS).withColumn("supplier_clean", F.col("b"))
    typed = r.select("supplier_clean", F.when(F.expr("k % 2 = 0 AND b < 'F'"), "Business").otherwise("Redacted").alias("type"))
    return P.businesses(r, typed).select("borough", "file", "row_idx")


@register(f"WITH {ROWS} SELECT row_number() OVER (ORDER BY lower(borough), lower(file), row_idx) AS place, borough, file AS source_file, row_idx FROM rows_in")
def fact_places(spark, d):
    from .plans.ranking import global_rank

    r = select(spark, d, "rows_in", ROWS).select("borough", F.col("file").alias("source_file"), "row_idx")
    return global_rank(r, [*P.fact_order(), F.col("row_idx")], "place")


LISTING = f"listing AS (SELECT borough, '' AS folder, CASE WHEN n = 0 THEN 'AMOD_' ELSE '' END || file AS file, file AS name, n FROM (SELECT DISTINCT borough, file FROM rows_in) t, (SELECT 0 AS n UNION ALL SELECT 1 AS n) u WHERE n = 1 OR file LIKE 'f1%')"


@register(f"""WITH {ROWS}, {LISTING}, c AS (SELECT * FROM listing l WHERE n = 0 OR file NOT LIKE 'f1%'), x AS (SELECT *, CASE WHEN k % 7 = 3 THEN 'Payment_Date|Supplier|Net' ELSE a || '|' || b END AS t FROM rows_in),
 f AS (SELECT borough, file, arg_min(t, row_idx) AS first_row, arg_min(t, row_idx) FILTER (WHERE k % 7 = 3) AS found_row FROM x GROUP BY 1, 2),
 h AS (SELECT c.borough, c.file, n = 0 AS canonical, coalesce(CASE WHEN n = 0 THEN first_row ELSE found_row END, '<< no header detected >>') AS header FROM c JOIN f ON c.borough = f.borough AND c.name = f.file)
 SELECT borough, canonical, header, string_agg(file, ',' ORDER BY file) AS files, CAST(count(*) AS INT) AS num_files, CAST(len(string_split(header, '|')) AS INT) AS num_columns FROM h GROUP BY 1, 2, 3""")
def header_index(spark, d):
    listing = select(spark, d, "listing", ROWS, LISTING)
    r = select(spark, d, "rows_in", ROWS).withColumn("cells", F.when(F.col("k") % 7 == 3, F.array(F.lit("Payment_Date"), F.lit("Supplier"), F.lit("Net"))).otherwise(F.array("a", "b", F.lit(" "))))
    rows = r.withColumnRenamed("file", "name").join(listing.select("borough", "file", "name"), ["borough", "name"]).select("borough", "file", "row_idx", "cells")
    found = P.header_index(P.canonical_files(listing.select("borough", "folder", "file")), rows, within=1 << 40)
    return found.select("borough", "canonical", F.array_join("header", "|").alias("header"), F.array_join("files", ",").alias("files"), "num_files", "num_columns")


ERRORS = "errors AS (SELECT '2024-01-01T00:00:00' AS timestamp, b AS borough, 'x/' || file || CASE k % 3 WHEN 0 THEN '.CSV' WHEN 1 THEN '.xlsx' ELSE '' END AS path, CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k AS BIGINT) * 256 END AS size, CASE WHEN k % 2 = 0 THEN 'No header' ELSE 'Unreadable' END AS error, a AS detail FROM rows_in)"


@register(f"""WITH {ROWS}, {ERRORS} SELECT timestamp, borough, substring(path, 3) AS filename, CASE WHEN contains(path, '.') THEN '.' || lower(string_split(path, '.')[2]) ELSE '' END AS ext,
 CASE WHEN size IS NULL THEN '?' WHEN size > 1048576 THEN printf('%.1f', size / 1048576.0) || 'MB' WHEN size > 1024 THEN printf('%.1f', size / 1024.0) || 'KB' ELSE CAST(size AS VARCHAR) || 'B' END AS size, error, detail FROM errors""")
def error_log(spark, d):
    return P.error_log(select(spark, d, "errors", ROWS, ERRORS))


@register(f"WITH {ROWS}, {ERRORS} SELECT borough, error, count(*) AS errors, count(DISTINCT path) AS files FROM errors GROUP BY 1, 2")
def error_summary(spark, d):
    return P.error_summary(P.error_log(select(spark, d, "errors", ROWS, ERRORS)))


@register(f"WITH {ROWS}, {FATES.replace('SELECT borough, file,', 'SELECT borough, file, row_idx,')} SELECT borough, file, fate, min(row_idx) AS first_row, count(*) AS rows FROM fates WHERE fate <> 'ok' GROUP BY 1, 2, 3")
def first_errors(spark, d):
    return P.first_errors(select(spark, d, "fates", ROWS, FATES.replace("SELECT borough, file,", "SELECT borough, file, row_idx,")))


KEYED = """answered AS (SELECT o_orderkey AS line_no, 'SUP_' || CAST(o_custkey AS VARCHAR(10)) AS key, o_orderstatus AS subtype, o_orderpriority AS status FROM orders),
 keyed AS (SELECT c_custkey AS line_no, 'SUP_' || CAST(c_custkey AS VARCHAR(10)) AS supplier_id, 'Firm ' || CAST(c_custkey % 40 AS VARCHAR(10)) AS supplier_clean FROM customer)"""


@register(f"WITH {KEYED}, l AS (SELECT key, arg_max(subtype, line_no) AS subtype, arg_max(status, line_no) AS status, min(line_no) AS f FROM answered GROUP BY 1) SELECT supplier_clean, arg_max(subtype, f) AS subtype, arg_max(status, f) AS status FROM l JOIN keyed ON key = supplier_id GROUP BY 1")
def named_answers(spark, d):
    answered, keyed = select(spark, d, "answered", KEYED), select(spark, d, "keyed", KEYED)
    return P.named_answers(answered, keyed, ["subtype", "status"])


@register("SELECT s_nationkey AS supplier_clean, count(*) AS candidates, count(*) >= 5 AS at_cap FROM supplier GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def most_collided(spark, d):
    views(spark, d)
    return P.most_collided(spark.table("supplier").select(F.col("s_nationkey").alias("supplier_clean")))


CHOICES = "choices AS (SELECT CASE p_size % 4 WHEN 0 THEN ' none' WHEN 1 THEN '' ELSE CAST(p_partkey AS VARCHAR(10)) END AS company_number, CASE p_partkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'MEDIUM ' WHEN 2 THEN 'Low' ELSE '?' END AS confidence, CASE WHEN p_partkey % 9 = 0 THEN 'bad_json' END AS error FROM part)"


@register(f"""WITH {CHOICES}, c AS (SELECT upper(trim(company_number)) AS n, upper(trim(confidence)) AS l, error IS NULL AS s FROM choices) SELECT count(*) AS total, count(*) FILTER (WHERE s AND n NOT IN ('', 'NONE')) AS resolved, count(*) FILTER (WHERE s AND n IN ('', 'NONE')) AS none,
 count(*) FILTER (WHERE NOT s) AS errors, count(*) FILTER (WHERE s AND l = 'HIGH') AS high, count(*) FILTER (WHERE s AND l = 'MEDIUM') AS medium, count(*) FILTER (WHERE s AND l = 'LOW') AS low FROM c""")
def choice_summary(spark, d):
    return P.choice_summary(select(spark, d, "choices", CHOICES))


TREE = "tree AS (SELECT b || '/' || file || '/' || a AS path, CAST(k AS BIGINT) * 700 AS size FROM rows_in)"
_size = "CASE WHEN size >= 1048576 THEN printf('%.1f', size / 1048576.0) || 'MB' WHEN size >= 1024 THEN printf('%.1f', size / 1024.0) || 'KB' ELSE CAST(size AS VARCHAR) || 'B' END"


@register(f"""WITH {ROWS}, {TREE} SELECT b || '/' || file AS folder, TRUE AS is_file, a AS name, 3 AS depth, repeat('    ', 3) || a || '  (' || {_size} || ')' AS line FROM rows_in JOIN tree ON path = b || '/' || file || '/' || a
 UNION ALL SELECT DISTINCT b || '/' || file, FALSE, file, 2, repeat('    ', 2) || file || '/' FROM rows_in UNION ALL SELECT DISTINCT b, FALSE, b, 1, '    ' || b || '/' FROM rows_in UNION ALL SELECT '', FALSE, '.', 0, './'""")
def directory_tree(spark, d):
    return P.directory_tree(select(spark, d, "tree", ROWS, TREE)).withColumn("folder", F.array_join("folder", "/"))
