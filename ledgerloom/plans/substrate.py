"""The driver's tables seen as the engine's inputs, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "conversations"]

#: One row a line item as a spend transaction; keys have nulls, some payees and terms are out of scope.
SPEND = """
spend AS (
  SELECT n.n_name AS borough,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE c.c_mktsegment END AS department,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 13 = 0 THEN 'Control account ' || p.p_type
              WHEN o.o_orderkey % 17 = 0 THEN 'Council tax ' || p.p_type WHEN o.o_orderkey % 19 = 0 THEN 'Fees and charges ' || p.p_type
              WHEN o.o_orderkey % 23 = 0 THEN 'Temporary accommodation' WHEN o.o_orderkey % 29 = 0 THEN 'Land purchase' ELSE p.p_type END AS expense_type,
         p.p_name AS service_area, p.p_brand AS supplier_category,
         CASE WHEN s.s_suppkey % 9 = 0 THEN 'HMRC ' || s.s_name ELSE s.s_name END AS supplier_clean,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l.l_returnflag = 'R' THEN -1 ELSE 1 END AS DECIMAL(18,2)) AS amount,
         o.o_orderdate AS ordered, o.o_orderkey AS orderkey, l.l_linenumber AS linenumber, p.p_partkey AS partkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey)"""

_R2 = "CAST(round(CAST({} AS DECIMAL(28,6)), 2) AS DOUBLE)"
BASE = f"""
base AS (
  SELECT department, expense_type, service_area, supplier_category, supplier_clean, count(amount) AS row_count,
         {_R2.format("sum(amount)")} AS total_amount, {_R2.format("min(amount)")} AS min_amount, {_R2.format("max(amount)")} AS max_amount,
         {_R2.format("avg(amount)")} AS avg_amount, {_R2.format("median(CAST(amount AS DOUBLE))")} AS median_amount
  FROM spend GROUP BY department, expense_type, service_area, supplier_category, supplier_clean)"""

#: Keys with a taxonomy code and level of their own making.
CODED = """
coded AS (
  SELECT b.*, CAST(CASE WHEN length(coalesce(expense_type, '')) % 7 = 0 THEN 250000 + length(service_area) ELSE 100000 + 1000 * (length(coalesce(expense_type, '')) % 40) + CASE WHEN row_count % 5 = 2 THEN 99 ELSE length(service_area) END END AS BIGINT) AS taxonomy_code,
         CASE WHEN length(coalesce(expense_type, '')) % 7 = 0 THEN 'Housing Management' WHEN row_count % 3 = 0 THEN 'Consultancy' WHEN row_count % 4 = 1 THEN CASE WHEN supplier_clean LIKE 'HMRC%' THEN 'Works' ELSE 'Financial Services' END
              WHEN row_count % 11 = 7 THEN NULL ELSE 'Works' END AS "Level 1"
  FROM base b)"""

#: Messy transactions: dates in many forms, amounts with signs and gaps, names with card descriptors.
MESSY = """
messy AS (
  SELECT n.n_name AS borough, 'spend_' || CASE WHEN l.l_orderkey % 5 = 0 THEN 'card_' ELSE '' END || CASE WHEN l.l_orderkey % 3 = 0 THEN 'mar2021' ELSE 'list' END || '.csv' AS file,
         l.l_orderkey AS orderkey, l.l_linenumber AS linenumber,
         CASE l.l_orderkey % 12
           WHEN 0 THEN substr(d, 1, 10) WHEN 1 THEN substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || substr(d, 1, 4) WHEN 2 THEN substr(d, 9, 2) || '.' || substr(d, 6, 2) || '.' || substr(d, 1, 4)
           WHEN 3 THEN substr(d, 9, 2) || '-' || substr(d, 6, 2) || '-' || substr(d, 1, 4) WHEN 4 THEN substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || substr(d, 3, 2)
           WHEN 5 THEN substr(d, 1, 4) || substr(d, 6, 2) || substr(d, 9, 2) WHEN 6 THEN substr(d, 9, 2) || '-Jul-' || substr(d, 1, 4) WHEN 7 THEN substr(d, 9, 2) || ' September ' || substr(d, 3, 2)
           WHEN 8 THEN '45/13/2024' WHEN 9 THEN '31/02/2024' WHEN 10 THEN '45678' ELSE NULL END AS raw_date,
         CASE l.l_orderkey % 7
           WHEN 0 THEN '£' || a WHEN 1 THEN ' ' || a WHEN 2 THEN replace(a, '.', ' ') WHEN 3 THEN '-' WHEN 4 THEN 'abc' WHEN 5 THEN '(' || a || ')' ELSE '1,' || a END AS raw_amount,
         CASE l.l_linenumber % 7
           WHEN 0 THEN 'PAYPAL *' || s WHEN 1 THEN s || ' Ltd and more' WHEN 2 THEN 'stk*' || s WHEN 3 THEN s || ' 123456' WHEN 4 THEN '****' WHEN 5 THEN '7' ELSE s END AS raw_supplier
  FROM (SELECT *, CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS d, CAST(CAST(l_extendedprice % 1000 AS DECIMAL(18,2)) AS VARCHAR(20)) AS a FROM lineitem) l
  JOIN (SELECT s_suppkey, s_nationkey, replace(s_name, '#', ' ') AS s FROM supplier) s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

#: Names of suppliers and a registry with homonyms, single names, pairs of which one is active, and former names.
NAMES = """
names AS (
  SELECT p_partkey AS id,
         CASE p_partkey % 12
           WHEN 0 THEN 'The ' || p_name || ' Limited' WHEN 1 THEN upper(p_name) || ' & Co. LTD' WHEN 2 THEN 'www.' || replace(p_name, ' ', '') || '.co.uk' WHEN 3 THEN 'F. M. ' || p_name
           WHEN 4 THEN 'PAYPAL *' || p_name WHEN 5 THEN 'Solo v' || CAST(CAST(floor(p_partkey / 12) AS INT) AS VARCHAR(9)) || ' Holdings' WHEN 6 THEN 'A.B.C. ' || p_name || ' C.I.C.' WHEN 7 THEN p_name || ' and Sons of ' || p_brand
           WHEN 8 THEN '  ' || p_name || ', PLC' WHEN 9 THEN p_name || '.com' WHEN 10 THEN 'stk*Former x' || CAST(CAST(floor(p_partkey / 12) AS INT) AS VARCHAR(9)) WHEN 11 THEN 'The Firm u' || CAST(CAST(floor(p_partkey / 12) AS INT) AS VARCHAR(9)) || ' Ltd' ELSE p_name END AS name
  FROM part)"""

COMPANIES = """
companies AS (
  SELECT p_partkey AS ch_row, CASE WHEN p_partkey % 12 = 5 THEN 'Solo v' || CAST(CAST(floor(p_partkey / 12) AS INT) AS VARCHAR(9)) || ' Holdings' WHEN p_partkey % 12 IN (8, 11) THEN 'Firm u' || CAST(CAST(floor(p_partkey / 12) AS INT) AS VARCHAR(9)) WHEN p_partkey % 3 = 0 THEN p_name || ' Limited' WHEN p_partkey % 5 = 0 THEN p_name || ' Holdings' WHEN p_partkey % 7 = 0 THEN p_name || ' (Trading)' ELSE p_name || ' ' || p_brand END AS company_name,
         lpad(CAST(p_partkey AS VARCHAR(8)), 8, '0') AS company_number, CASE WHEN p_partkey % 4 = 0 THEN 'Liquidation' ELSE 'Active' END AS status, p_type AS town,
         lpad(CAST(1000 + p_size * 311 AS VARCHAR(5)), 5, '0') || ' - Activity ' || CAST(p_size AS VARCHAR(3)) AS sic_1, CASE WHEN p_partkey % 2 = 0 THEN '62020 - Other' ELSE '' END AS sic_2, '' AS sic_3, '' AS sic_4,
         CASE WHEN p_partkey % 12 = 10 THEN 'Former x' || CAST(CAST(floor(p_partkey / 12) AS INT) AS VARCHAR(9)) WHEN p_partkey % 6 = 0 THEN p_name || ' ' || p_type ELSE '' END AS former_1
  FROM part)"""


def views(spark: SparkSession, sf_dir: str) -> None:
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def select(spark: SparkSession, sf_dir: str, name: str, *ctes: str) -> DataFrame:
    views(spark, sf_dir)
    text = "WITH " + ",".join(ctes) + f" SELECT * FROM {name}"
    return spark.sql(text.replace('"Level 1"', "`Level 1`").replace("VARCHAR(", "VARCHAR("))
