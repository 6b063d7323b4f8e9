import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import reports as P

LINKS = "borough string, pos int, href string, link_text string, raw_text string, file_type string"


def test_publishers(spark):
    links = [("A", 0, "/a.csv", "Amounts paid May 2024", "Amounts paid May 2024", "CSV"), ("A", 1, "/b.pdf", "Amounts paid June 2024", "x", "PDF"), ("A", 2, "/old.csv", "Amounts paid", "old", "CSV"), ("A", 3, "/card.csv", "Card and amounts", "c", "CSV"), ("B", 0, "/q1", "Q1 report", "q", "UNKNOWN"), ("C", 0, "/q1", "Q1 report", "q", "CSV")]
    configs = [("A", 0, "card", "card", None, True, None), ("A", 1, "amounts", "main", "old", True, None), ("B", 0, r"q[1-4]\s+report", "main", None, None, ".csv")]
    got = P.by_publisher(spark.createDataFrame(links, LINKS), spark.createDataFrame(configs, "borough string, place int, pattern string, label string, exclude string, exclude_pdf boolean, force_ext string"))
    assert sorted((r.borough, r.pos, r.label, r.file_type) for r in got.collect()) == [("A", 0, "main", "CSV"), ("A", 3, "card", "CSV"), ("B", 0, "main", "CSV")]


def test_exports(spark):
    links = spark.createDataFrame([(1, 0, "/x", "Home"), (1, 2, "/e2", "Export"), (1, 1, "/e1", " Download ALL"), (2, 0, "/y", "About"), (3, 0, "/z", "as CSV")], "page_id int, pos int, href string, raw_text string")
    assert sorted((r.page_id, r.href, r.file_type) for r in P.portal_export(links).collect()) == [(1, "/e1", "CSV"), (3, "/z", "CSV")]
    assert P.latest_inventory(spark.createDataFrame([("d/inventory_1.xlsx",), ("d/inventory_2.xlsx",), ("d/inventory_3.csv",), ("d/x.xlsx",)], "path string")).first().path == "d/inventory_2.xlsx"
    assert P.latest_inventory(spark.createDataFrame([], "path string")).first().path is None


def test_selections(spark):
    df = spark.createDataFrame([("Tower Hamlets", "a.(1).csv"), ("Barnet", "b.csv"), (None, None)], "borough string, file string")
    assert [r.file for r in P.named(df, ["HAM"]).collect()] == ["a.(1).csv"] and [r.file for r in P.named(df, files=[".(1)"]).collect()] == ["a.(1).csv"] and P.named(df).count() == 3
    assert [r.year for r in P.since(spark.createDataFrame([("2023",), (" 2024 ",), ("x",), (None,)], "year string"), 2024).collect()] == [2024.0]
    assert P.renamed(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        P.renamed(df, ["x"])
    assert P.requested(spark.createDataFrame([("a", "Y"), ("b", " y"), ("c", "N"), ("d", None)], "s string, include_in_batch string")).count() == 2
    tiers = spark.createDataFrame([("a", "head_modifier"), ("b", "clean"), ("c", "weak"), ("d", None)], "s string, match_tier string")
    assert [r.s for r in P.tiers_together(tiers, ["clean", "head_modifier"]).orderBy("tier_place").collect()] == ["b", "a"]


def test_orders(spark):
    df = spark.createDataFrame([("b", 2.0, 1, ["x"], "f"), ("A", None, 2, ["x", "y"], "G"), ("a", 3.0, 1, ["Z"], "a"), ("a", 1.0, 1, ["c"], "B")], "borough string, total_spend double, num_columns int, header array<string>, source_file string").withColumn("supplier", F.col("source_file"))
    at = lambda order: [r.source_file for r in df.orderBy(*order).collect()]
    assert at(P.fact_order()) == ["a", "B", "G", "f"] and at(P.supplier_order()) == ["f", "a", "G", "B"]
    assert at(P.context_order()) == ["a", "f", "B", "G"] and at(P.header_order()) == ["B", "a", "G", "f"]


def test_headers(spark):
    files = spark.createDataFrame([("A", "AMOD_x.csv"), ("A", "x.csv"), ("A", "y.csv"), ("A", "AMOD_e.csv"), ("A", "n.csv"), ("B", "x.csv")], "borough string, file string").withColumn("folder", F.lit(""))
    rows = [("A", "AMOD_x.csv", 0, ["", " "]), ("A", "AMOD_x.csv", 1, ["just", "this", ""]), ("A", "y.csv", 0, ["title", "", ""]), ("A", "y.csv", 1, ["Payment Date", "Supplier", " Net "]), ("A", "n.csv", 0, ["a", "b", "c"]), ("B", "x.csv", 0, ["Date", "Who", "Amount", None])]
    kept = P.canonical_files(files)
    assert sorted(r.file for r in kept.filter("borough = 'A'").collect()) == ["AMOD_e.csv", "AMOD_x.csv", "n.csv", "y.csv"]
    got = {(r.borough, *r.files): (r.header, r.num_columns) for r in P.header_index(kept, spark.createDataFrame(rows, "borough string, file string, row_idx int, cells array<string>")).collect()}
    assert got == {("A", "AMOD_x.csv"): (["just", "this"], 2), ("A", "y.csv"): (["Payment Date", "Supplier", "Net"], 3), ("A", "AMOD_e.csv"): (["<< unreadable or empty >>"], 1), ("A", "n.csv"): (["<< no header detected >>"], 1), ("B", "x.csv"): (["Date", "Who", "Amount"], 3)}


def test_texts(spark):
    got = spark.createDataFrame([(0,), (1023,), (1024,), (5 << 20,), (3 << 40,), (None,)], "n long").select(P.human_size(F.col("n")).alias("s")).collect()
    assert [r.s for r in got] == ["0B", "1023B", "1.0KB", "5.0MB", "3.0TB", None]
    got = spark.createDataFrame([("JOB_STATE_RUNNING",), ("JobState.JOB_STATE_FAILED",), ("x",)], "s string").select(P.job_state(F.col("s")).alias("s")).collect()
    assert [r.s for r in got] == ["RUNNING", "FAILED", "x"]
    tree = P.directory_tree(spark.createDataFrame([("a/y.csv", 10), ("b.csv", None), ("a/c/x.csv", 2048)], "path string, size long"))
    assert [r.line for r in tree.orderBy("folder", "is_file", "name").collect()] == ["./", "    b.csv  (?)", "    a/", "        y.csv  (10B)", "        c/", "            x.csv  (2.0KB)"]
    empty = P.choice_summary(spark.createDataFrame([], "company_number string, confidence string, error string")).first()
    assert (empty.total, empty.resolved, empty.errors) == (0, 0, 0)
