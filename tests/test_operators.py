from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.functions import values as V
from ledgerloom.operators import classify as C, conform as O, coverage as L, facts as A, matching as R, suppliers as S, taxonomy as X
from ledgerloom.plans.ranking import global_rank
from ledgerloom.sources import files as S1
from ledgerloom.streaming.ingest import ingest_facts

ROWS = "borough string, file string, row_idx long, cells array<string>"


def cells(df, file="f"):
    return [r.cells for r in df.filter(F.col("file") == file).orderBy("row_idx").collect()]


def rows(spark, borough, data, file="f"):
    return spark.createDataFrame([(borough, file, i, r) for i, r in enumerate(data)], ROWS)


def test_global_rank(spark):
    df = spark.range(1000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(17)))
    got = global_rank(df, [F.col("k"), F.col("id")], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001)) and [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_conform(spark):
    data = [["report"], ["Payment Date", "Vendor Name", "Net Amount"], ["1/1/2024", "x", "5"]]
    assert cells(O.conform(rows(spark, "Croydon", data))) == data[1:]
    assert cells(O.conform(rows(spark, "Elsewhere", data))) == data[1:]
    assert cells(O.conform(rows(spark, "Hounslow", [["", *O.HOUNSLOW], ["", *map(str, range(10))]]))) == [O.HOUNSLOW, [str(i) for i in range(10)]]
    assert cells(O.PUBLISHER_RULES["sutton"](rows(spark, "Sutton", [["Account (T)", "Cat1 (T)", "Amount", "Text"], ["a", "b", "1", "t"]])))[0] == O.SUTTON_NEW
    assert cells(O.PUBLISHER_RULES["greenwich"](rows(spark, "Greenwich", [["x", "1", "1/1/2024", "c", "d"]])))[0] == O.GREENWICH
    assert cells(O.PUBLISHER_RULES["wandsworth"](rows(spark, "Wandsworth", [["Payment Amount", "Supplier", "Payment Amount"], ["d", "s", "1"]])))[0] == ["Payment Date", "Supplier", "Payment Amount"]
    assert cells(O.PUBLISHER_RULES["redbridge"](rows(spark, "Redbridge", [["Period", "Amount", "Supplier"], ["202403", "1", "x"], ["209913", "1", "x"]])))[1:] == [["01/03/2024", "1", "x"], ["209913", "1", "x"]]
    ealing = [["SELECT x"], ["a", "columns"], ["", "", *O.EALING[3][0]], ["", "", *"abcdefghijklm"]]
    assert cells(O.match_variants(rows(spark, "Ealing", ealing), O.EALING)) == [O.EALING[3][0], list("abcdefghijklm")]


def test_tower_hamlets(spark):
    data = [["AMAZON", "01/02/2024", "COMMUNITY EQUIP", "5.50", "EARLY HELP"], ["AMAZON", "03/02/2024", "COMMUNITY EQUIP", "-6", "EARLY HELP"]]
    assert cells(O.tower_hamlets(rows(spark, "Tower Hamlets", data)))[0] == ["MERCHANT NAME", "TRANS DATE", "TRANS CAC DESC 1", "TRANS ORIGINAL NET AMT", "TRANS CAC DESC 2"]
    assert cells(O.tower_hamlets(rows(spark, "Tower Hamlets", [[str(i) for i in range(18)]]))) == [O.TOWER_HAMLETS, [str(i) for i in range(9)]]


def test_mapping(spark):
    sheet = spark.createDataFrame([("Camden", "Date,Net,Who", "a.csv\nb.csv", "--", "Date", "--", None, "Net - Vat", None, None, None, None, "Who")], "Borough string, Header string, `Affected Files` string, do_not_process string, date string, amount string, vat string, amount_formula string, department string, expense_type string, service_area string, supplier_category string, supplier string")
    files = spark.createDataFrame([("Camden", "a.csv", ["Date", "Net", "Who", "Vat"]), ("Camden", "z.csv", ["Date", "Net", "Who"]), ("Camden", "y.csv", ["Payment Date", "Amount", "Supplier", "Supplier Name"])], "borough string, file string, header array<string>")
    chosen = A.choose_mapping(files, A.mapping_rows(sheet)).withColumn("ix", A.column_index(F.col("header"), F.col("mapping"), A.FALLBACK))
    got = {r.file: (r.match_type, r.ix) for r in chosen.collect()}
    assert got["a.csv"] == ("FILE", {"date": 0, "supplier": 2, "lhs": 1, "rhs": 3, "vat": 3})
    assert got["z.csv"][0] == "HEADER" and got["y.csv"] == ("FALLBACK", {"date": 0, "amount": 1, "supplier": 2})


def test_overrides_and_canonical(spark):
    fact = spark.createDataFrame([("Acme & Sons Ltd",), ("ACME AND SON",), ("OLD NAME",), (None,)], "supplier string")
    over = spark.createDataFrame([(1, "old name", "Wrong"), (2, " Old Name ", "New Name")], "pos int, supplier string, supplier_clean string")
    got = {r.supplier: r.supplier_clean for r in S.clean_suppliers(fact, over).collect()}
    assert got["OLD NAME"] == "New Name" and got["Acme & Sons Ltd"] == got["ACME AND SON"] and got[None] is None


def test_person(spark):
    df = spark.createDataFrame([("Mary Jones",), ("Mary Jones Ltd",), ("JD Jones",), ("Ann Lee & Mary Jones",)], "supplier_clean string")
    got = {r.supplier_clean: r.type for r in C.classify(df, given=["mary", "ann"], family=["jones", "lee"]).collect()}
    assert got == {"Mary Jones": "Persons Name", "Mary Jones Ltd": "Business", "JD Jones": "Business", "Ann Lee & Mary Jones": "Persons Name"}


def test_recall_probe_meets_all_rows(spark, monkeypatch):
    """The registered query scores rows far down the registry, of tokens that many rows have."""
    from ledgerloom import catalog

    names = [(i, f"{('alpha', 'beta')[i % 2]} row{i}") for i in range(1, 901)] + [(901, "alpha beta gamma")]
    companies = spark.createDataFrame([(i, n, f"{i:08d}", "Active", "x", "", "", "", "", "") for i, n in names], "ch_row long, company_name string, company_number string, status string, town string, sic_1 string, sic_2 string, sic_3 string, sic_4 string, former_1 string")
    monkeypatch.setattr(catalog, "match_suppliers", lambda s, d: spark.createDataFrame([("Alpha Beta", "no_match")], "supplier_clean string, outcome string"))
    monkeypatch.setattr(catalog, "registry", lambda s, d: R.registry(companies))
    got = catalog.recall_probe(spark, "").filter("rank = 1").collect()
    assert [(r.ch_row, r.token_set) for r in got] == [(901, 100)]
    few = R.recall_probe(spark.createDataFrame([("Alpha Beta",)], "supplier_clean string"), R.registry(companies), block_tokens=1, max_df=10, max_pool=60)
    assert 901 not in {r.ch_row for r in few.collect()}


def test_cascade(spark):
    companies = spark.createDataFrame([(1, "Acme Works Limited", "00000001", "Active", "x", "", "", "", "", ""), (2, "Acme Widgets", "00000002", "Active", "x", "", "", "", "", "Old Widgets"), (3, "Fred Mathew Conway", "00000003", "Active", "x", "", "", "", "", "")], "ch_row long, company_name string, company_number string, status string, town string, sic_1 string, sic_2 string, sic_3 string, sic_4 string, former_1 string")
    wanted = spark.createDataFrame([("ACME WORKS LTD",), ("Old Widgets Ltd",), ("Acme Wurks",), ("F M Conway",), ("Nobody Else",)], "supplier_clean string")
    got = R.match_suppliers(wanted, R.registry(companies), R.aliases(companies, ["former_1"]))
    best = {r.supplier_clean: (r.outcome, r.match_basis, r.company_number) for r in got.filter("rank = 1 or rank is null").collect()}
    assert best["ACME WORKS LTD"] == ("resolved", "exact", "00000001") and best["Old Widgets Ltd"] == ("resolved", "exact_prev", "00000002")
    assert best["Acme Wurks"][:2] == ("candidate", "fuzzy") and best["F M Conway"] == ("candidate", "initialism", "00000003") and best["Nobody Else"][0] == "no_match"


def test_null_keys_match(spark):
    fact = spark.createDataFrame([(None, "a", "b", "c", "d", 1.0)], "department string, expense_type string, service_area string, supplier_category string, supplier_clean string, amount double")
    enriched = spark.createDataFrame([(None, "a", "b", "c", "d", 7), (None, "a", "b", "c", "d", 9)], "department string, expense_type string, service_area string, supplier_category string, supplier_clean string, taxonomy_code int")
    assert [r.taxonomy_code for r in X.enrich_fact(fact, enriched).collect()] == [7]


def test_files(spark, tmp_path):
    for name, data in {"Tower_Hamlets/a.csv": "Date;Amount;Supplier\n1/1/2024;5;é\n".encode("latin-1"), "Camden/AMOD_x.csv": b"x", "Camden/North/b.txt": b"a\tb\n1\t2\n", "Camden/c.pdf": b"%PDF-1.4"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {(r.borough, r.file, r.row_idx): (r.cells, r.error) for r in S1.read_rows(S1.list_files(spark, str(tmp_path))).collect()}
    assert got[("Tower Hamlets", "a.csv", 1)] == (["1/1/2024", "5", "é"], None) and got[("Camden", "b.txt", 0)] == (["a", "b"], None)
    assert got[("Camden", "c.pdf", -1)][1] and len(got) == 5


def test_links(spark):
    html = '<a href="/a.csv">Spend May 2021 (CSV 12 KB)</a><a href="/b.pdf">Spend May 2021</a><A HREF=\'/dl?x\'>Download <b>it</b></A>'
    got = L.links(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).orderBy("pos").collect()
    assert [(r.href, r.link_text, r.file_type) for r in got] == [("/a.csv", "Spend May 2021", "CSV"), ("/b.pdf", "Spend May 2021", "PDF"), ("/dl?x", "Download it", "UNKNOWN")]
    best = L.preferred(spark.createDataFrame(got), [F.col("link_text")]).filter("link_text like 'Spend%'").collect()
    assert [r.href for r in best] == ["/a.csv"]


def test_manifest(spark):
    found = spark.createDataFrame([("a", "/1/a", datetime(2024, 1, 1)), ("a", "/2/a", datetime(2024, 2, 1)), ("b", "/b", datetime(2024, 1, 1))], "name string, path string, mtime timestamp")
    got = {r.name: (r.canonical, r.status) for r in S1.file_manifest(found, spark.createDataFrame([("a",), ("b",), ("c",)], "name string")).collect()}
    assert got == {"a": ("/2/a", "DUPLICATE"), "b": ("/b", "OK"), "c": (None, "MISSING")}


def test_ingest(spark, tmp_path):
    landing, table = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    (landing / "1.csv").write_text("borough,amount\nA,1\nA,2\nB,3\n")
    run = lambda: ingest_facts(spark, str(landing), table, str(tmp_path / "cp"), "borough string, amount int").awaitTermination()
    run()
    (landing / "2.csv").write_text("borough,amount\nB,9\n")
    run()
    run()
    from pyspark.sql.types import _parse_datatype_string

    from ledgerloom.sources import snapshots

    whole = _parse_datatype_string("borough string, amount int, source_file string")
    got = sorted(tuple(r) for r in snapshots.read(spark, table, whole).collect())
    assert got == [("A", 1, "1.csv"), ("A", 2, "1.csv"), ("B", 3, "1.csv"), ("B", 9, "2.csv")]
    assert sorted(snapshots.versions(spark, table)) == [1, 2]


def test_supplier_rules(spark):
    names = {
        "AMZNMKTPLACE": "Amazon Marketplace", "Amzn Mktp UK*2X3": "Amazon Marketplace", "amazon web services EMEA": "Amazon Web Services", "AMAZON.COM SEATTLE": "Amazon.com", "Amazon hub": "Amazon.co.uk",
        "wh  smith euston": "Wh Smith", "TESCO STORES 3021": "Tesco", "ASDA PETROL 11": "Asda Petrol", "Asda": "Asda Supermarket Ltd", "Asdale Ltd": "Asdale Ltd", "MARKS AND SPENCER PLC": "M & S Simply Food",
        "Sainsbury's SACAT": "Sainsburys", "VODAFONE LIMITED": "Vodaphone Ltd", "The coop": "Coop Supermarket", "Acme Limited": "Acme Ltd",
    }
    got = {r.supplier: r.supplier_clean for r in S.clean_suppliers(spark.createDataFrame([(n,) for n in names], "supplier string")).collect()}
    assert {n: v.lower() for n, v in got.items()} == {n: v.lower() for n, v in names.items()}
    assert len(V.EXACT_NAMES) == 20 and len(V.NAME_PATTERNS) == 172


def test_file_rules(spark):
    files = {
        ("Ealing", "July_2022_-_Credit_Card.xlsx"): [["note"], ["Posting Date", "", "Transaction Amount", "Merchant Name", "Description"], ["1/7/22", "", "5", "m", "d"]],
        ("ealing", "june_2022_-_credit_card.xlsx"): [["1/6/22", "5", "m", "d"]],
        ("ealing", "credit_card_spend_april_2024_-_november_2024.xlsx"): [["x"], ["Date", "Merchant Name", "Transaction Amount", "Description"], ["1", "m", "2", "d"]],
        ("Greenwich", "Payments_over_500_Qtr_3_Oct_to_Dec_24_25.xlsx"): [["", ""], ["A", "B", "C"], ["1", "2", "3"]],
        ("Southwark", "Council Spending January 2024.xlsx"): [["h1", "h2"], ["1", "2"]],
        ("Tower_Hamlets", "PCARD-Aug-2025.xlsx"): [["01/08/2025\t5\tx\tShop\ty", "", ""], ["02/08/2025\t6\tx\tShop\ty"]],
    }
    rows = [(b, f, i, c) for (b, f), t in files.items() for i, c in enumerate(t)]
    got = {}
    for r in O.conform(spark.createDataFrame(rows, "borough string, file string, row_idx int, cells array<string>")).orderBy("file", "row_idx").collect():
        assert r.status == "file"
        got.setdefault(r.file, []).append(list(r.cells))
    assert got["July_2022_-_Credit_Card.xlsx"] == files["Ealing", "July_2022_-_Credit_Card.xlsx"][1:]
    assert got["june_2022_-_credit_card.xlsx"] == [V.CARD_HEADER, ["1/6/22", "5", "m", "d"]]
    assert got["credit_card_spend_april_2024_-_november_2024.xlsx"][0] == V.CARD_HEADER_2024
    assert got["Payments_over_500_Qtr_3_Oct_to_Dec_24_25.xlsx"] == [["A", "B", "C"], ["1", "2", "3"]]
    assert got["Council Spending January 2024.xlsx"] == [["h1", "h2"], ["1", "2"]]
    assert got["PCARD-Aug-2025.xlsx"] == [V.TAB_CARD_HEADER, ["01/08/2025", "5", "x", "Shop", "y"], ["02/08/2025", "6", "x", "Shop", "y"]]


def test_headers_without_sheet(spark):
    """Headers of many forms lead to their targets; one publisher's suppliers may be blank under one header."""
    head = ["Paym Acc Date", "£ Spend (Excluding VAT)", "Irrecoverable VAT Amount GBP", "Published Supplier Name", "Organisation", "GL Account Description", "9. Merchant Category", "Payment Reference Number"]
    ix = spark.createDataFrame([(head,)], "header array<string>").select(A.column_index(F.col("header"), F.lit(None).cast("map<string,string>"), V.HEADER_TARGETS).alias("ix")).first().ix
    assert ix == {"date": 0, "amount": 1, "vat": 2, "supplier": 3, "department": 4, "expense_type": 5, "supplier_category": 6, "txn_id": 7}
    rows = [("Ealing", "a.csv", 0, list(V.EALING_EXEMPT_HEADER)), ("Ealing", "a.csv", 1, ["b", "1", "s", "2", "u", "e", "3", "n", "01/02/2024", "7", "10.5", "4", ""])]
    rows += [("Ealing", "b.csv", 0, ["Date", "Net Amount", "Supplier Name"]), ("Ealing", "b.csv", 1, ["01/02/2024", "10.5", ""]), ("Ealing", "b.csv", 2, ["01/02/2024", "10.5", "Firm"])]
    sheet = spark.createDataFrame([], "Borough string, Header string, `Affected Files` string, do_not_process string, " + ", ".join(f"{t} string" for t in A.TARGETS))
    good, bad = A.build_fact(spark.createDataFrame(rows, "borough string, file string, row_idx int, cells array<string>"), A.mapping_rows(sheet), "2024-01-01")
    assert sorted((r.source_file, r.supplier) for r in good.collect()) == [("a.csv", ""), ("b.csv", "Firm")]
    assert [r.source_file for r in bad.collect()] == ["b.csv"]


def test_first_cell_and_blank_column_rules(spark):
    """Southwark: a sign in the first cell of eight becomes Date, a file without header gets one. Merton: a blank first column and what is above the header go."""
    damaged = [["`", *O.SOUTHWARK[1:]], ["1/1/2024", *"abcdefg"]]
    assert cells(O.PUBLISHER_RULES["southwark"](rows(spark, "Southwark", damaged))) == [["Date", *O.SOUTHWARK[1:]], damaged[1]]
    bare = [["1/1/2024", *"abcdefg"], ["2/1/2024", *"hijklmn"]]
    assert cells(O.PUBLISHER_RULES["southwark"](rows(spark, "Southwark", bare))) == [O.SOUTHWARK, *bare]
    narrow = [["`", "b"], ["1", "2"]]
    assert cells(O.PUBLISHER_RULES["southwark"](rows(spark, "Southwark", narrow))) == narrow
    body = [str(i) for i in range(len(O.MERTON))]
    shifted = [["Report", "x"], [" ", *(f" {h.upper()} " for h in O.MERTON)], ["", *body]]
    assert cells(O.PUBLISHER_RULES["merton"](rows(spark, "Merton", shifted))) == [[f" {h.upper()} " for h in O.MERTON], body]
    plain = [O.MERTON, body]
    assert cells(O.PUBLISHER_RULES["merton"](rows(spark, "Merton", plain))) == plain


def test_schema_groups(spark):
    """Districts and labels part groups; examples are of the first file that has rows, ten at most, a file without a header goes."""
    heads = [("Kent", "", "b.csv", ["Type", "type", "X"]), ("Kent", "", "a.csv", ["Type", "type", "X", " "]), ("Kent", "Dover", "a.csv", ["Type", "type", "X"]), ("Kent", "", "c card.csv", ["Type", "type", "X"]), ("Kent", "", "none.csv", ["", None]), ("Kent", "", "z.csv", ["Category Code", "Y"])]
    data = [("Kent", "", "b.csv", i, [f" v{i % 2} ", "w", "x"][: 3 if i else 0]) for i in range(30)] + [("Kent", "Dover", "a.csv", 5, ["", "q"]), ("Kent", "", "none.csv", 0, ["lost"]), ("Kent", "", "z.csv", 1, ["1", "2"])]
    headers = spark.createDataFrame(heads, "borough string, district string, file string, header array<string>")
    rows = spark.createDataFrame(data, "borough string, district string, file string, row_idx long, cells array<string>").repartition(4)
    got = {(r.district, r.label, r.column_count): r for r in O.schema_groups(headers, rows).collect()}
    assert set(got) == {("", "Main", 3), ("Dover", "Main", 3), ("", "Card", 3), ("", "Main", 2)}
    main = got["", "Main", 3]
    assert (main.files, main.example_file, main.file_count) == (["a.csv", "b.csv"], "b.csv", 2) and main.examples == [r[4] for r in data[:10]]
    assert (got["", "Card", 3].examples, got["", "Card", 3].example_file) == ([], "c card.csv") and got["Dover", "Main", 3].examples == [["", "q"]]
    assert main.category_candidates == ["Type", "type"] and got["", "Main", 2].category_candidates == []
    values = {(r.district, r.label, r.column, r.value): r.n for r in O.category_values(headers, rows).collect()}
    assert values == {**{("", "Main", c, v): n for c in ("Type", "type") for v, n in (("v0", 14), ("v1", 15))}, **{("Dover", "Main", c, "(blank)"): 1 for c in ("Type", "type")}}
    assert O.schema_groups(headers.limit(0), rows).count() == 0 and O.category_values(headers, rows.limit(0)).count() == 0
