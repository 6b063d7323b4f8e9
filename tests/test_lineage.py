"""Encoding damage, registry files with bad lines, people by a gazetteer, lines of dropped rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.functions import text as T
from ledgerloom.operators import matching as R, reports as P, taxonomy as X
from ledgerloom.sources import delimited as D, files as S

SF = "/root/testdata/sf0.001"


def shown(s: str, page: str) -> str:
    """Text whose UTF-8 bytes are read in a code page; bytes that it lacks are shown as Latin-1 does."""
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in s.encode())


def test_repair_encoding(spark):
    table = [("Â£5", "£5"), ("a â\u0080\u0093 b", "a – b"), ("â\u0080\u0094", "—"), ("itâ\u0080\u0099s", "it’s"), ("â\u0080\u0098", "‘"), ("â\u0080\u009c", "“"), ("â\u0080\u009d", "”"), ("CafÃ©", "Café"), ("trÃ¨s", "très"), ("naÃ¯f", "naïf"), ("Ã\u0089", "É"), ("itâ€™s 5â‚¬", "it’s 5€")]
    whole = ["Müller & Söhne – “Ltd” £5", "Ærø’s naïve café €", "plain text", "", "À la carte …", "Ż ółć"]
    for page in ("latin-1", "cp1252"):
        for s in whole:
            one = shown(s, page)
            table += [(one, s), (shown(one, page), s)]
    table += [(s, s) for s in [*whole, "ÃO PAULO", "CAFÉ®", "Â", "São João", "x̂ ☃ 漢字"]] + [(None, None)]
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(table)], "i int, a string").withColumn("b", T.repair_encoding(F.col("a"))).orderBy("i").collect()
    assert [(r.a, r.b) for r in rows] == table


def test_repair_encoding_random(spark):
    r = random.Random(2)
    texts = ["".join(r.choice("abc éèüßñÅø–’“£€ ") for _ in range(30)) for _ in range(300)]
    texts = [t for t in texts if not re.search(T.DAMAGED, t)]  # else what was meant cannot be told
    assert len(texts) > 50
    df = spark.createDataFrame([(t, shown(shown(t, "cp1252"), "cp1252")) for t in texts], "t string, d string").withColumn("m", T.repair_encoding(F.col("d")))
    assert all(x.t == x.m for x in df.collect())


def test_registry_load(spark):
    got = [tuple(r) for r in catalog.queries()["registry_load"](spark, SF).collect()]
    companies = catalog.select(spark, SF, "companies", catalog.COMPANIES).collect()
    fields = ["company_name", "company_number", "status", "town", "sic_1", "sic_2", "former_1"]
    want = []
    for c in companies:
        cells = [c[f] for f in fields]
        if c.ch_row % 10 == 3:
            cells = [*cells[:4], None, None, None]
        bad = c.ch_row % 10 == 7
        want.append((*(x if bad else (x or None) for x in cells), "9 cells of 8" if bad else None))
    key = lambda t: tuple((x is not None, x or "") for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_load_companies_lines_and_errors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿ CompanyName ,CompanyNumber\n"A\nB",1\n\nC,2,3\nD\n')
    columns = {"CompanyName": "company_name", "CompanyNumber": "company_number"}
    good, aside = R.load_companies(D.scan(spark, str(tmp_path)), columns)
    assert sorted((r.ch_row, r.company_name, r.company_number) for r in good.collect()) == [(1, "A\nB", "1"), (4, "D", None)]
    assert [(r.line_no, r.reason, r.cells) for r in aside.collect()] == [(4, "3 cells of 2", ["C", "2", "3"])]
    with pytest.raises(ValueError, match="Town"):
        R.load_companies(D.scan(spark, str(tmp_path)), {"Town": "town"})


def test_blank_lines_are_traced(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b\n1,2\n , \n"x\ny",\n"",\n3,4\n')
    rows = D.scan(spark, str(tmp_path)).filter("row_idx > 0").select("path", "line_no", F.get("cells", F.lit(0)).alias("a"), F.get("cells", F.lit(1)).alias("b"))
    kept, dropped = X.blank_lines(rows)
    assert sorted(r.line_no for r in kept.collect()) == [1, 3, 6] and sorted(r.line_no for r in dropped.collect()) == [2, 5]


def test_canonical_files_are_listed(spark, tmp_path):
    for name, text in {"Camden/AMOD_x.csv": "Payment Date,Amount\n1,2\n", "Camden/x.csv": "junk\n", "Camden/y.csv": "t\nPayment Date,Net,Who\n1,2,x\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    found = S.list_files(spark, str(tmp_path), canonical=True)
    assert {r.file for r in found.select("file").collect()} == {"AMOD_x.csv", "x.csv", "y.csv"}
    listing = P.canonical_files(found.select("borough", F.lit("").alias("folder"), "file"))
    rows = S.read_rows(found).drop("error")
    index = {tuple(r.files): (r.canonical, list(r.header)) for r in P.header_index(listing, rows).collect()}
    assert index == {("AMOD_x.csv",): (True, ["Payment Date", "Amount"]), ("y.csv",): (False, ["Payment Date", "Net", "Who"])}
