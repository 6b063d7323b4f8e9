"""Files read in byte ranges against a plain parser."""

import csv
import io
import random

import pytest

from ledgerloom.sources import delimited as D
from ledgerloom.sources.files import rows_of


def messy(seed: int, delim: str, end: str, rows: int = 120) -> str:
    """Records with quoted delimiters, newlines and doubled quotes, quotes inside of plain fields, blank lines and wide rows."""
    r, out = random.Random(seed), []
    for _ in range(rows):
        cells = []
        for _ in range(r.randint(1, 5)):
            word = "".join(r.choice("abc é1") for _ in range(r.randint(0, 9)))
            kind = r.random()
            if kind < 0.25:
                inner = word + r.choice(["\n", "\r\n", delim, '""', "\n\n" + delim, "\r", ""]) + word
                cells.append(f'"{inner}"' + r.choice(["", "", "x"]))
            else:
                cells.append(word[:4] + r.choice(["", '"', "'"]) + word[4:] if kind < 0.35 and word[:4] else word)
        out.append(delim.join(cells) if r.random() > 0.05 else "")
    return end.join(out) + r.choice(["", end])


@pytest.fixture
def small_ranges(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "499b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("sent", [None, 0])
def test_scan_equals_plain_parser(spark, tmp_path, small_ranges, sent):
    files = {f"f{i}.csv": messy(i, d, e).encode(code) for i, (d, e, code) in enumerate([(",", "\n", "utf-8"), (",", "\r\n", "latin-1"), (";", "\n", "utf-8-sig"), ("\t", "\r\n", "utf-8"), ("|", "\n", "latin-1"), (",", "\r", "utf-8")])}
    files |= {"empty.csv": b"", "blank.csv": b"\n\n", "long.csv": ('a,"' + "line\n" * 400 + '",b\nc,d\n').encode(), "p.pdf": b"%PDF-1.4 x\ny\n", "x.xls": b"\xd0\xcf\x11\xe0abc\n"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got: dict[str, dict] = {}
    for r in D.scan(spark, str(tmp_path), sent).collect():
        got.setdefault(r.path.rsplit("/", 1)[1], {})[r.row_idx] = (r.cells, r.error, r.line_no)
    for name, data in files.items():
        if name in ("p.pdf", "x.xls"):
            assert list(got[name]) == [-1] and got[name][-1][1]
            continue
        want = rows_of(data, "csv")
        assert [got.get(name, {})[i][0] for i in range(len(want))] == want and len(got.get(name, {})) == len(want), name
        text, at = io.StringIO(data.decode("utf-8-sig" if name != "f1.csv" and name != "f4.csv" else "latin-1"), newline=""), []
        reader = csv.reader(text, delimiter={"f2.csv": ";", "f3.csv": "\t", "f4.csv": "|"}.get(name, ","))
        before = 0
        for _ in reader:
            at.append(before)
            before = reader.line_num
        assert [got.get(name, {})[i][2] for i in range(len(want))] == at, name


def test_field_beyond_the_limit(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000b")
    (tmp_path / "big.csv").write_bytes(b'x,y\n"' + b"z\n" * 70_000 + b'",1\n')
    (tmp_path / "fine.csv").write_bytes(b'x,y\n"' + b"z\n" * 50_000 + b'",1\n')
    got = D.scan(spark, str(tmp_path)).collect()
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.path[-8:-4], r.row_idx, r.error is None) for r in got) == [("/big", -1, False), ("fine", 0, True), ("fine", 1, True)]


def test_quoted_after():
    r = random.Random(1)
    for _ in range(3000):
        line = "".join(r.choice('a",,"b') for _ in range(r.randint(0, 12))) + "\n"
        for quoted in (False, True):
            rows = list(csv.reader(io.StringIO(('"' if quoted else "") + line + "Z", newline="")))
            assert D.quoted_after(line.encode(), b",", quoted) == (len(rows) == 1)


def test_delimited_scan_query(spark):
    import zlib

    from ledgerloom import catalog

    sf = "/root/testdata/sf0.001"
    want = sorted((r.doc_id, r.lang, r.source, len(r.text), zlib.crc32(r.text.encode()), 4) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(tuple(r) for r in catalog.queries()["delimited_scan"](spark, sf).collect()) == want
