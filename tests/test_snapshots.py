"""Snapshots: replacement by publisher and by file, failures, conflicts, history."""

import os

import duckdb
import pytest

from ledgerloom import catalog
from ledgerloom.sources import snapshots as S

SF = "/root/testdata/sf0.001"
KIND = "borough string, source_file string, amount int"


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND)


def table(spark, root, version=None):
    return sorted((tuple(r) for r in S.read(spark, root, frame(spark, []).schema, version=version).collect()), key=str)


def test_publish(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    first = [("A", "1.csv", 1), ("A", "2.csv", 2), ("B", "1.csv", 3), ("B", "1.csv", 3), (None, "x y=1.csv", 4)]
    assert table(spark, root) == []
    assert S.publish(frame(spark, first), root) == 1 and table(spark, root) == sorted(first, key=str)
    assert S.publish(frame(spark, [("B", "2.csv", 9)]), root, whole=False) == 2
    second = [*first, ("B", "2.csv", 9)]
    assert table(spark, root) == sorted(second, key=str)
    assert S.publish(frame(spark, [("A", "3.csv", 7), (None, "x y=1.csv", None)]), root) == 3
    third = [r for r in second if r[0] == "B"] + [("A", "3.csv", 7), (None, "x y=1.csv", None)]
    assert table(spark, root) == sorted(third, key=str)
    assert table(spark, root, 1) == sorted(first, key=str) and table(spark, root, 2) == sorted(second, key=str)
    assert {(r.publisher, r.n_before, r.n_after, r.status) for r in S.reconcile(spark, root).collect()} == {("A", 2, 1, "REPLACED"), ("B", 3, 3, "PASS"), (None, 1, 1, "REPLACED")}
    assert S.publish(frame(spark, []), root) == 4 and table(spark, root) == sorted(third, key=str)
    S.expire(spark, root, 1)
    assert table(spark, root) == sorted(third, key=str)
    with pytest.raises(ValueError):
        S.entries(spark, root, 1)


def test_failed_write_leaves_the_table(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    S.publish(frame(spark, [("A", "1.csv", 1)]), root)

    def fail(_):
        raise OSError("disk full")

    with pytest.raises(OSError):
        S.publish(frame(spark, [("A", "1.csv", 2)]), root, hook=fail)
    assert table(spark, root) == [("A", "1.csv", 1)] and len(os.listdir(tmp_path / "t/data")) == 2
    assert len(S.expire(spark, root)) == 1 and table(spark, root) == [("A", "1.csv", 1)]


def test_second_writer_is_refused(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    S.publish(frame(spark, [("A", "1.csv", 1)]), root)
    with pytest.raises(S.Conflict):
        S.publish(frame(spark, [("A", "1.csv", 2)]), root, hook=lambda _: S.publish(frame(spark, [("B", "1.csv", 5)]), root))
    assert table(spark, root) == [("A", "1.csv", 1), ("B", "1.csv", 5)]


def test_snapshot_replace_query(spark):
    """The stored table after a replacement is what the plain replacement's SQL says."""
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    want = sorted(con.sql(catalog.oracle_sql()["incremental_replace"]).fetchall())
    got = sorted(tuple(r) for r in catalog.queries()["snapshot_replace"](spark, SF).select("borough", "orderkey", "linenumber", "amount").collect())
    assert got == want
