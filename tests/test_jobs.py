"""The stream of job events ends where the table's manifest does, which SQL tells."""

import os

import duckdb

from ledgerloom import catalog

SF = "/root/testdata/sf0.001"


def test_stream_equals_manifest(spark):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    names = ["job_name", "index", "input_file", "state", "submitted_at", "completed_at", "result_file"]
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({catalog.oracle_sql()['job_manifest']})").fetchall())
    assert {r[3] for r in want} == {"RUNNING", "FAILED", "SUCCEEDED", "PARTIALLY_SUCCEEDED"} and any(r[6] for r in want)
    for query in ("job_manifest", "job_stream"):
        got = sorted(tuple(r) for r in catalog.queries()[query](spark, SF).select(*names).collect())
        assert got == want, query
