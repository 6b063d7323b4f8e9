"""Every query with SQL returns what DuckDB returns on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

from ledgerloom import catalog

SF = "/root/testdata/sf0.001"
#: Tested by themselves, against Python or other queries' SQL (recall_probe: its function on a small registry).
SLOW = {"match_suppliers", "recall_probe", "delimited_scan", "snapshot_replace", "registry_load", "job_stream", "cascade_report"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    v = v.item() if hasattr(v, "item") else v
    return round(v, 6) if isinstance(v, float) else v


def rows(df):
    return Counter(tuple(plain(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, con, name):
    got, want = catalog.queries()[name](spark, SF).toPandas(), con.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - SLOW))
def test_query_without_sql(spark, name):
    assert catalog.queries()[name](spark, SF).count() >= 0
