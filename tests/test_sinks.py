"""Batch request files: round trip, names, key maps, failures."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.sources import sinks


def numbered(spark, n, size):
    return spark.range(1, n + 1).select((F.floor((F.col("id") - 1) / size) + 1).cast("long").alias("file_no"), F.col("id").alias("line_no"), F.concat(F.lit("SUP_"), "id").alias("key"), F.to_json(F.struct(F.col("id").alias("n"), F.lit('é"\n').alias("t"))).alias("line"))


def test_round_trip(spark, tmp_path):
    keys = spark.range(1, 8).select(F.concat(F.lit("SUP_"), "id").alias("key"), F.concat(F.lit('Firm, "'), "id").alias("name"))
    sinks.write_requests(numbered(spark, 7, 3), f"file://{tmp_path}/a", "types", keys)
    assert sorted(os.listdir(tmp_path / "a")) == [f"types_{i}{x}" for i in (1, 2, 3) for x in (".jsonl", "_keys.csv")]
    lines = [[json.loads(x)["n"] for x in (tmp_path / f"a/types_{i}.jsonl").read_text().splitlines()] for i in (1, 2, 3)]
    assert lines == [[1, 2, 3], [4, 5, 6], [7]]
    assert list(csv.reader(open(tmp_path / "a/types_2_keys.csv"))) == [["key", "name"], *([f"SUP_{i}", f'Firm, "{i}'] for i in (4, 5, 6))]
    sinks.write_requests(numbered(spark, 5, 9), f"file://{tmp_path}/a", "types", overwrite=True)
    assert os.listdir(tmp_path / "a") == ["types.jsonl"] and len((tmp_path / "a/types.jsonl").read_text().splitlines()) == 5
    with pytest.raises(Exception, match="overwrite"):
        sinks.write_requests(numbered(spark, 5, 9), f"file://{tmp_path}/a", "types")
    assert os.listdir(tmp_path / "a") == ["types.jsonl"]


def test_failed_task_leaves_no_file(spark, tmp_path):
    bad = numbered(spark, 40, 5).withColumn("line", F.when(F.col("line_no") == 33, F.lit(None)).otherwise(F.col("line")))
    with pytest.raises(Exception):  # noqa: B017 - Spark's own kind
        sinks.write_requests(bad, f"file://{tmp_path}/b")
    assert not any(x.is_file() for x in (tmp_path / "b").rglob("*"))


def test_requests_of_the_engine(spark, tmp_path):
    from ledgerloom.operators import requests as Q

    base = catalog.base(spark, "/root/testdata/sf0.001").limit(50)
    lines = Q.taxonomy_requests(base.withColumn("rq_id", F.concat(F.lit("RQ_"), F.monotonically_increasing_id())), "system", size=20)
    sinks.write_requests(lines, f"file://{tmp_path}/c")
    got = [json.loads(x) for i in (1, 2, 3) for x in (tmp_path / f"c/batch_{i}.jsonl").read_text().splitlines()]
    assert len(got) == 50 and len({x["key"] for x in got}) == 50 and all(x["request"]["systemInstruction"]["parts"][0]["text"] == "system" for x in got)
