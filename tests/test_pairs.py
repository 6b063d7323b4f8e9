"""Scores of many pairs at once against the scorers of one pair, and pairs of rows by tiles."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fuzzy
from ledgerloom.operators import pairs as B


def odd_names(n):
    r = random.Random(6)
    words = ["alpha", "beta", "works", "work", "uk", "a", "é", "漢字", "ltd", "x" * 30]
    made = {" ".join(r.choice(words) for _ in range(r.choice([0, 1, 2, 3, 5, 9]))) for _ in range(n)}
    return sorted(made | {"", "  ", "a  a", " b a", "a\tb", "Supplier#000000001", "Supplier#000000010", "z" * 64, "z" * 65 + "y", "zy" * 50, "nul\0x", "x\0", "x"})


def test_many_scores():
    names = odd_names(40)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(names)), np.arange(len(names))))
    got = fuzzy.many_scores(names, i, j)
    for kind, plain in fuzzy.SCORERS.items():
        assert got[kind].tolist() == [int(plain(names[a], names[b])) for a, b in zip(i.tolist(), j.tolist())], kind


@pytest.mark.parametrize("tile", [4, 512])
def test_scored_pairs(spark, tile):
    r, names = random.Random(3), odd_names(12)
    rows = [(r.choice(["p", "q", None]), r.choice([None, *range(60)]), r.choice([None, *names, names[3], names[3]])) for _ in range(90)]
    got = B.scored_pairs(B.tiles(spark.createDataFrame(rows, "block string, key long, name string"), ["block"], "key", "name", tile)).collect()
    score = lambda kind, x, y: None if x is None or y is None else int(fuzzy.SCORERS[kind](x, y))
    known = [x for x in rows if x[0] is not None and x[1] is not None]
    want = Counter((x, y, *[score(k, x, y) for k in fuzzy.SCORERS]) for a, i, x in known for b, j, y in known if a == b and i < j)
    assert Counter(map(tuple, got)) == want and sum(want.values()) > 400


def test_names_that_all_differ_are_scored_in_tiles(spark, tmp_path):
    """What the scoring step gets grows with tiles, not with pairs of names, and its five scores are one step."""
    from ledgerloom import catalog
    from ledgerloom.plans.substrate import TABLES

    for t in TABLES:
        (tmp_path / f"{t}.parquet").symlink_to(f"/root/testdata/sf0.001/{t}.parquet")
    (tmp_path / "supplier.parquet").unlink()
    spark.range(1100).select(F.col("id").alias("s_suppkey"), F.format_string("Supplier#%09d", "id").alias("s_name"), F.lit(1).alias("s_nationkey"), F.lit(0.0).alias("s_acctbal")).write.parquet(f"{tmp_path}/supplier.parquet")
    found = catalog.fuzzy_scores(spark, str(tmp_path))
    steps = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Arrow" in x and "Scan" not in x]
    assert len(steps) == 1 and "MapInArrow" in steps[0]
    assert B.tiles(spark.read.parquet(f"{tmp_path}/supplier.parquet"), ["s_nationkey"], "s_suppkey", "s_name").count() <= 9
    got = found.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("x", "y").alias("pairs")).first()
    assert got.n == got.pairs == 1100 * 1099 // 2
