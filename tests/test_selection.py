"""Exact medians of groups of any size against Python's."""

import random
import statistics

from pyspark.sql import functions as F

from ledgerloom.operators import selection


def test_group_stats(spark):
    r = random.Random(6)
    draw = [lambda: r.randint(-5, 5), lambda: round(r.lognormvariate(3, 4), 2), lambda: r.choice([1.5, 1.5, 2.5]), lambda: -(10.0 ** r.randint(-300, 300)), lambda: 7.0]
    rows = [(k, None if k == "k2" else "z", float(draw[i % 5]())) for i, k in enumerate(["k0", "k1", "k2", "k3", None, "k5", "k6"]) for _ in range([1, 2, 3, 40, 501, 600, 7][i])]
    rows += [("k7", "z", None), ("k8", None, None), ("k8", None, 4.0)] + [("k9", "z", x) for x in (-1.7e308, 1.7e308, 1.0, 2.0) for _ in range(5)]
    df = spark.createDataFrame(rows, "a string, b string, amount double").repartition(4)
    want = {}
    for a, b, x in rows:
        want.setdefault((a, b), []).extend([] if x is None else [x])
    for held in (None, 5):
        got = {(x.a, x.b): x for x in selection.group_stats(df, ["a", "b"], "amount", held).collect()}
        assert set(got) == set(want)
        for k, xs in want.items():
            assert got[k]["_n"] == len(xs)
            m = got[k]["_median"]
            if not xs:
                assert m is None
                continue
            s = sorted(xs)
            assert m == s[(len(s) - 1) // 2] / 2 + s[len(s) // 2] / 2 and (max(map(abs, xs)) > 1e300 or abs(m - statistics.median(xs)) <= 1e-9 * abs(m))


def test_one_key_of_many_rows(spark):
    """Counts move, not rows: the largest shuffle of a round holds the slices of a task."""
    n = 3_000_000
    df = spark.range(n, numPartitions=6).select(F.lit("hot").alias("a"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 100.0).alias("amount"))
    got = selection.group_stats(df, ["a"], "amount").first()
    xs = sorted(r[0] for r in df.select("amount").toPandas().itertuples(index=False))
    assert got["_n"] == n and got["_median"] == (xs[n // 2 - 1] / 2 + xs[n // 2] / 2)
