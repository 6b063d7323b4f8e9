"""Work that must not grow with copies of rows or with the size of one key, against plain Python."""

from statistics import median

from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators import conform as O, pairs as B


def test_pairs_by_kinds_equal_all_pairs(spark):
    rows = [(None if i % 50 == 0 else i % 3, None if i % 7 == 0 else f"k{i % 5}", None if i % 41 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "block int, kind string, key long")
    want = sorted((a[2], b[2], a[1] or "", b[1] or "") for a in rows for b in rows if None not in (a[0], b[0], a[2], b[2]) and a[0] == b[0] and a[2] < b[2])
    for listed in (4, 2048):
        got = B.expand(B.kind_pairs(df, ["block"], "kind", "key", listed)).select("a", "b", F.coalesce("x", F.lit("")), F.coalesce("y", F.lit(""))).collect()
        assert sorted(tuple(r) for r in got) == want, listed


def test_copies_of_a_name_are_not_scored_again(spark):
    names = lambda n: spark.range(n * 10).select((F.col("id") % 10 % 2).alias("block"), F.concat(F.lit("name "), F.col("id") % 10).alias("kind"), F.col("id").alias("key"))
    few, many = (B.kind_pairs(names(n), ["block"], "kind", "key").count() for n in (3, 30))
    assert few == many == 50  # kinds, not rows: 5 by 5 in each of two blocks


def test_edit_distances_are_spread(spark):
    assert catalog.queries()["blocked_edit_distance"](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() > 1


def test_pool_of_common_tokens(spark, monkeypatch):
    """Lists are cut to what can be kept, suppliers of one token are dealt to salts; the pool is that of the plain rule."""
    from ledgerloom.operators import matching as R

    monkeypatch.setattr(R, "ASKED", 3)
    rows = {i: {"common", f"mid{i % 4}", f"own{i}"} for i in range(60)}
    names = {f"s{i}": ["common", f"mid{i % 5}", f"own{i * 7}"][i % 3 :] for i in range(20)} | {"all": ["common"], "none": ["absent"]}
    postings = spark.createDataFrame([(t, i) for i, ts in rows.items() for t in ts], "token string, row long")
    df = {t: sum(t in ts for ts in rows.values()) for ts in rows.values() for t in ts}
    want = []
    for s, tokens in names.items():
        rare = sorted((df[t], t) for t in tokens if t in df)
        used, before = [], 0
        for n, t in [x for i, x in enumerate(rare) if x[0] <= 40 or i == 0][:3]:
            if before < 8:
                used.append(t)
            before += n
        want += [(s, i) for i in sorted(i for i, ts in rows.items() if ts & set(used))[:8]]
    s = spark.createDataFrame(list(names.items()), "supplier_clean string, s_tokens array<string>")
    got = R.candidate_pool(s, postings, R.token_frequency(postings), max_df=40, max_pool=8)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_retrieval_meets_kinds_of_rows(spark):
    """Copies of rows and names, and a token of all rows: ranks as by a join of all postings, and postings of common tokens are not met by unique names."""
    import math

    from ledgerloom.operators import matching as R, retrieval as I

    rows = {i: ["firm", f"u{i}"] if i % 2 else ["hot", f"b{i % 3}", f"g{i % 6}"] for i in range(120)}
    names = {f"n{i}": ["firm", f"u{i}"] for i in range(30)} | {f"c{i}": ["hot", f"b{i % 4}", "firm"][: 1 + i % 3] for i in range(12)}
    df = {}
    for ts in rows.values():
        for t in ts:
            df[t] = df.get(t, 0) + 1
    w = {t: int(math.floor(1000 * math.log(len(rows) / n) + 0.5)) for t, n in df.items()}
    want = []
    for s, tokens in names.items():
        scored = sorted((-sum(w[t] for t in set(tokens) & set(ts)), i) for i, ts in rows.items() if set(tokens) & set(ts))
        want += [(s, i, -x, r + 1) for r, (x, i) in enumerate(scored[:5])]
    table = spark.createDataFrame(list(rows.items()), "row long, tokens array<string>")
    postings = R.token_postings(table, "row", F.col("tokens"))
    s = spark.createDataFrame(list(names.items()), "supplier_clean string, s_tokens array<string>")
    got = I.top_by_tokens(s, postings, R.token_frequency(postings), table).select("supplier_clean", "row", "weight", "rank").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert I._kinds(table, 5).count() < table.count()


def test_stream_folds_late_events_without_python(spark, tmp_path):
    """An event that lands after a later one counts at its place, as in the table; no Python worker holds the state."""
    from ledgerloom.streaming import jobs as J

    schema = "job_name string, seq long, told_at timestamp, kind string, index long, input_file string, state string, result_file string"
    one = "select 'a' job_name, cast({} as bigint) seq, timestamp'2024-01-01' + make_interval(0,0,0,0,0,{}) told_at, '{}' kind, 7L index, 'f' input_file, {} state, cast(null as string) result_file"
    lots = [[(1, "submitted", "null"), (3, "polled", "'JOB_STATE_SUCCEEDED'")], [(2, "polled", "'JobState.JOB_STATE_FAILED'")]]
    store = spark.conf.get(J.STORE, None)
    for lot in lots:
        spark.sql(" union all ".join(one.format(n, n, kind, state) for n, kind, state in lot)).select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in schema.split(", ")]).write.mode("append").parquet(f"{tmp_path}/events")
        query = J.follow_jobs(spark.readStream.schema(schema).parquet(f"{tmp_path}/events"), f"{tmp_path}/manifest", f"{tmp_path}/checkpoint")
        query.awaitTermination()
        assert query.lastProgress is None or "Python" not in query.lastProgress.stateOperators[0].operatorName
    assert spark.conf.get(J.STORE, None) == store
    got = J.current_jobs(spark.read.option("recursiveFileLookup", "true").schema(J.MANIFEST + ", batch long").parquet(f"{tmp_path}/manifest")).collect()
    want = J.job_manifest(spark.read.parquet(f"{tmp_path}/events")).collect()
    assert got == want and want[0].state == "FAILED"


def test_statistics_read_the_fact_once(spark, tmp_path):
    from ledgerloom.operators import requests as Q, selection
    from ledgerloom.plans.ranking import global_rank

    spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("double").alias("amount")).write.parquet(f"{tmp_path}/fact")
    fact = spark.read.parquet(f"{tmp_path}/fact")
    for held in (2, 10_000):
        got = selection.group_stats(fact, ["k"], "amount", held)
        assert not set(got.inputFiles()) & set(fact.inputFiles()), held
        assert {r.k: r._median for r in got.collect()} == {k: float(median(range(k, 100, 7))) for k in range(7)}
    ranked = global_rank(fact, [F.desc("amount")], "n", 3)
    assert ranked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1  # of counts; rows stay where they are
    base = spark.createDataFrame([("RQ_1", " ", None), ("RQ_2", None, "0012 Acme"), ("RQ_3", "x", "")], "rq_id string, department string, supplier_clean string")
    lines = Q.taxonomy_requests(base)
    assert [(r.key, r.line_no) for r in lines.orderBy("line_no").collect()] == [("RQ_2", 1), ("RQ_3", 2)]


def test_context_reads_the_base_once(spark, tmp_path):
    from ledgerloom.operators import suppliers as S

    row = spark.createDataFrame([("s", 2, 10.0, "a", "b", None, "c")], "supplier_clean string, row_count long, total_amount double, service_area string, expense_type string, department string, supplier_category string")
    row.write.parquet(f"{tmp_path}/base")
    base = spark.read.parquet(f"{tmp_path}/base")
    got = S.supplier_context(base)
    assert not set(got.inputFiles()) & set(base.inputFiles())
    assert got.first().context_descriptor == "Service areas: a | Expense types: b | Supplier categories: c | Scale: 2 no_of_transactions, £10"


def test_category_values_rows_stay(spark):
    """Headers worked out from the rows themselves, of unknown size, meet the rows where they are."""
    rows = spark.range(2_000_000).select((F.col("id") % 3).cast("string").alias("borough"), F.lit("").alias("district"), F.lit("spend.csv").alias("file"), F.array((F.col("id") % 5).cast("string"), F.lit(" ")).alias("cells"))
    heads = rows.select("borough", "district", "file").distinct().withColumn("header", F.array(F.lit("Cost Type"), F.lit("Service")))
    out = O.category_values(heads, rows)
    assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    got = out.filter("borough = '1'").collect()
    assert {(r.column, r.value) for r in got} == {("Cost Type", str(i)) for i in range(5)} | {("Service", "(blank)")} and sum(r.n for r in got) == 2 * 666_667
