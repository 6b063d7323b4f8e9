"""A fact table in snapshots: new rows beside the old, a list of what counts, and a pointer that turns.

    <root>/data/batch=<id>/<key>=…/<part>=…/     rows of one replacement, by publisher and source file
    <root>/entries/<id>/                         one row a publisher and source file: batch, rows, place in the order
    <root>/versions/<n>                          a file that names the entries of version n; the largest n is the table

Rows are written first, read back and reconciled with what came in; only then the pointer of the next version is created, which
fails where another writer was first. A write that fails leaves the table as it was, older versions are its backups, and
``expire`` takes away what no kept version names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..plans.scratch import materialize, release

ENTRIES = "publisher string, file string, batch string, rows long"


class Conflict(RuntimeError):
    """Another writer committed the next version first."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions in order."""
    fs, at = _fs(spark, f"{root}/versions")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()) if fs.exists(at) else []


def _entries_of(spark: SparkSession, root: str, version: int) -> str:
    fs, at = _fs(spark, f"{root}/versions/{version}")
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def entries(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(publisher, file, batch, rows) of a version, the current one if none is given."""
    known = versions(spark, root)
    if version is not None and version not in known:
        raise ValueError(f"no version {version}")
    if not known:
        return spark.createDataFrame([], ENTRIES)
    return spark.read.schema(ENTRIES).parquet(f"{root}/entries/{_entries_of(spark, root, known[-1] if version is None else version)}")


def read(spark: SparkSession, root: str, schema: StructType, key: str = "borough", part: str = "source_file", version: int | None = None) -> DataFrame:
    """The rows of a version, columns by schema. Batches are pruned by the entries where Spark sends these to all tasks."""
    names = schema.fieldNames()
    known = entries(spark, root, version)
    if not versions(spark, root):
        return spark.createDataFrame([], schema)
    stored = StructType([f for f in schema if f.name not in (key, part)]).add("batch", "string").add(key, schema[key].dataType).add(part, "string")
    rows = spark.read.schema(stored).parquet(f"{root}/data")
    same = (rows["batch"] == known["batch"]) & rows[key].eqNullSafe(known["publisher"]) & rows[part].eqNullSafe(known["file"])
    return rows.join(known, same, "left_semi").select(*names)


def _commit(spark: SparkSession, root: str, version: int, name: str) -> None:
    """Move the pointer of a version to its place, whole or not at all; a place that is taken refuses it."""
    jvm = spark._jvm
    fs, draft = _fs(spark, f"{root}/versions/_{name}")
    out = fs.create(draft, False)
    out.write(bytearray(name.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(draft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{root}/versions/{version}")), plain)
    except Exception as e:  # noqa: BLE001 - the file system's own kind of refusal
        fs.delete(draft, False)
        raise Conflict(f"version {version} was committed by another writer") from e


def publish(fresh: DataFrame, root: str, key: str = "borough", part: str = "source_file", whole: bool = True, hook=None) -> int:
    """Replace rows of the table by fresh ones and return the new version.

    ``whole``: all files of a publisher that fresh has give way; else only the files that fresh has, so that its other files stay.
    Rows lie sorted by publisher and file, whatever the case. Before the commit rows read back are reconciled with
    those that came in, for each publisher and file; ``hook(batch)`` is called between writing and committing.
    """
    spark = fresh.sparkSession
    known = versions(spark, root)
    before = entries(spark, root)
    batch = uuid.uuid4().hex
    came = materialize(fresh)  # rows of a plan that could change between counting and writing are settled once
    order: list[Column] = [F.lower(key), F.lower(part)]
    where = f"{root}/data/batch={batch}"
    came.repartition(F.col(key), F.col(part)).sortWithinPartitions(*order).write.partitionBy(key, part).parquet(where)
    count = lambda df: df.groupBy(F.col(key).cast("string").alias("publisher"), F.col(part).cast("string").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    back = spark.read.schema(came.schema).parquet(where) if came.head(1) else came.limit(0)
    got, want = materialize(count(back)), count(came)
    wrong = got.alias("g").join(want.alias("w"), F.col("g.publisher").eqNullSafe(F.col("w.publisher")) & F.col("g.file").eqNullSafe(F.col("w.file")), "full").filter(~F.col("g.rows").eqNullSafe(F.col("w.rows"))).head(1)
    if wrong:
        raise RuntimeError(f"batch {batch} holds other rows than came in: {wrong[0]}")
    if hook:
        hook(batch)
    gone = got.select(F.col("publisher").alias("p")).distinct() if whole else got.select(F.col("publisher").alias("p"), F.col("file").alias("f"))
    same = before["publisher"].eqNullSafe(gone["p"]) & (F.lit(True) if whole else before["file"].eqNullSafe(gone["f"]))
    after = before.join(gone, same, "left_anti").unionByName(got.withColumn("batch", F.lit(batch)).select("publisher", "file", "batch", "rows"))
    name = uuid.uuid4().hex
    after.coalesce(1).sortWithinPartitions(F.lower("publisher"), F.lower("file")).write.parquet(f"{root}/entries/{name}")
    version = max(known, default=0) + 1
    _commit(spark, root, version, name)
    return version


def reconcile(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """(publisher, n_before, n_after, diff, status) between a version and the one before it, from their entries alone."""
    known = versions(spark, root)
    at = known[-1] if version is None else version
    older = [v for v in known if v < at]
    rows = lambda df, n: df.groupBy("publisher").agg(F.sum("rows").alias(n), F.array_sort(F.collect_set("batch")).alias(f"b_{n}"))
    a = rows(entries(spark, root, older[-1]) if older else spark.createDataFrame([], ENTRIES), "n_before")
    b = rows(entries(spark, root, at), "n_after")
    both = a.join(b, a["publisher"].eqNullSafe(b["publisher"]), "full").select(F.coalesce(a["publisher"], b["publisher"]).alias("publisher"), F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"), F.col("b_n_before").eqNullSafe(F.col("b_n_after")).alias("same"))
    status = F.when(~F.col("same"), "REPLACED").when(F.col("n_before") == F.col("n_after"), "PASS").otherwise("FAIL")
    return both.select("publisher", "n_before", "n_after", (F.col("n_after") - F.col("n_before")).alias("diff"), status.alias("status"))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Take away versions but the last ``keep`` and what they alone name; batches that no version names (of failed writes) go too."""
    known = versions(spark, root)
    kept = known[-keep:] if keep else []
    used = {r["batch"] for v in kept for r in entries(spark, root, v).select("batch").distinct().collect()}
    fs, at = _fs(spark, f"{root}/data")
    stale = [f"{root}/data/{s.getPath().getName()}" for s in (fs.listStatus(at) if fs.exists(at) else []) if s.getPath().getName().removeprefix("batch=") not in used and s.isDirectory()]
    old = [v for v in known if v not in kept]
    names = [_entries_of(spark, root, v) for v in old]
    release(spark, [f"{root}/versions/{v}" for v in old])
    release(spark, [f"{root}/entries/{n}" for n in names])
    release(spark, list(stale))
    return stale
