"""Batch jobs from submission to result: a log of events becomes the manifest, as a table or as a stream with state.

events(job_name, seq, told_at, kind, index, input_file, state, result_file): ``submitted`` enters a job, ``polled`` tells its state until
one is final, ``downloaded`` names the result of a job that ended with one. Events that fit no state (polls of unknown or
ended jobs, second submissions, results of failed jobs) change nothing. The calls that make events are no part of this.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import values as V

STORE = "spark.sql.streaming.stateStore.providerClass"
MANIFEST = "job_name string, index long, input_file string, state string, submitted_at timestamp, completed_at timestamp, result_file string"


def plain_state(state: Column) -> Column:
    """A state without the names before it."""
    return F.regexp_replace(F.regexp_replace(state, r"^JobState\.", ""), "^JOB_STATE_", "")


def _gathered(events: DataFrame) -> DataFrame:
    """(job_name, x): the events of each job. A job has a few dozen."""
    kinds = F.struct("seq", "told_at", "kind", "index", "input_file", plain_state(F.col("state")).alias("state"), "result_file")
    return events.groupBy("job_name").agg(F.collect_list(kinds).alias("x"))


def _folded(gathered: DataFrame) -> DataFrame:
    """A row a submitted job, by its events in order of seq."""
    none = F.struct(F.lit(None).cast("long").alias("index"), *[F.lit(None).cast(t).alias(n) for n, t in (("input_file", "string"), ("state", "string"), ("submitted_at", "timestamp"), ("completed_at", "timestamp"), ("result_file", "string"))])

    def step(job: Column, x: Column) -> Column:
        known, ended = job["submitted_at"].isNotNull(), job["completed_at"].isNotNull()
        enter = (x["kind"] == "submitted") & ~known
        poll = (x["kind"] == "polled") & known & ~ended
        final = poll & x["state"].isin(V.FINAL_STATES)
        result = (x["kind"] == "downloaded") & job["state"].isin(V.RESULT_STATES) & job["result_file"].isNull()
        pick = lambda c, new, old: F.when(F.coalesce(c, F.lit(False)), new).otherwise(old)
        return F.struct(
            pick(enter, x["index"], job["index"]).alias("index"), pick(enter, x["input_file"], job["input_file"]).alias("input_file"), pick(enter, F.lit("SUBMITTED"), pick(poll, x["state"], job["state"])).alias("state"),
            pick(enter, x["told_at"], job["submitted_at"]).alias("submitted_at"), pick(final, x["told_at"], job["completed_at"]).alias("completed_at"), pick(result, x["result_file"], job["result_file"]).alias("result_file"),
        )

    jobs = gathered.withColumn("j", F.aggregate(F.array_sort("x"), none, step))
    return jobs.filter("j.submitted_at is not null").select("job_name", "j.*")


def job_manifest(events: DataFrame) -> DataFrame:
    """A row a submitted job, folded over its events in order of seq."""
    return _folded(_gathered(events))


def follow_jobs(events: DataFrame, manifest: str, checkpoint: str) -> StreamingQuery:
    """Follow a stream of events; each micro-batch appends the jobs that it changed to ``manifest`` with its number.

    State is one row a job with its events so far, gathered by Spark's own aggregate and held in RocksDB, so it may exceed memory; the fold is
    the table's, whatever the micro-batches events come in.
    """
    spark = events.sparkSession

    def land(df: DataFrame, batch: int) -> None:
        _folded(df).withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{manifest}/{batch}")  # a batch that is run again replaces itself

    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # read when the query starts
    try:
        return _gathered(events).writeStream.outputMode("update").foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def current_jobs(manifest: DataFrame) -> DataFrame:
    """The last row of each job in the appended manifest."""
    names = [c for c in manifest.columns if c not in ("job_name", "batch")]
    return manifest.groupBy("job_name").agg(F.max_by(F.struct(*names), "batch").alias("j")).select("job_name", "j.*")
