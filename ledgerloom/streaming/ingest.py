"""Incremental ingestion: each landed file once, its rows beside its publisher's other files; event counts by window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import snapshots


def ingest_facts(spark: SparkSession, landing: str, table: str, checkpoint: str, schema: str, clean: Callable[[DataFrame], DataFrame] = lambda df: df, part: str = "source_file") -> StreamingQuery:
    """Files of landing, once each, cleaned and committed to the snapshots of table under their own names. The checkpoint is the
    manifest: a restart goes on where the last run ended. A batch that is run again replaces the same files, so it adds nothing."""
    stream = spark.readStream.schema(schema).option("header", True).csv(landing)
    named = stream.withColumn(part, stream.metadataColumn("_metadata")["file_name"])

    def land(df: DataFrame, _: int) -> None:
        rows = clean(df)
        if rows.head(1):
            snapshots.publish(rows, table, part=part, whole=False)

    return named.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Number and sum of events by type and tumbling window; later ones than ``late`` are not waited for."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))
