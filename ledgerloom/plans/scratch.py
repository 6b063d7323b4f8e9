"""Tables that cut lineage, in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set a local session gets one of its own; a cluster must name one."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is not set: scratch tables need a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/ledgerloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that no later plan reads."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()
