"""The training-data pipeline: language ID, near duplicates, repeated substrings, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import jaccard, langid, mixing, packing, suffixes
from ledgerloom.llm.common import materialize

STAGES = [
    ("language_id", langid.language_stage),
    ("jaccard_join", jaccard.near_duplicate_stage),
    ("suffix_dedup", suffixes.suffix_stage),
    ("mixing", mixing.mix_stage),
    ("packing", packing.pack_stage),
]

#: No stage but mixing can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of all documents that the stages keep. Each stage but the last is written and reread; rows with
    nulls, empty and very long texts, repeats and extra columns go through as the stages' docstrings say, an empty table gives no piece."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
