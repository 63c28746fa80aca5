"""The corpus pipeline: language ID, line dedup, near-duplicate removal,
benchmark decontamination and packing.  Each stage works on all rows that the
one before kept, read again from its Parquet output; all but the last return
the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import decontaminate, jaccard_join, language_id, line_dedup, packing, shared

STAGES = [
    ("language_id", language_id.stage),
    ("line_dedup", line_dedup.stage),
    ("jaccard_join", jaccard_join.stage),
    ("decontaminate", decontaminate.stage),
    ("packing", packing.stage),
]

ORACLE_SQL = None  # the stages are not expressible in SQL; tests compare each with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
