"""Parquet sources and sinks (SRC-1..3, SNK-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.schemas import SENSOR_SCHEMA
from faultline.session import freed_shuffles


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables, e.g. ``events``; columns prune at the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_readings(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: raw readings with the fixed schema (no inference, no repartition).

    A missing path raises ``AnalysisException`` (SRC-3): no custom check.
    """
    return spark.read.schema(SENSOR_SCHEMA).parquet(path)


def load_training_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: the offline training table with ``event_timestamp`` as a UTC
    timestamp (the session zone is pinned to UTC)."""
    df = spark.read.parquet(path)
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "overwrite") -> None:
    """SNK-1: Parquet write.  No ``coalesce(1)``: that would pull the whole
    upstream stage (window included) into a single task."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partition(df: DataFrame, path: str, write_id: str,
                    partition_by: list[str] | tuple = ()) -> None:
    """Idempotent append: rows land in partition ``write_id=<id>`` with
    dynamic partition overwrite, so re-running the same write (a replayed
    micro-batch, a re-run materialisation for the same time) replaces its
    own output instead of duplicating it."""
    with freed_shuffles(df.sparkSession):
        (df.withColumn("write_id", F.lit(write_id))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("write_id", *partition_by).parquet(path))
