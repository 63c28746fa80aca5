"""Readings in hour folders: written by the hour of their time, read by the
hours that a window needs (SRC-1, AGG-1, FLT-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from faultline.schemas import ONE_HOUR_MS, SENSOR_SCHEMA
from faultline.sources import files

HOUR = "reading_hour"   # hours since the epoch; a name of its own, the readings keep their columns


def write_hourly(readings: DataFrame, path: str) -> None:
    """Write readings into one folder per hour.  The hours that occur are
    replaced as a whole, so a repeated load of an hour changes nothing; other
    hours stay.  An hour's rows are gathered by a rebalance, which cuts an hour
    of many rows into several tasks and files; files are sorted by time, so that a shorter
    window also skips row groups.  A reading without a time has no hour and is refused."""
    hour = F.coalesce(F.floor(F.col("timestamp_ms") / F.lit(ONE_HOUR_MS)).cast("bigint"),
                      F.raise_error(F.lit("a reading has no timestamp_ms")).cast("bigint"))
    (readings.withColumn(HOUR, hour).hint("rebalance", HOUR).sortWithinPartitions(HOUR, "timestamp_ms")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(HOUR).parquet(path))


def load_hourly(spark: SparkSession, path: str, schema: StructType = SENSOR_SCHEMA) -> DataFrame:
    """All hours, with the column ``reading_hour``; a missing path raises."""
    return spark.read.schema(StructType([*schema.fields, StructField(HOUR, LongType())])).parquet(path)


def hours(spark: SparkSession, path: str) -> list[int]:
    """The hours that have files, in order: folder names, no data is read."""
    prefix = f"{HOUR}="
    names = [n.removeprefix(prefix) for n in files.children(spark, path) if n.startswith(prefix)]
    return sorted(int(n) for n in names if n.lstrip("-").isdigit())


def recent(spark: SparkSession, path: str, window_ms: int = ONE_HOUR_MS, as_of_ms: int | None = None,
           schema: StructType = SENSOR_SCHEMA) -> DataFrame:
    """The readings of the hours that can hold ``(end - window_ms, end]``,
    where ``end`` is ``as_of_ms`` or else lies in the last hour that has files:
    two folders for a window of an hour, however many there are.  Folders left
    empty are passed over.  What the window itself keeps is the caller's
    (``store.latest_window_avg``)."""
    table = load_hourly(spark, path, schema)
    if as_of_ms is not None:
        first, last = (as_of_ms - window_ms + 1) // ONE_HOUR_MS, as_of_ms // ONE_HOUR_MS
    else:
        has_files = (h for h in reversed(hours(spark, path))
                     if any(n.endswith(".parquet") for n in files.children(spark, f"{path.rstrip('/')}/{HOUR}={h}")))
        last = next(has_files, 0)
        first = (last * ONE_HOUR_MS - window_ms + 1) // ONE_HOUR_MS
    return table.where(F.col(HOUR).between(first, last)).drop(HOUR)
