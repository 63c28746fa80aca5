"""A table in global order: ranges of rows, sorted inside (SRT-1, SRT-2).

Rows are shuffled once, by sampled range boundaries.  Each range is sorted and
written with its number and every row's index in it, so a row's position is
the number of rows of the ranges before, a table of one row per range, plus
its index.  ``split.global_position`` gives positions without a write and
spreads equal rows; here rows that are equal in every column share a range,
whose sort spills to disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.schemas import TEST_FRACTION

RANGE, INDEX = "__range", "__index"
_INDEX_MASK = (1 << 33) - 1   # the part of monotonically_increasing_id() that counts inside a partition


def write_ordered(df: DataFrame, path: str, order: list[str]) -> None:
    """Write ``df`` in the order of ``order`` (nulls first), ties by a hash of the whole
    row, so that runs over the same rows agree.  Positions are in the files: a
    task that runs again after a lost executor replaces its whole range."""
    keys = [*order, F.xxhash64(*df.columns)]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .withColumn(RANGE, F.spark_partition_id())
     .withColumn(INDEX, F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_MASK)))
     .write.parquet(path))


def read_ordered(spark: SparkSession, path: str, total_col: str | None = None) -> DataFrame:
    """The rows with their 1-based ``position`` and, if wanted, the number of
    all rows.  The broadcast side has one row per range: at most as many as
    the shuffle had partitions, whatever the data."""
    table = spark.read.parquet(path)
    sizes = table.groupBy(RANGE).agg((F.max(INDEX) + 1).alias("__n"))
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    total = [F.sum("__n").over(Window.partitionBy()).alias(total_col)] if total_col else []
    offsets = sizes.select(RANGE, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"), *total)
    return (table.join(F.broadcast(offsets), RANGE)
            .withColumn("position", F.col("__before") + F.col(INDEX) + 1).drop(RANGE, INDEX, "__before"))


def temporal_split(df: DataFrame, path: str, ts: str = "event_timestamp", tie: str = "machine_id",
                   test_fraction: float = TEST_FRACTION) -> DataFrame:
    """``split.temporal_split`` through an ordered table at ``path``: the
    positions and ``is_train``, with one shuffle of the rows."""
    write_ordered(df, path, [ts, tie])
    rows = read_ordered(df.sparkSession, path, total_col="__all")
    cut = F.floor(F.col("__all") * F.lit(1.0 - test_fraction))
    return rows.withColumn("is_train", F.col("position") <= cut).drop("__all")
