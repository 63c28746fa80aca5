"""Running count per machine on a stream (ST-5, UDF-4) without a task per machine.

The state is one total per machine.  In a micro-batch every reading gets its
position among its machine's readings in time order from the position cascade
(``split.running_position``), which cuts a machine's time into buckets, and the
machine's total before the micro-batch is added.  The new totals are written
under the epoch; the next epoch starts from them.

A replayed epoch starts from the totals of the epochs before it, which are
kept, and replaces its own rows and totals, so each reading is counted once.
Readings without machine or time have no place in the order; they are what
``windows.rejects`` has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators.split import running_position
from faultline.sources import files
from faultline.sources.tables import write_partition
from faultline.streaming.windows import keyed

COUNT_COLUMNS = ["machine_id", "event_id", "timestamp_ms"]
TOTALS = "machine_id int, total bigint"
ROWS = "machine_id int, event_id bigint, timestamp_ms bigint, event_count bigint"


def _epochs(spark, path: str) -> list[int]:
    return sorted(int(n) for n in files.children(spark, f"{path}/totals") if n.isdigit())


def count_epoch(batch: DataFrame, epoch: int, path: str) -> None:
    """Rows and totals of one micro-batch: ``path/rows`` and ``path/totals``."""
    spark = batch.sparkSession
    earlier = [e for e in _epochs(spark, path) if e < epoch]
    totals = (spark.read.schema(TOTALS).parquet(f"{path}/totals/{earlier[-1]:015d}") if earlier
              else spark.createDataFrame([], TOTALS))
    batch = keyed(batch).select(*COUNT_COLUMNS).persist()
    placed = running_position(batch, ["machine_id"], "timestamp_ms", ["event_id"])
    rows = placed.join(totals, "machine_id", "left").select(
        *COUNT_COLUMNS, (F.col("position") + F.coalesce("total", F.lit(0))).alias("event_count"))
    write_partition(rows, f"{path}/rows", f"counts-{epoch}")
    (batch.groupBy("machine_id").agg(F.count(F.lit(1)).alias("total")).unionByName(totals)
     .groupBy("machine_id").agg(F.sum("total").alias("total"))
     .write.mode("overwrite").parquet(f"{path}/totals/{epoch:015d}"))
    batch.unpersist()
    for e in earlier[:-1]:  # a replay needs the totals before its epoch only
        files.remove(spark, f"{path}/totals/{e:015d}")


def count_writer(readings: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """ST-5 as a job: every reading with its machine's count so far."""
    w = (readings.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, epoch: count_epoch(batch, epoch, path)))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def read_counts(spark, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(f"{path}/rows").select(*COUNT_COLUMNS, "event_count")
