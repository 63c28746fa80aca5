"""A training table that grows by appends (C1): each append reads its own
readings and the parts that the one before left, never older readings.

``path/rows/append=k`` holds the rows of append ``k``, ``path/state/k`` what the next one needs:
per machine the per-time parts of the last readings, as far back as the
longest frame reaches.  A state is bounded by the distinct times of one frame
per machine, whatever the history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.features import family_aggs, training_table
from faultline.operators.windows import time_parts
from faultline.schemas import SENSORS, WINDOW_FAMILIES
from faultline.sources import files

KEY, TS = "machine_id", "timestamp_ms"


def append(spark: SparkSession, readings: DataFrame, path: str, number: int,
           families=WINDOW_FAMILIES, sensors=SENSORS) -> None:
    """Append ``number`` (0 begins): the training rows of ``readings``, with
    frames that reach into the appends before.

    A reading older than its machine's last one would change rows that are
    already written; it goes to ``path/late/append=k`` and into no frame.  One at that very time
    is taken: no frame holds its own time.  A repeated append replaces its own output, as
    the state that it starts from is kept; a missing state raises.  An empty append passes
    the state on."""
    path = path.rstrip("/")
    aggs = family_aggs(families, sensors)
    longest = max(a.length_ms for a in aggs)
    state, new = None, readings
    if number > 0:
        state = spark.read.parquet(f"{path}/state/{number - 1}")
        last = state.groupBy(F.col(KEY).alias("__key")).agg(F.max(TS).alias("__last"))
        marked = readings.join(last, F.col(KEY).eqNullSafe(F.col("__key")), "left")
        late = F.coalesce(F.col(TS) < F.col("__last"), F.lit(False))
        new = marked.where(~late).select(*readings.columns)
        marked.where(late).select(*readings.columns).write.mode("overwrite").parquet(f"{path}/late/append={number}")
    training_table(new, families, sensors, earlier=state).write.mode("overwrite").parquet(f"{path}/rows/append={number}")

    parts = time_parts(new, KEY, TS, aggs, state)
    ends = parts.groupBy(F.col(KEY).alias("__key")).agg(F.max(TS).alias("__last"))
    (parts.join(ends, F.col(KEY).eqNullSafe(F.col("__key")))
     .where(F.col(TS) >= F.col("__last") - F.lit(longest)).select(*parts.columns)
     .write.mode("overwrite").parquet(f"{path}/state/{number}"))
    if number > 1:
        files.remove(spark, f"{path}/state/{number - 2}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The training table of all appends."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows").drop("append")
