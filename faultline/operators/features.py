"""Point-in-time training table (C1: PRJ-2, PRJ-3, FLT-1, WIN-1..12, LIM-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import ms_to_timestamp
from faultline.operators.windows import FrameAgg, trailing_aggregates
from faultline.schemas import PREVIEW_COLUMNS, SENSORS, WINDOW_FAMILIES, feature_name

# Frames over per-(machine, time) partial aggregates (see
# ``trailing_aggregates``): window tasks bounded by time, not by row rate.
PER_TIME = True


def family_aggs(families=WINDOW_FAMILIES, sensors=SENSORS) -> list[FrameAgg]:
    """Feature columns in output order: every sensor for the first family,
    then per sensor the remaining families (avg-5min, max-1min, ...)."""
    first, rest = families[0], families[1:]
    aggs = [FrameAgg(first[0], s, first[1], feature_name(first[0], s, first[2]))
            for s in sensors]
    for s in sensors:
        for agg, length, suffix in rest:
            aggs.append(FrameAgg(agg, s, length, feature_name(agg, s, suffix)))
    return aggs


def trailing_features(readings: DataFrame, families=WINDOW_FAMILIES,
                      sensors=SENSORS, include_current: bool = False,
                      bucket_ms: int | None = -1, per_time: bool = PER_TIME,
                      earlier: DataFrame | None = None) -> DataFrame:
    """WIN-*: trailing per-machine aggregates, empty frame -> 0.0 (PRJ-3)."""
    return trailing_aggregates(readings, "machine_id", "timestamp_ms",
                               family_aggs(families, sensors),
                               include_current=include_current,
                               bucket_ms=bucket_ms, default=0.0, per_time=per_time, earlier=earlier)


def training_table(readings: DataFrame, families=WINDOW_FAMILIES,
                   sensors=SENSORS, bucket_ms: int | None = -1,
                   per_time: bool = PER_TIME, earlier: DataFrame | None = None) -> DataFrame:
    """C1: one row per reading with leakage-free history features (``earlier``:
    parts of readings before these, see ``trailing_aggregates``).

    Rows whose max-family features are all-or-any zero are dropped (FLT-1:
    no history in the shortest frame; a true maximum of 0.0 is dropped too,
    as in the modelled system).
    """
    aggs = family_aggs(families, sensors)
    feats = trailing_features(readings, families, sensors, bucket_ms=bucket_ms,
                              per_time=per_time, earlier=earlier)
    out = feats.select(
        "machine_id",
        ms_to_timestamp("timestamp_ms").alias("event_timestamp"),
        *sensors, "machine_type",
        *[a.alias for a in aggs],
        F.col("faulty").cast("int").alias("faulty"),
    )
    cond = None
    for a in aggs:
        if a.agg == "max":
            c = F.col(a.alias) != 0
            cond = c if cond is None else cond & c
    return out.where(cond) if cond is not None else out


def training_preview(table: DataFrame, n: int = 10) -> DataFrame:
    """LIM-1: an ordered (deterministic) preview of chosen columns."""
    cols = [c for c in PREVIEW_COLUMNS if c in table.columns]
    return table.select(*cols, "event_timestamp").orderBy("machine_id", "event_timestamp") \
        .limit(n).select(*cols)


# Serving-side families: frames include the current reading.
SERVING_FAMILIES = [("avg", 5 * 60 * 1000, "5min"), ("max", 60 * 1000, "1min")]


def serving_features(readings: DataFrame, families=SERVING_FAMILIES, sensors=SENSORS,
                     bucket_ms: int | None = -1, per_time: bool = PER_TIME) -> DataFrame:
    """Batch form of the streaming features (ST-1/2): per reading, frames
    ``[t - d, t]`` including the reading itself.  Output names follow the
    streaming order (per sensor: 5 min mean, 1 min max)."""
    aggs = [FrameAgg(agg, s, length, feature_name(agg, s, suffix))
            for s in sensors for (agg, length, suffix) in families]
    return trailing_aggregates(readings, "machine_id", "timestamp_ms", aggs,
                               include_current=True, bucket_ms=bucket_ms, per_time=per_time)


def publish(df: DataFrame, names: list[str], digits: int) -> DataFrame:
    """PRJ-7: publication rounding of the named columns."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in names else F.col(c)
                       for c in df.columns])
