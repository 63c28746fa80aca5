"""Latest-window materialisation and the long online-feature table (C2).

The keyed store with expiry is modelled as an append-only long table
``(machine_id, feature_name, value, written_at_ms, expires_at_ms)``.  A write
overwrites the previous value of its key; a value is visible while
``as_of < expires_at_ms``.  Reads resolve the latest write per key with a
partial-aggregating ``max_by`` (no per-key collect, no driver loop).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import feature_key
from faultline.sources.tables import write_partition
from faultline.schemas import (BATCH_TTL_SECONDS, ONE_HOUR_MS, SENSORS,
                               feature_name)


def latest_window_avg(readings: DataFrame, window_ms: int = ONE_HOUR_MS,
                      sensors=SENSORS, suffix: str = "1h",
                      as_of_ms: int | None = None) -> DataFrame:
    """AGG-1 + FLT-2 + AGG-2: per machine averages over ``(end - w, end]``.

    ``end`` is the latest reading time (a scalar subquery evaluated once by
    Spark, not a driver round trip) or ``as_of_ms``, in which case later
    readings are ignored.  The cut is on the raw ``timestamp_ms`` column so
    it stays a data filter on the scan.
    """
    src = readings
    if as_of_ms is not None:
        src = src.where(F.col("timestamp_ms") <= F.lit(as_of_ms))
        end = F.lit(as_of_ms)
    else:
        end = readings.agg(F.max("timestamp_ms")).scalar()
    return (src.where(F.col("timestamp_ms") > end - F.lit(window_ms))
               .groupBy("machine_id")
               .agg(*[F.avg(s).alias(feature_name("avg", s, suffix)) for s in sensors]))


def melt(wide: DataFrame, names: list[str], id_cols=("machine_id",)) -> DataFrame:
    """PRJ-11: wide -> long ``(id, feature_name, value)``.

    An explode and not ``unpivot``: a filter on the ids is pushed below the
    explode in every branch of a plan that reads the long table, so Spark sees
    that the branches' inputs are equal and shuffles them once."""
    pairs = F.array(*[F.struct(F.lit(n).alias("feature_name"), F.col(n).alias("value")) for n in names])
    return wide.select(*id_cols, F.explode(pairs).alias("x")).select(*id_cols, "x.feature_name", "x.value")


def store_rows(long: DataFrame, written_at_ms, ttl_seconds: int) -> DataFrame:
    """SNK-3 row shape: value plus write time, expiry and the store key."""
    w = written_at_ms if not isinstance(written_at_ms, int) else F.lit(written_at_ms)
    return long.select(
        F.col("machine_id").cast("int").alias("machine_id"),
        "feature_name",
        F.col("value").cast("double").alias("value"),
        w.cast("bigint").alias("written_at_ms"),
        (w + F.lit(ttl_seconds * 1000)).cast("bigint").alias("expires_at_ms"),
    )


def with_keys(store: DataFrame) -> DataFrame:
    """PRJ-9: add the ``feature:machine_id={id}:{name}`` key column."""
    return store.withColumn("feature_key", feature_key("machine_id", "feature_name"))


def materialize_latest(readings: DataFrame, window_ms: int = ONE_HOUR_MS,
                       suffix: str = "1h", ttl_seconds: int = BATCH_TTL_SECONDS,
                       as_of_ms: int | None = None, sensors=SENSORS) -> DataFrame:
    """C2: latest-window averages as store writes stamped at the window end."""
    wide = latest_window_avg(readings, window_ms, sensors, suffix, as_of_ms)
    names = [feature_name("avg", s, suffix) for s in sensors]
    if as_of_ms is None:
        written = readings.agg(F.max("timestamp_ms")).scalar()
    else:
        written = F.lit(as_of_ms)
    return store_rows(melt(wide, names), written, ttl_seconds)


def append(store_rows_df: DataFrame, path: str, write_id: str) -> None:
    """SNK-3/4 sink: idempotent append of one write (``write_id``, e.g.
    ``batch-<as_of>``), partitioned by feature for pruned reads."""
    write_partition(store_rows_df, path, write_id, ["feature_name"])


def current(store: DataFrame, as_of_ms: int | None = None,
            names: list[str] | None = None) -> DataFrame:
    """FLT-5: the visible value per key as of a time.

    The latest write at or before ``as_of_ms`` wins; it is visible only while
    ``as_of_ms < expires_at_ms`` (an expired latest write hides older ones,
    as an overwrite with expiry would).  ``as_of_ms=None`` reads the latest
    state without an expiry check.
    """
    s = store
    if names is not None:
        s = s.where(F.col("feature_name").isin(names))
    if as_of_ms is not None:
        s = s.where(F.col("written_at_ms") <= F.lit(as_of_ms))
    found = latest(s).select("machine_id", "feature_name", "value", "written_at_ms", "expires_at_ms")
    if as_of_ms is not None:
        found = found.where(F.col("expires_at_ms") > F.lit(as_of_ms))
    return found


def write_order(store: DataFrame) -> Column:
    """The order of writes of one key at one time, as a long: by ``write_seq``
    if the table has it, then by a hash of the row.  It depends on the rows alone,
    not on the order in which they are read."""
    named = [F.col("write_id").cast("string")] if "write_id" in store.columns else []
    h = F.xxhash64("value", "expires_at_ms", *named)
    if "write_seq" not in store.columns:
        return h
    return F.shiftleft(F.coalesce("write_seq", F.lit(0).cast("bigint")), 32) + h.bitwiseAND(F.lit(0xFFFFFFFF))


def latest(store: DataFrame) -> DataFrame:
    """The last write per key, ties of time by ``write_order``."""
    # one number for both, so that the aggregate stays a hash aggregate
    order = (F.col("written_at_ms").cast("decimal(18,0)") * F.expr("18446744073709551616BD")
             + write_order(store).cast("decimal(19,0)"))
    seq = [c for c in ("write_seq",) if c in store.columns]
    return store.withColumn("_order", order).groupBy("machine_id", "feature_name").agg(
        *[F.max_by(c, "_order").alias(c) for c in ("value", "expires_at_ms", *seq)],
        F.max("written_at_ms").alias("written_at_ms"))


def pivot(long: DataFrame, names: list[str], id_col: str = "machine_id") -> DataFrame:
    """PRJ-12: long -> wide with an explicit name list (no extra job to
    discover the distinct names).  Expects one row per (id, name)."""
    return long.groupBy(id_col).pivot("feature_name", names).agg(F.first("value"))


def materialize_periodic(readings: DataFrame, period_ms: int, window_ms: int = ONE_HOUR_MS,
                         suffix: str = "1h", ttl_seconds: int = BATCH_TTL_SECONDS,
                         origin_ms: int = 0, sensors=SENSORS) -> DataFrame:
    """C2 replayed over history: the writes of a materialisation run every
    ``period_ms`` (run times ``origin + k * period``), each averaging the
    readings in ``(T - window, T]`` and stamped at ``T``.

    A reading at ``t`` belongs to the runs ``T`` with ``t <= T < t +
    window``: a range of run indices ``[first, last]`` that depends only on
    ``t``'s position in its period.  Readings are first summed per
    ``(machine, first, last)`` (a partial aggregate over the raw rows, at
    most two groups per machine and period), and only those small partial
    sums are copied to their ``window / period`` runs and summed per
    ``(machine, run)``.  Raw rows are never multiplied.
    """
    t = F.col("timestamp_ms") - F.lit(origin_ms)
    first = F.ceil(t / F.lit(period_ms)).cast("bigint")
    last = (F.ceil((t + F.lit(window_ms)) / F.lit(period_ms)) - 1).cast("bigint")
    partial = (readings.select("machine_id", first.alias("__first"), last.alias("__last"), *sensors)
                       .groupBy("machine_id", "__first", "__last")
                       .agg(*[F.sum(s).alias(f"__s{i}") for i, s in enumerate(sensors)],
                            *[F.count(s).alias(f"__n{i}") for i, s in enumerate(sensors)]))
    runs = (partial.select("machine_id", F.explode(F.sequence("__first", "__last")).alias("__run"),
                           *[f"__s{i}" for i in range(len(sensors))],
                           *[f"__n{i}" for i in range(len(sensors))])
                   .groupBy("machine_id", "__run")
                   .agg(*[F.try_divide(F.sum(f"__s{i}"), F.sum(f"__n{i}")).cast("double")
                          .alias(feature_name("avg", s, suffix)) for i, s in enumerate(sensors)])
                   .withColumn("written_at_ms",
                               F.lit(origin_ms) + F.col("__run") * F.lit(period_ms)))
    names = [feature_name("avg", s, suffix) for s in sensors]
    long = melt(runs, names, ("machine_id", "written_at_ms"))
    return store_rows(long, F.col("written_at_ms"), ttl_seconds)
