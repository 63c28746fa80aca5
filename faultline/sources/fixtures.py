"""Sensor-shaped inputs derived from the provided ``events`` table.

Every fixture is a pure projection of ``events`` so that it grows with it and
so that the same definition can be written in SQL for the oracle.  ``event_id``
is dense from 0: twelve consecutive events make one one-second tick of a
twelve-machine fleet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.scalar import machine_class

# Fixed values of the derivation (shared with the SQL oracle).
FLEET_SIZE = 12
EPOCH_START_MS = 1767225600000
TICK_MS = 1000


def _c100(value: Column) -> Column:
    return F.round(value * 100).cast("bigint")


def sensor_int(events: DataFrame) -> DataFrame:
    """Readings with sensors scaled by 100 as exact integers."""
    err = F.col("event_type") == "error"
    v = _c100(F.col("value"))
    return events.select(
        "event_id",
        ((F.col("event_id") % FLEET_SIZE).cast("int") + 1).alias("machine_id"),
        (F.lit(EPOCH_START_MS) + F.lit(TICK_MS)
         * F.floor(F.col("event_id") / FLEET_SIZE).cast("bigint")).alias("timestamp_ms"),
        (4500 + v % 700 + F.when(err, 400).otherwise(0)).cast("bigint").alias("temperature_c100"),
        (200 + v % 130 + F.when(err, 70).otherwise(0)).cast("bigint").alias("vibration_c100"),
        (10000 + F.col("user_id") % 150 + v % 211).cast("bigint").alias("pressure_c100"),
        (150000 - F.when(err, 2500).otherwise(0) + v % 3001).cast("bigint").alias("rotor_c100"),
        machine_class((F.col("event_id") % FLEET_SIZE).cast("int") + 1).alias("machine_type"),
        F.when(err, 1).otherwise(0).alias("faulty"),
    )


def sensor(events: DataFrame) -> DataFrame:
    """Readings with the modelled column names and types."""
    si = sensor_int(events)
    return si.select(
        "event_id", "machine_id", "timestamp_ms",
        (F.col("temperature_c100") / 100.0).alias("temperature_C"),
        (F.col("vibration_c100") / 100.0).alias("vibration_mm_per_s"),
        (F.col("pressure_c100") / 100.0).alias("pressure_kPa"),
        (F.col("rotor_c100") / 100.0).alias("rotor_speed_rpm"),
        "machine_type", "faulty",
    )


SCALED_COLUMNS = {"temperature_c100": "temperature_C", "vibration_c100": "vibration_mm_per_s",
                  "pressure_c100": "pressure_kPa", "rotor_c100": "rotor_speed_rpm"}


def sensor_scaled(events: DataFrame) -> DataFrame:
    """``sensor`` with exact integer (x100) values under the sensor names.

    Operators run unchanged on it; sums and averages are then exact and
    independent of summation order, so results can be compared bit for bit
    with another engine after dividing by 100.
    """
    si = sensor_int(events)
    return si.select(*[F.col(c).alias(SCALED_COLUMNS.get(c, c)) for c in si.columns])


def event_ms(ts: Column) -> Column:
    """Epoch milliseconds (floored) of an NTZ timestamp read as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def sparse(events: DataFrame) -> DataFrame:
    """Irregularly spaced series keyed by event type (and by user)."""
    return events.select(
        "event_id", "user_id", F.col("event_type").alias("series"),
        event_ms(F.col("ts")).alias("timestamp_ms"),
        _c100(F.col("value")).alias("value_c100"), "value",
    )


def scores(events: DataFrame) -> DataFrame:
    """Labelled scores with ties for the metric operators."""
    return events.select(
        "event_id",
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("y"),
        ((_c100(F.col("value")) % 1001) / 1000.0).alias("p"),
    )


def gap(sensor_df: DataFrame, machine_id: int = 12,
        start_ms: int = 1767225610000, end_ms: int = 1767225679000) -> DataFrame:
    """A silence of one machine (for expiry checks)."""
    silent = (F.col("machine_id") == machine_id) & F.col("timestamp_ms").between(start_ms, end_ms)
    return sensor_df.where(~silent)


def special() -> Column:
    """The temperature of a reading, or every kind of special value: about one
    row in 50 each is null, NaN, infinite, or 1e17."""
    k = F.col("event_id") % 211
    return (F.when(k == 3, F.lit(None).cast("double")).when(k == 57, F.lit(float("nan"))).when(k == 101, F.lit(float("inf")))
            .when(k == 151, F.lit(1e17)).otherwise(F.col("temperature_C")))


def shown(name: str, alias: str) -> Column:
    """A double as a text that doesn't depend on the order of summation."""
    x = F.col(name).cast("double")
    return (F.when(x.isNull(), None).when(F.isnan(x), "nan").when(F.abs(x) == float("inf"), "inf")
            .when(x > 1e9, F.concat(F.lit("e"), F.floor(x / F.lit(1e12) * F.lit(1.0471975511965976)).cast("bigint").cast("string")))
            .otherwise(F.floor(x * F.lit(1.0471975511965976) * F.lit(1e5)).cast("bigint").cast("string"))).alias(alias)
