"""Scalar and JSON queries: number parsing, topic encode/decode, units."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.scalar import fahrenheit, parse_number
from faultline.plans import oracle_sql as O
from faultline.plans.registry import events, register, sensor
from faultline.streaming.sources import decode_readings, encode_records

V = O.with_views(O.SENSOR_INT, O.SENSOR)


@register("parse_numeric", """
SELECT event_id, raw, TRY_CAST(trim(raw) AS DOUBLE) AS parsed FROM (
  SELECT event_id, CASE event_type
      WHEN 'error' THEN 'None'
      WHEN 'view' THEN event_type
      WHEN 'click' THEN NULL
      ELSE trim(replace(replace(props, '{"k":', ''), '}', '')) END AS raw
  FROM events) t""")
def q_parse_numeric(spark, sf_dir):
    """PRJ-10: stored strings -> double; ``"None"``, junk and null -> null."""
    ev = events(spark, sf_dir)
    raw = (F.when(F.col("event_type") == "error", F.lit("None"))
            .when(F.col("event_type") == "view", F.col("event_type"))
            .when(F.col("event_type") == "click", F.lit(None).cast("string"))
            .otherwise(F.trim(F.replace(F.replace("props", F.lit('{"k":'), F.lit("")),
                                        F.lit("}"), F.lit("")))))
    t = ev.select("event_id", raw.alias("raw"))
    return t.select("event_id", "raw", parse_number(F.trim("raw")).alias("parsed"))


@register("json_roundtrip", V + """
SELECT CAST(machine_id AS VARCHAR) AS key, machine_id, timestamp_ms, temperature_C,
  vibration_mm_per_s, pressure_kPa, rotor_speed_rpm, machine_type, faulty
FROM sensor""")
def q_json_roundtrip(spark, sf_dir):
    """SNK-2 encode -> SRC-6 decode: key string + JSON value, read back."""
    s = sensor(spark, sf_dir)
    payload = s.select("machine_id", "timestamp_ms", "temperature_C", "vibration_mm_per_s",
                       "pressure_kPa", "rotor_speed_rpm", "machine_type",
                       (F.col("faulty") == 1).alias("faulty"))
    frames = encode_records(payload).withColumn("value", F.col("value").cast("binary")) \
        .withColumn("key", F.col("key").cast("binary")).withColumn("timestamp", F.current_timestamp())
    d = decode_readings(frames)
    return d.select("key", "machine_id", "timestamp_ms", "temperature_C", "vibration_mm_per_s",
                    "pressure_kPa", "rotor_speed_rpm", "machine_type", "faulty")


@register("json_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_props(spark, sf_dir):
    """JSON object decode of a string column (``from_json``)."""
    ev = events(spark, sf_dir)
    return ev.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


@register("to_fahrenheit", V + """
SELECT machine_id, timestamp_ms, temperature_C, temperature_C * 9 / 5 + 32 AS temperature_F FROM sensor""")
def q_to_fahrenheit(spark, sf_dir):
    """DOR-1."""
    s = sensor(spark, sf_dir)
    return s.select("machine_id", "timestamp_ms", "temperature_C",
                    fahrenheit("temperature_C").alias("temperature_F"))
