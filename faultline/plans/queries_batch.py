"""Batch queries: scans, trailing windows, training table, preview."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.scalar import machine_class, ms_to_timestamp
from faultline.operators import features as feat
from faultline.operators import incremental
from faultline.operators.windows import FrameAgg, trailing_aggregates
from faultline.plans import oracle_sql as O
from faultline.plans.registry import register, sensor, sensor_scaled, unscale
from faultline.schemas import SENSORS, WINDOW_FAMILIES
from faultline.session import scratch_path
from faultline.sources import fixtures as fx
from faultline.sources.tables import load_readings, load_training_table, save_table

V = O.with_views(O.SENSOR_INT, O.SENSOR)
VS = O.with_views(O.SENSOR_INT, O.SENSOR_SCALED)

# Shorter frames for the small scale factors, where a 1 h frame never fills.
SHORT_FAMILIES = [("avg", 600_000, "10min"), ("avg", 120_000, "2min"), ("max", 30_000, "30s")]
SHORT_BUCKET_MS = 180_000   # small buckets: many rows see a halo copy


@register("sensor_scan", V + """
SELECT machine_id, timestamp_ms, epoch_ms(timestamp_ms) AS event_timestamp,
  temperature_C, vibration_mm_per_s, pressure_kPa, rotor_speed_rpm,
  CASE (machine_id - 1) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS machine_class,
  machine_type, faulty
FROM sensor""")
def q_sensor_scan(spark, sf_dir):
    s = sensor(spark, sf_dir)
    return s.select("machine_id", "timestamp_ms",
                    ms_to_timestamp("timestamp_ms").alias("event_timestamp"),
                    *SENSORS, machine_class("machine_id").alias("machine_class"),
                    "machine_type", "faulty")


@register("readings_roundtrip", V + """
SELECT machine_id, timestamp_ms, temperature_C, vibration_mm_per_s, pressure_kPa, rotor_speed_rpm, machine_type, faulty
FROM sensor""")
def q_readings_roundtrip(spark, sf_dir):
    """SNK-1 and SRC-1: readings written and read again with the fixed schema."""
    path = scratch_path(spark, "readings")
    save_table(sensor(spark, sf_dir).select("machine_id", "timestamp_ms", *SENSORS, "machine_type", "faulty"), path)
    return load_readings(spark, path)


_SPECIAL_FRAMES = [("avg", 60_000, "a60"), ("avg", 7_000, "a7"), ("max", 7_000, "m7"), ("sum", 7_000, "s7"),
                   ("count", 60_000, "c60")]


@register("win_double_special", O.with_views(O.SENSOR_INT, O.SENSOR) + ", sp AS (SELECT event_id, machine_id, timestamp_ms, "
          + O.SPECIAL + " AS v FROM sensor), w AS (SELECT event_id, machine_id, timestamp_ms, "
          + ", ".join(f"{a}(v) OVER (PARTITION BY machine_id ORDER BY timestamp_ms RANGE BETWEEN {d} PRECEDING AND 1 PRECEDING)"
                      f" AS {n}" for a, d, n in _SPECIAL_FRAMES) + " FROM sp) SELECT event_id, machine_id, timestamp_ms, "
          + ", ".join(f"{O.shown(f'CAST({n} AS DOUBLE)')} AS {n}" for _, _, n in _SPECIAL_FRAMES) + " FROM w")
def q_win_double_special(spark, sf_dir):
    """WIN-* on DOUBLE readings with null, NaN, infinity and huge values: they
    touch only the frames that hold them."""
    r = sensor(spark, sf_dir).select("event_id", "machine_id", "timestamp_ms", fx.special().alias("v"))
    out = trailing_aggregates(r, "machine_id", "timestamp_ms", [FrameAgg(a, "v", d, n) for a, d, n in _SPECIAL_FRAMES])
    return out.select("event_id", "machine_id", "timestamp_ms", *[fx.shown(n, n) for _, _, n in _SPECIAL_FRAMES])


def _family_query(families, bucket_ms=-1):
    def q(spark, sf_dir):
        df = feat.trailing_features(sensor_scaled(spark, sf_dir), families, bucket_ms=bucket_ms)
        names = [a.alias for a in feat.family_aggs(families)]
        return unscale(df.select("machine_id", "timestamp_ms", *names), names)
    return q


def _family_sql(families):
    cols = O.family_cols(families)
    return VS + "SELECT machine_id, timestamp_ms,\n  " + ",\n  ".join(
        f"{e} AS {n}" for n, e in cols) + "\nFROM sensor_scaled"


for _fam in WINDOW_FAMILIES:
    _name = {"1h": "win_avg_1h", "5min": "win_avg_5min", "1min": "win_max_1min"}[_fam[2]]
    register(_name, _family_sql([_fam]))(_family_query([_fam]))

register("win_short_bucketed", _family_sql(SHORT_FAMILIES))(
    _family_query(SHORT_FAMILIES, bucket_ms=SHORT_BUCKET_MS))
register("win_short_unbucketed", _family_sql(SHORT_FAMILIES))(
    _family_query(SHORT_FAMILIES, bucket_ms=None))


def _training_sql(families):
    cols = O.family_cols(families)
    maxes = [n for n, _ in cols if n.startswith("max_")]
    return VS + "SELECT * FROM (SELECT machine_id, epoch_ms(timestamp_ms) AS event_timestamp,\n  " \
        + O.unscaled_sensors() + ", machine_type,\n  " \
        + ",\n  ".join(f"{e} AS {n}" for n, e in cols) \
        + ",\n  faulty FROM sensor_scaled) t WHERE " + " AND ".join(f"{m} <> 0" for m in maxes)


def _training_query(families, bucket_ms=-1):
    def q(spark, sf_dir):
        t = feat.training_table(sensor_scaled(spark, sf_dir), families, bucket_ms=bucket_ms)
        return unscale(t, SENSORS + [a.alias for a in feat.family_aggs(families)])
    return q


register("training_table", _training_sql(WINDOW_FAMILIES))(_training_query(WINDOW_FAMILIES))
register("training_table_short", _training_sql(SHORT_FAMILIES))(
    _training_query(SHORT_FAMILIES, SHORT_BUCKET_MS))


@register("training_table_incremental", _training_sql(WINDOW_FAMILIES))
def q_training_table_incremental(spark, sf_dir):
    """C1 in two appends: the readings up to the middle of the time, then the rest."""
    r = sensor_scaled(spark, sf_dir)
    middle = r.agg(F.floor((F.min("timestamp_ms") + F.max("timestamp_ms")) / 2)).scalar()
    path = scratch_path(spark, "incremental")
    incremental.append(spark, r.where(F.col("timestamp_ms") <= middle), path, 0)
    incremental.append(spark, r.where(F.col("timestamp_ms") > middle), path, 1)
    return unscale(incremental.read(spark, path), SENSORS + [a.alias for a in feat.family_aggs(WINDOW_FAMILIES)])


@register("training_roundtrip", _training_sql(WINDOW_FAMILIES))
def q_training_roundtrip(spark, sf_dir):
    """SNK-1 and SRC-2: the training table written and read again."""
    path = scratch_path(spark, "training")
    save_table(_training_query(WINDOW_FAMILIES)(spark, sf_dir), path)
    return load_training_table(spark, path)


@register("training_preview", "SELECT " + ", ".join(feat.PREVIEW_COLUMNS) + " FROM ("
          + _training_sql(WINDOW_FAMILIES) + ") p ORDER BY machine_id, event_timestamp LIMIT 10")
def q_training_preview(spark, sf_dir):
    return feat.training_preview(_training_query(WINDOW_FAMILIES)(spark, sf_dir))
