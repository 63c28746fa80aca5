"""Schemas, feature names and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)

# ---------------------------------------------------------------------------
# Fixed values (must stay equal to the modelled system for equal results)
# ---------------------------------------------------------------------------
SENSORS = ["temperature_C", "vibration_mm_per_s", "pressure_kPa", "rotor_speed_rpm"]
MACHINE_CLASSES = ["A", "B", "C"]            # machine id 1,4,7.. -> A; 2,5,8.. -> B; else C
ONE_HOUR_MS = 60 * 60 * 1000
FIVE_MIN_MS = 5 * 60 * 1000
ONE_MIN_MS = 60 * 1000
BATCH_TTL_SECONDS = 60 * 60                   # latest-hour averages
STREAM_TTL_SECONDS = 60                       # streaming window features
FAULT_THRESHOLD = 0.3                         # serving decision threshold
FEATURE_KEY_FORMAT = "feature:machine_id=%s:%s"
N_TREES = 80
MAX_DEPTH = 8
TEST_FRACTION = 0.2
SEED = 42
STREAM_FEATURE_DIGITS = 2                     # streaming features published at 2 dp
PROBA_DIGITS = 3                              # published probability at 3 dp
TUMBLE_SECONDS = 10                           # alert window
TUMBLE_GRACE_SECONDS = 1
ALERT_THRESHOLD = 6.0
PREVIEW_COLUMNS = ["machine_id", "temperature_C", "avg_temperature_C_1h",
                   "avg_temperature_C_5min", "max_temperature_C_1min",
                   "vibration_mm_per_s", "pressure_kPa", "rotor_speed_rpm",
                   "machine_type", "faulty"]
MODEL_NAME = "faultline_forest"
# ---------------------------------------------------------------------------

# Window families: (aggregate, frame length in ms, name suffix).
WINDOW_FAMILIES = [("avg", ONE_HOUR_MS, "1h"), ("avg", FIVE_MIN_MS, "5min"),
                   ("max", ONE_MIN_MS, "1min")]


def feature_name(agg: str, sensor: str, suffix: str) -> str:
    return f"{agg}_{sensor}_{suffix}"


# Batch (latest-hour) features: avg over 1 h.
BATCH_FEATURES = [feature_name("avg", s, "1h") for s in SENSORS]
# Streaming features: per sensor, 5 min mean then 1 min max.
STREAM_FEATURES = [n for s in SENSORS for n in (feature_name("avg", s, "5min"),
                                                 feature_name("max", s, "1min"))]
# Model input order: per sensor raw, 1 h avg, 5 min avg, 1 min max; then class.
ORDERED_NUMERIC_FEATURES = [n for s in SENSORS for n in (
    s, feature_name("avg", s, "1h"), feature_name("avg", s, "5min"),
    feature_name("max", s, "1min"))]
CATEGORICAL_FEATURES = ["machine_type"]
ORDERED_FEATURE_NAMES = ORDERED_NUMERIC_FEATURES + CATEGORICAL_FEATURES

SENSOR_SCHEMA = StructType([
    StructField("machine_id", IntegerType(), False),
    StructField("timestamp_ms", LongType(), False),
    *[StructField(s, DoubleType(), False) for s in SENSORS],
    StructField("machine_type", StringType(), True),
    StructField("faulty", IntegerType(), False),
])

# The JSON payload of a live reading: the batch columns, ``faulty`` as a
# boolean, plus ``is_under_load``.
STREAM_SCHEMA = StructType([
    StructField("machine_id", IntegerType(), True),
    StructField("timestamp_ms", LongType(), True),
    *[StructField(s, DoubleType(), True) for s in SENSORS],
    StructField("machine_type", StringType(), True),
    StructField("is_under_load", BooleanType(), True),
    StructField("faulty", BooleanType(), True),
])
