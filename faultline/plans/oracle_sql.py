"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on the provided tables registered as views.  The fixture
views are rebuilt from ``events`` with the same definitions as
``faultline.sources.fixtures``.
"""

from __future__ import annotations

SENSOR_INT = """sensor_int AS (
  SELECT event_id,
    CAST(event_id % 12 AS INT) + 1 AS machine_id,
    1767225600000 + 1000 * CAST(floor(event_id / 12) AS BIGINT) AS timestamp_ms,
    CAST(4500 + CAST(round(value * 100) AS BIGINT) % 700 + CASE WHEN event_type = 'error' THEN 400 ELSE 0 END AS BIGINT) AS temperature_c100,
    CAST(200 + CAST(round(value * 100) AS BIGINT) % 130 + CASE WHEN event_type = 'error' THEN 70 ELSE 0 END AS BIGINT) AS vibration_c100,
    CAST(10000 + user_id % 150 + CAST(round(value * 100) AS BIGINT) % 211 AS BIGINT) AS pressure_c100,
    CAST(150000 - CASE WHEN event_type = 'error' THEN 2500 ELSE 0 END + CAST(round(value * 100) AS BIGINT) % 3001 AS BIGINT) AS rotor_c100,
    CASE event_id % 12 % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS machine_type,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS faulty
  FROM events)"""

SENSOR = """sensor AS (
  SELECT event_id, machine_id, timestamp_ms,
    temperature_c100 / CAST(100 AS DOUBLE) AS temperature_C,
    vibration_c100 / CAST(100 AS DOUBLE) AS vibration_mm_per_s,
    pressure_c100 / CAST(100 AS DOUBLE) AS pressure_kPa,
    rotor_c100 / CAST(100 AS DOUBLE) AS rotor_speed_rpm,
    machine_type, faulty
  FROM sensor_int)"""

SPARSE = """sparse AS (
  SELECT event_id, user_id, event_type AS series, epoch_us(ts) // 1000 AS timestamp_ms,
    CAST(round(value * 100) AS BIGINT) AS value_c100, value
  FROM events)"""

SENSOR_SCALED = """sensor_scaled AS (
  SELECT event_id, machine_id, timestamp_ms,
    temperature_c100 AS temperature_C, vibration_c100 AS vibration_mm_per_s,
    pressure_c100 AS pressure_kPa, rotor_c100 AS rotor_speed_rpm,
    machine_type, faulty
  FROM sensor_int)"""

SCORES = """scores AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS y,
    (CAST(round(value * 100) AS BIGINT) % 1001) / CAST(1000 AS DOUBLE) AS p
  FROM events)"""

SENSORS = ["temperature_C", "vibration_mm_per_s", "pressure_kPa", "rotor_speed_rpm"]


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def win(agg: str, col: str, lo: int, hi: int | None, scale: float | None = 100.0,
        part: str = "machine_id", order: str = "timestamp_ms",
        default: str | None = "0.0") -> str:
    """A trailing range frame: ``hi=None`` means CURRENT ROW, else ``hi``
    ms PRECEDING.  ``scale`` divides the result (x100 fixture)."""
    upper = "CURRENT ROW" if hi is None else f"{hi} PRECEDING"
    e = (f"CAST({agg}({col}) OVER (PARTITION BY {part} ORDER BY {order} "
         f"RANGE BETWEEN {lo} PRECEDING AND {upper}) AS DOUBLE)")
    if default is not None:
        e = f"coalesce({e}, {default})"
    if scale is not None:
        e = f"({e} / {scale})"
    return e


def family_cols(families, hi=1, scale=100.0) -> list[tuple[str, str]]:
    first, rest = families[0], families[1:]
    cols = [(f"{first[0]}_{s}_{first[2]}", win(first[0], s, first[1], hi, scale))
            for s in SENSORS]
    for s in SENSORS:
        for agg, length, suffix in rest:
            cols.append((f"{agg}_{s}_{suffix}", win(agg, s, length, hi, scale)))
    return cols


def unscaled_sensors() -> str:
    return ", ".join(f"{s} / 100.0 AS {s}" for s in SENSORS)


def spark_round(expr: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal form
    of the value (not on its exact binary value, as DuckDB and Python do)."""
    return (f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) "
            f"AS DOUBLE)")


# Readings with every kind of special value, as DOUBLE: about one row in 50
# each is null, NaN, infinite, or 1e17 (``fixtures.special`` in Spark).
SPECIAL = """CASE event_id % 211 WHEN 3 THEN NULL WHEN 57 THEN CAST('nan' AS DOUBLE)
  WHEN 101 THEN CAST('inf' AS DOUBLE) WHEN 151 THEN 1e17 ELSE temperature_C END"""


def shown(e):
    """A double as a text that doesn't depend on the order of summation."""
    # no sum of decimal readings is near a rounding tie after this factor
    return (f"CASE WHEN {e} IS NULL THEN NULL WHEN isnan({e}) THEN 'nan' WHEN isinf({e}) THEN 'inf' "
            f"WHEN {e} > 1e9 THEN 'e' || CAST(CAST(floor({e} / 1e12 * 1.0471975511965976) AS BIGINT) AS VARCHAR) "
            f"ELSE CAST(CAST(floor({e} * 1.0471975511965976 * 1e5) AS BIGINT) AS VARCHAR) END")


ASOF_TOLERANCE_MS = 3 * 86_400_000
