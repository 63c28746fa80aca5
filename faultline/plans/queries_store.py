"""Materialisation, feature table, expiry and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import features as feat
from faultline.operators import lookup as lk
from faultline.operators import store as st
from faultline.plans import oracle_sql as O
from faultline.plans.registry import events, register, sensor_scaled, unscale
from faultline.schemas import (BATCH_FEATURES, BATCH_TTL_SECONDS, SENSORS,
                               STREAM_FEATURES, STREAM_TTL_SECONDS, feature_name)
from faultline.session import ensure_utc, scratch_path
from faultline.sources import fixtures as fx
from faultline.sources import hourly

VS = O.with_views(O.SENSOR_INT, O.SENSOR_SCALED)
GAP_AS_OF_MS = 1767225675000      # inside the 70 s silence of machine 12
BATCH_RUN_MS = 1767225609000      # a materialisation run just before it
COLD_MACHINE = 7
NO_STREAM_MACHINE = 3


def _latest_sql(window_ms, suffix, where="TRUE", as_of=None):
    end = f"{as_of}" if as_of is not None else \
        f"(SELECT max(timestamp_ms) FROM sensor_scaled WHERE {where})"
    upto = f" AND timestamp_ms <= {as_of}" if as_of is not None else ""
    return (f"SELECT machine_id, " + ", ".join(
        f"avg({s}) / 100.0 AS avg_{s}_{suffix}" for s in SENSORS)
        + f" FROM sensor_scaled WHERE {where}{upto} AND timestamp_ms > {end} - {window_ms}"
        + " GROUP BY machine_id")


def _latest_query(window_ms, suffix):
    def q(spark, sf_dir):
        df = st.latest_window_avg(sensor_scaled(spark, sf_dir), window_ms, suffix=suffix)
        return unscale(df, [feature_name("avg", s, suffix) for s in SENSORS])
    return q


register("latest_hour_avg", VS + _latest_sql(3_600_000, "1h"))(_latest_query(3_600_000, "1h"))
register("latest_5min_avg", VS + _latest_sql(300_000, "5min"))(_latest_query(300_000, "5min"))


@register("latest_hour_pruned", VS + _latest_sql(3_600_000, "1h"))
def q_latest_hour_pruned(spark, sf_dir):
    """AGG-1 + FLT-2 over hour folders: only the folders that the last hour can touch are read."""
    readings = sensor_scaled(spark, sf_dir)
    path = scratch_path(spark, "hourly")
    hourly.write_hourly(readings, path)
    df = st.latest_window_avg(hourly.recent(spark, path, schema=readings.schema), suffix="1h")
    return unscale(df, [feature_name("avg", s, "1h") for s in SENSORS])


def _batch_store(spark, sf_dir, readings=None, as_of_ms=None):
    """Batch writes (values back in units)."""
    r = readings if readings is not None else sensor_scaled(spark, sf_dir)
    rows = st.materialize_latest(r, as_of_ms=as_of_ms)
    return rows.withColumn("value", F.col("value") / F.lit(100.0))


def _melt_sql(where="TRUE", as_of=None):
    wide = _latest_sql(3_600_000, "1h", where, as_of)
    written = f"{as_of}" if as_of is not None else \
        f"(SELECT max(timestamp_ms) FROM sensor_scaled WHERE {where})"
    parts = [f"SELECT machine_id, '{n}' AS feature_name, {n} AS value, "
             f"{written} AS written_at_ms, {written} + {BATCH_TTL_SECONDS * 1000} AS expires_at_ms "
             f"FROM wide" for n in BATCH_FEATURES]
    return f"wide AS ({wide}), batch_store AS (" + " UNION ALL ".join(parts) + ")"


@register("feature_melt", VS + ", " + _melt_sql() + """
SELECT machine_id, feature_name, value, written_at_ms, expires_at_ms,
  'feature:machine_id=' || CAST(machine_id AS VARCHAR) || ':' || feature_name AS feature_key
FROM batch_store""")
def q_feature_melt(spark, sf_dir):
    return st.with_keys(_batch_store(spark, sf_dir))


@register("feature_pivot", VS + _latest_sql(3_600_000, "1h"))
def q_feature_pivot(spark, sf_dir):
    return st.pivot(st.current(_batch_store(spark, sf_dir)), BATCH_FEATURES)


# ---- streaming-feature writes in batch form (one write per reading) -------

def _stream_writes(readings):
    """Per reading, the 8 serving features published at 2 dp, written at the
    reading time with the streaming TTL (values back in units)."""
    f = unscale(feat.serving_features(readings), STREAM_FEATURES)
    f = feat.publish(f, STREAM_FEATURES, 2)
    return st.store_rows(st.melt(f.select("machine_id", "timestamp_ms", *STREAM_FEATURES),
                                 STREAM_FEATURES, ("machine_id", "timestamp_ms")),
                         F.col("timestamp_ms"), STREAM_TTL_SECONDS)


def _stream_writes_sql(src="sensor_scaled"):
    cols = []
    for s in SENSORS:
        cols.append((f"avg_{s}_5min", O.win("avg", s, 300000, None, default=None)))
        cols.append((f"max_{s}_1min", O.win("max", s, 60000, None, default=None)))
    feats = (f"sf AS (SELECT machine_id, timestamp_ms, "
             + ", ".join(f"{O.spark_round(e, 2)} AS {n}" for n, e in cols) + f" FROM {src})")
    parts = [f"SELECT machine_id, '{n}' AS feature_name, {n} AS value, timestamp_ms AS written_at_ms, "
             f"timestamp_ms + {STREAM_TTL_SECONDS * 1000} AS expires_at_ms FROM sf"
             for n in STREAM_FEATURES]
    return feats + ", stream_store AS (" + " UNION ALL ".join(parts) + ")"


@register("stream_feature_writes", VS + ", " + _stream_writes_sql() + """
SELECT * FROM stream_store""")
def q_stream_feature_writes(spark, sf_dir):
    return _stream_writes(sensor_scaled(spark, sf_dir))


GAP_WHERE = "NOT (machine_id = 12 AND timestamp_ms BETWEEN 1767225610000 AND 1767225679000)"


@register("ttl_visible", VS + ", gap AS (SELECT * FROM sensor_scaled WHERE " + GAP_WHERE + "), "
          + _melt_sql(GAP_WHERE, BATCH_RUN_MS).replace("FROM sensor_scaled", "FROM gap")
          + ", " + _stream_writes_sql("gap") + f""",
all_writes AS (SELECT * FROM batch_store UNION ALL SELECT * FROM stream_store),
latest AS (SELECT machine_id, feature_name, arg_max(value, written_at_ms) AS value,
  max(written_at_ms) AS written_at_ms, arg_max(expires_at_ms, written_at_ms) AS expires_at_ms
  FROM all_writes WHERE written_at_ms <= {GAP_AS_OF_MS} GROUP BY machine_id, feature_name)
SELECT * FROM latest WHERE expires_at_ms > {GAP_AS_OF_MS}""")
def q_ttl_visible(spark, sf_dir):
    g = fx.gap(sensor_scaled(spark, sf_dir))
    writes = _batch_store(spark, sf_dir, g, BATCH_RUN_MS).unionByName(_stream_writes(g))
    return st.current(writes, GAP_AS_OF_MS)


STORE_SLOT_MS = 60_000
STORE_HORIZONS = (GAP_AS_OF_MS - 45_000, GAP_AS_OF_MS)
# The end of the slot that the first horizon lies in: the first compaction closes that slot.
STORE_CLOSED_MS = -(-STORE_HORIZONS[0] // STORE_SLOT_MS) * STORE_SLOT_MS


@register("store_compacted", VS + ", gap AS (SELECT * FROM sensor_scaled WHERE " + GAP_WHERE + "), "
          + _melt_sql(GAP_WHERE, BATCH_RUN_MS).replace("FROM sensor_scaled", "FROM gap")
          + ", " + _stream_writes_sql("gap") + """,
all_writes AS (SELECT * FROM batch_store UNION ALL SELECT * FROM stream_store),
points AS (SELECT unnest([""" + ", ".join(str(GAP_AS_OF_MS + d) for d in (0, 5_000, 400_000)) + """]) AS as_of_ms),
latest AS (SELECT as_of_ms, machine_id, feature_name, arg_max(value, written_at_ms) AS value,
  max(written_at_ms) AS written_at_ms, arg_max(expires_at_ms, written_at_ms) AS expires_at_ms
  FROM all_writes JOIN points ON written_at_ms <= as_of_ms GROUP BY ALL)
SELECT * FROM latest, (SELECT unnest(['written', 'compacted', 'again']) AS step) WHERE expires_at_ms > as_of_ms""")
def q_store_compacted(spark, sf_dir):
    """SNK-3, SNK-4, FLT-5 through the versioned store: the visible rows at
    three times, from the version before compaction, after it, and after a second one
    that also merges what was written since: the replay of a run whose end was not
    acknowledged, which replaces what is left of the run's own rows."""
    from faultline.operators.feature_store import FeatureStore
    ensure_utc(spark)
    g = fx.gap(sensor_scaled(spark, sf_dir))
    fs = FeatureStore(spark, scratch_path(spark, "feature-store"), STORE_SLOT_MS)
    stream = _stream_writes(g).persist()
    odd = stream.where(F.col("machine_id") % 2 == 1)
    fs.append(_batch_store(spark, sf_dir, g, BATCH_RUN_MS), f"batch-{BATCH_RUN_MS}")
    fs.append(stream.where(F.col("machine_id") % 2 == 0), "stream-0")
    steps = {"written": fs.append(odd, "stream-1"), "compacted": fs.compact(STORE_CLOSED_MS, STORE_HORIZONS[0])}
    fs.append(odd, "stream-1")
    stream.unpersist()
    steps["again"] = fs.compact(2**62, STORE_HORIZONS[1])
    out = None
    for step, version in steps.items():
        for d in (0, 5_000, 400_000):
            rows = fs.current(GAP_AS_OF_MS + d, version=version).select(
                F.lit(GAP_AS_OF_MS + d).cast("bigint").alias("as_of_ms"), "*", F.lit(step).alias("step"))
            out = rows if out is None else out.unionByName(rows)
    return out


def _full_store(spark, sf_dir, readings):
    return _batch_store(spark, sf_dir, readings).unionByName(_stream_writes(readings))


LOOKUP_COLS = ["machine_id", "timestamp_ms"] + SENSORS


@register("lookup_batch", VS + ", cold AS (SELECT * FROM sensor_scaled WHERE machine_id <> 7), "
          + _melt_sql("machine_id <> 7").replace("FROM sensor_scaled", "FROM cold").replace(
              "max(timestamp_ms) FROM cold", "max(timestamp_ms) FROM sensor_scaled") + """,
wide_b AS (SELECT machine_id, """ + ", ".join(
              f"max(value) FILTER (WHERE feature_name = '{n}') AS {n}" for n in BATCH_FEATURES)
          + """ FROM batch_store GROUP BY machine_id)
SELECT s.machine_id, s.timestamp_ms, """ + O.unscaled_sensors().replace("temperature_C /", "s.temperature_C /")
          + ", " + ", ".join(f"w.{n}" for n in BATCH_FEATURES) + """
FROM sensor_scaled s JOIN wide_b w ON s.machine_id = w.machine_id""")
def q_lookup_batch(spark, sf_dir):
    readings = sensor_scaled(spark, sf_dir)
    cold = readings.where(F.col("machine_id") != COLD_MACHINE)
    end = readings.agg(F.max("timestamp_ms")).scalar()
    rows = st.materialize_latest(cold).withColumn("value", F.col("value") / F.lit(100.0))
    # Batch features stamped at the overall end; read them as of then.
    rows = rows.withColumn("written_at_ms", end).withColumn(
        "expires_at_ms", end + F.lit(BATCH_TTL_SECONDS * 1000))
    ev = unscale(readings.select(*LOOKUP_COLS), SENSORS)
    return lk.enrich_current(ev, rows, BATCH_FEATURES, None, required=True)


@register("lookup_streaming", VS + ", nostream AS (SELECT * FROM sensor_scaled WHERE machine_id <> 3), "
          + _stream_writes_sql("nostream") + """,
as_of AS (SELECT max(timestamp_ms) AS t FROM sensor_scaled),
latest AS (SELECT machine_id, feature_name, arg_max(value, written_at_ms) AS value,
  arg_max(expires_at_ms, written_at_ms) AS expires_at_ms
  FROM stream_store WHERE written_at_ms <= (SELECT t FROM as_of) GROUP BY machine_id, feature_name),
wide_s AS (SELECT machine_id, """ + ", ".join(
              f"max(value) FILTER (WHERE feature_name = '{n}') AS {n}" for n in STREAM_FEATURES)
          + """ FROM latest WHERE expires_at_ms > (SELECT t FROM as_of) GROUP BY machine_id)
SELECT s.machine_id, s.timestamp_ms, """ + O.unscaled_sensors().replace("temperature_C /", "s.temperature_C /")
          + ", " + ", ".join(f"coalesce(w.{n}, 0.0) AS {n}" for n in STREAM_FEATURES) + """
FROM sensor_scaled s LEFT JOIN wide_s w ON s.machine_id = w.machine_id""")
def q_lookup_streaming(spark, sf_dir):
    readings = sensor_scaled(spark, sf_dir)
    writes = _stream_writes(readings.where(F.col("machine_id") != NO_STREAM_MACHINE))
    end = readings.agg(F.max("timestamp_ms")).scalar()
    ev = unscale(readings.select(*LOOKUP_COLS), SENSORS)
    return lk.enrich_current(ev, writes, STREAM_FEATURES, end, required=False)


SP = O.with_views(O.SPARSE)
ASOF_TOLERANCE_MS = O.ASOF_TOLERANCE_MS


@register("asof_lookup", SP + f""",
l AS (SELECT event_id, user_id, timestamp_ms, value_c100 FROM sparse WHERE series = 'purchase'),
r AS (SELECT user_id, timestamp_ms, value_c100 FROM sparse WHERE series = 'error')
SELECT l.event_id, l.user_id, l.timestamp_ms, l.value_c100,
  CASE WHEN l.timestamp_ms - r.timestamp_ms <= {ASOF_TOLERANCE_MS} THEN r.value_c100 END AS err_value_c100,
  CASE WHEN l.timestamp_ms - r.timestamp_ms <= {ASOF_TOLERANCE_MS} THEN r.timestamp_ms END AS err_asof_ts
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.timestamp_ms >= r.timestamp_ms""")
def q_asof_lookup(spark, sf_dir):
    sp = fx.sparse(events(spark, sf_dir))
    left = sp.where(F.col("series") == "purchase").select("event_id", "user_id", "timestamp_ms",
                                                          "value_c100")
    right = sp.where(F.col("series") == "error")
    return lk.asof_join(left, right, ["user_id"], "timestamp_ms", "timestamp_ms", ["value_c100"],
                        tie="event_id", tolerance_ms=ASOF_TOLERANCE_MS, prefix="err_")


@register("win_avg_sparse", SP + """
SELECT event_id, series, timestamp_ms,
  coalesce(CAST(avg(value_c100) OVER (PARTITION BY series ORDER BY timestamp_ms
    RANGE BETWEEN 18000000 PRECEDING AND 1 PRECEDING) AS DOUBLE), 0.0) / 100.0 AS avg_value_5h,
  coalesce(CAST(max(value_c100) OVER (PARTITION BY series ORDER BY timestamp_ms
    RANGE BETWEEN 18000000 PRECEDING AND 1 PRECEDING) AS DOUBLE), 0.0) / 100.0 AS max_value_5h
FROM sparse""")
def q_win_avg_sparse(spark, sf_dir):
    from faultline.operators.windows import FrameAgg, trailing_aggregates
    sp = fx.sparse(events(spark, sf_dir))
    out = trailing_aggregates(sp, "series", "timestamp_ms",
                              [FrameAgg("avg", "value_c100", 18_000_000, "avg_value_5h"),
                               FrameAgg("max", "value_c100", 18_000_000, "max_value_5h")],
                              default=0.0)
    return unscale(out.select("event_id", "series", "timestamp_ms", "avg_value_5h",
                              "max_value_5h"), ["avg_value_5h", "max_value_5h"])


PERIOD_MS = 300_000


def _periodic_sql():
    return ("periodic AS (SELECT machine_id, run * " + str(PERIOD_MS) + " AS written_at_ms, "
            + ", ".join(f"avg({s}) / 100.0 AS avg_{s}_1h" for s in SENSORS)
            + " FROM (SELECT *, unnest(range(CAST(ceil(timestamp_ms / " + str(PERIOD_MS)
            + ") AS BIGINT), CAST(ceil((timestamp_ms + 3600000) / " + str(PERIOD_MS)
            + ") AS BIGINT))) AS run FROM sensor_scaled) GROUP BY machine_id, run), "
            + "batch_store AS (" + " UNION ALL ".join(
                f"SELECT machine_id, '{n}' AS feature_name, {n} AS value, written_at_ms, "
                f"written_at_ms + {BATCH_TTL_SECONDS * 1000} AS expires_at_ms FROM periodic"
                for n in BATCH_FEATURES) + ")")


@register("periodic_materialize", VS + ", " + _periodic_sql() + " SELECT * FROM batch_store")
def q_periodic_materialize(spark, sf_dir):
    r = sensor_scaled(spark, sf_dir)
    return st.materialize_periodic(r, PERIOD_MS).withColumn("value", F.col("value") / F.lit(100.0))


ALL_NAMES = BATCH_FEATURES + STREAM_FEATURES


def _score_vector_sql():
    """Per reading and feature name, the latest write at or before the
    reading that has not expired: one ASOF LEFT JOIN per name."""
    from faultline.schemas import ORDERED_FEATURE_NAMES
    joins, picks = [], {}
    for i, n in enumerate(ALL_NAMES):
        joins.append(f"ASOF LEFT JOIN (SELECT * FROM all_writes WHERE feature_name = '{n}') w{i}"
                     f" ON ev.machine_id = w{i}.machine_id AND ev.timestamp_ms >= w{i}.written_at_ms")
        picks[n] = f"CASE WHEN w{i}.expires_at_ms > ev.timestamp_ms THEN w{i}.value END"
    cols = []
    for c in ORDERED_FEATURE_NAMES:
        if c in STREAM_FEATURES:
            cols.append(f"coalesce({picks[c]}, 0.0) AS {c}")
        elif c in picks:
            cols.append(f"{picks[c]} AS {c}")
        else:
            cols.append(f"ev.{c} AS {c}")
    return (VS + ", " + _periodic_sql() + ", " + _stream_writes_sql() + """,
all_writes AS (SELECT * FROM batch_store UNION ALL SELECT * FROM stream_store),
ev AS (SELECT machine_id, timestamp_ms, machine_type, """ + O.unscaled_sensors() + """ FROM sensor_scaled)
SELECT ev.machine_id, ev.timestamp_ms, """ + ", ".join(cols) + "\nFROM ev\n" + "\n".join(joins)
            + "\nWHERE " + " AND ".join(f"{picks[n]} IS NOT NULL" for n in BATCH_FEATURES))


@register("score_vector", _score_vector_sql())
def q_score_vector(spark, sf_dir):
    from faultline.operators.scoring import feature_vectors
    r = sensor_scaled(spark, sf_dir)
    store = q_periodic_materialize(spark, sf_dir).unionByName(_stream_writes(r))
    ev = unscale(r.select("machine_id", "timestamp_ms", "machine_type", *SENSORS), SENSORS)
    return feature_vectors(ev, store)


@register("feature_keys", VS + ", " + _melt_sql() + """
SELECT machine_id, feature_name,
  'feature:machine_id=' || CAST(machine_id AS VARCHAR) || ':' || feature_name AS feature_key
FROM batch_store""")
def q_feature_keys(spark, sf_dir):
    """PRJ-9: the store key of every materialised feature."""
    return st.with_keys(_batch_store(spark, sf_dir)).select("machine_id", "feature_name",
                                                            "feature_key")
