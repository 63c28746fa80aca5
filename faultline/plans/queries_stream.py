"""Streaming queries: each runs a Structured Streaming job over the replayed
``events`` file (``availableNow``) into a table under the shared checkpoint
folder and returns that table."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import split as sp
from faultline.plans import oracle_sql as O
from faultline.plans.registry import register, sensor, sensor_scaled, unscale
from faultline.schemas import SENSORS, STREAM_FEATURES
from faultline.session import ensure_utc, scratch_path, stored
from faultline.sources import fixtures as fx
from faultline.streaming import counts
from faultline.streaming import sources as ss
from faultline.streaming import windows as sw

VS = O.with_views(O.SENSOR_INT, O.SENSOR_SCALED)
V = O.with_views(O.SENSOR_INT, O.SENSOR)


def _run(spark, name, stream, mode="append"):
    base = scratch_path(spark, name)
    ss.run_available(stream, f"{base}/out", f"{base}/_checkpoint", mode)
    return spark.read.parquet(f"{base}/out")


@register("stream_tumbling_mean", VS + """
SELECT machine_id, w * 10000 AS window_start_ms, w * 10000 + 10000 AS window_end_ms,
  avg(temperature_C) / 100.0 AS mean_temperature_C, count(*) AS n
FROM (SELECT *, timestamp_ms // 10000 AS w FROM sensor_scaled) s
GROUP BY machine_id, w
HAVING w * 10000 + 10000 <= (SELECT max(timestamp_ms) FROM sensor_scaled) - 1000""")
def q_stream_tumbling_mean(spark, sf_dir):
    ensure_utc(spark)
    out = _run(spark, "tumbling", sw.tumbling_mean(ss.reading_stream(spark, sf_dir, scaled=True),
                                                   "temperature_C"))
    return unscale(out, ["mean_temperature_C"])


def _sliding_sql():
    cols = []
    for s in SENSORS:
        cols.append((f"avg_{s}_5min", O.win("avg", s, 300000, None, default=None)))
        cols.append((f"max_{s}_1min", O.win("max", s, 60000, None, default=None)))
    return VS + "SELECT machine_id, timestamp_ms, " + ", ".join(
        f"{O.spark_round(e, 2)} AS {n}" for n, e in cols) + " FROM sensor_scaled"


@register("stream_sliding_features", _sliding_sql())
def q_stream_sliding(spark, sf_dir):
    ensure_utc(spark)
    feats = _run(spark, "sliding", sw.sliding_features(ss.reading_stream(spark, sf_dir, scaled=True)))
    f = unscale(feats, STREAM_FEATURES)
    return f.select("machine_id", "timestamp_ms",
                    *[F.round(F.col(n), 2).alias(n) for n in STREAM_FEATURES])


@register("stream_double_special", V + ", sp AS (SELECT event_id, machine_id, timestamp_ms, " + O.SPECIAL + """ AS v FROM sensor),
w AS (SELECT machine_id, timestamp_ms,
  avg(v) OVER (PARTITION BY machine_id ORDER BY timestamp_ms RANGE BETWEEN 300000 PRECEDING AND CURRENT ROW) AS a300,
  max(v) OVER (PARTITION BY machine_id ORDER BY timestamp_ms RANGE BETWEEN 60000 PRECEDING AND CURRENT ROW) AS m60,
  avg(v) OVER (PARTITION BY machine_id ORDER BY timestamp_ms RANGE BETWEEN 4000 PRECEDING AND CURRENT ROW) AS a4,
  max(v) OVER (PARTITION BY machine_id ORDER BY timestamp_ms RANGE BETWEEN 9000 PRECEDING AND CURRENT ROW) AS m9 FROM sp)
SELECT machine_id, timestamp_ms, """ + ", ".join(f"{O.shown(n)} AS {n}" for n in ("a300", "m60", "a4", "m9")) + " FROM w")
def q_stream_double_special(spark, sf_dir):
    """ST-1, ST-2 on DOUBLE readings with null, NaN, infinity and huge values,
    with the production frames and with short ones, whose state blocks are short."""
    ensure_utc(spark)
    readings = ss.reading_stream(spark, sf_dir).withColumn("v", fx.special())
    long = _run(spark, "special", sw.sliding_features(readings, ["v"]))
    short = _run(spark, "special-short", sw.sliding_features(readings, ["v"], mean_ms=4000, max_ms=9000))
    names = ["avg_v_5min", "max_v_1min"]
    one = long.select("machine_id", "timestamp_ms", *[fx.shown(a, b) for a, b in zip(names, ("a300", "m60"))])
    other = short.select("machine_id", "timestamp_ms", *[fx.shown(a, b) for a, b in zip(names, ("a4", "m9"))])
    return one.join(other, ["machine_id", "timestamp_ms"])


@register("stream_json_decode", V + """
SELECT event_id, CAST(machine_id AS VARCHAR) AS key, machine_id,
  CASE WHEN event_id % 97 <> 5 THEN timestamp_ms END AS timestamp_ms,
  CASE WHEN event_id % 97 <> 5 THEN temperature_C END AS temperature_C,
  CASE WHEN event_id % 97 <> 5 THEN rotor_speed_rpm END AS rotor_speed_rpm,
  CASE WHEN event_id % 97 <> 5 THEN machine_type END AS machine_type,
  CASE WHEN event_id % 97 <> 5 AND event_id % 3 <> 0 THEN rotor_speed_rpm > 1500 END AS is_under_load,
  CASE WHEN event_id % 97 <> 5 THEN faulty END AS faulty, event_id % 97 = 5 AS rejected
FROM sensor""")
def q_stream_json_decode(spark, sf_dir):
    """SRC-6 on a stream: keyed JSON records with headers, some of them
    malformed and some without the under-load field (DOR-5), decoded from
    files; what has no key or time is rejected."""
    ensure_utc(spark)
    s = sensor(spark, sf_dir)
    payload = F.to_json(F.struct("machine_id", "timestamp_ms", *SENSORS, "machine_type",
                                 F.when(F.col("event_id") % 3 != 0, F.col("rotor_speed_rpm") > 1500).alias("is_under_load"),
                                 (F.col("faulty") == 1).alias("faulty")))
    frames = s.select(
        F.col("machine_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 97 == 5, F.lit('{"machine_id": ')).otherwise(payload).cast("binary").alias("value"),
        F.current_timestamp().alias("timestamp"),
        F.array(F.struct(F.lit("event").alias("key"), F.col("event_id").cast("string").cast("binary").alias("value")))
        .alias("headers"))
    base = scratch_path(spark, "records")
    frames.write.parquet(f"{base}/topic")
    decoded = ss.decode_readings(spark.readStream.schema(frames.schema).parquet(f"{base}/topic"))
    bad = F.col("machine_id").isNull() | F.col("timestamp_ms").isNull()
    ss.run_available(decoded.withColumn("rejected", bad), f"{base}/out", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/out").select(
        F.col("headers")[0]["value"].cast("string").cast("bigint").alias("event_id"), "key", "machine_id", "timestamp_ms",
        "temperature_C", "rotor_speed_rpm", "machine_type", "is_under_load", "faulty", "rejected")


@register("stream_running_count", VS + """
SELECT machine_id, event_id, timestamp_ms,
  count(*) OVER (PARTITION BY machine_id ORDER BY timestamp_ms, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_count
FROM sensor_scaled""")
def q_stream_running_count(spark, sf_dir):
    ensure_utc(spark)
    base = scratch_path(spark, "running_count")
    counts.count_writer(ss.reading_stream(spark, sf_dir), f"{base}/out", f"{base}/_checkpoint").awaitTermination()
    return counts.read_counts(spark, f"{base}/out")


@register("running_count", VS + """
SELECT machine_id, event_id, timestamp_ms,
  count(*) OVER (PARTITION BY machine_id ORDER BY timestamp_ms, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_count
FROM sensor_scaled""")
def q_running_count(spark, sf_dir):
    r = sensor_scaled(spark, sf_dir).select("machine_id", "event_id", "timestamp_ms")
    return sp.running_position(r, ["machine_id"], "timestamp_ms", ["event_id"]) \
        .withColumnRenamed("position", "event_count")


_ALERTS_SQL = VS + """, t AS (
SELECT 'window_mean' AS kind, machine_id, w * 10000 AS window_start_ms, w * 10000 + 10000 AS window_end_ms,
  avg(temperature_C) / 100.0 AS value, CAST(NULL AS BIGINT) AS timestamp_ms,
  CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS DOUBLE) AS temperature_C, CAST(NULL AS DOUBLE) AS vibration_mm_per_s,
  CAST(NULL AS DOUBLE) AS pressure_kPa, CAST(NULL AS DOUBLE) AS rotor_speed_rpm, CAST(NULL AS VARCHAR) AS machine_type,
  CAST(NULL AS INTEGER) AS faulty
FROM (SELECT *, timestamp_ms // 10000 AS w FROM sensor_scaled) s
GROUP BY machine_id, w
HAVING w * 10000 + 10000 <= (SELECT max(timestamp_ms) FROM sensor_scaled) - 1000)
SELECT * FROM t
UNION ALL
SELECT 'threshold' AS kind, machine_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
  temperature_C / 100.0, timestamp_ms, event_id, temperature_C / 100.0, vibration_mm_per_s / 100.0,
  pressure_kPa / 100.0, rotor_speed_rpm / 100.0, machine_type, faulty FROM sensor_scaled WHERE temperature_C > 5000"""


@register("stream_alerts", _ALERTS_SQL)
def q_stream_alerts(spark, sf_dir):
    ensure_utc(spark)
    out = _run(spark, "alerts", sw.alerts(ss.reading_stream(spark, sf_dir, scaled=True),
                                          "temperature_C", threshold=5000.0))
    return unscale(out, ["value", *SENSORS])


@register("stream_published_records", _ALERTS_SQL.replace("\nSELECT * FROM t\nUNION ALL\n", ",\nu AS (SELECT * FROM t\nUNION ALL\n")
          + ")\nSELECT CAST(machine_id AS VARCHAR) AS key, kind AS header, kind, machine_id, window_start_ms, timestamp_ms, "
          "CAST(value AS DOUBLE) AS value, event_id, machine_type FROM u")
def q_stream_published_records(spark, sf_dir):
    """SNK-2 + ST-8: the alerts of a stream published as keyed JSON records
    with headers, in a run whose epochs are all replayed, and decoded again."""
    from faultline.streaming.jobs import alert_writer
    from faultline.streaming.records import RecordLog
    ensure_utc(spark)
    base = scratch_path(spark, "published")
    log = RecordLog(spark, f"{base}/topic")
    stream = ss.reading_stream(spark, sf_dir, scaled=True)
    for attempt in ("first", "replay"):  # a new checkpoint: the same epochs once more
        alert_writer(stream, "temperature_C", 5000.0, f"{base}/{attempt}", f"{base}/_checkpoint-{attempt}", topic=log).awaitTermination()
    fields = ("kind string, machine_id int, window_start_ms bigint, timestamp_ms bigint, value double, event_id bigint, "
              "machine_type string, temperature_C double")
    r = F.col("r")
    return log.read().select("key", F.col("headers")[0]["value"].cast("string").alias("header"),
                             F.from_json("value", fields).alias("r")).select(
        "key", "header", r["kind"].alias("kind"), r["machine_id"].alias("machine_id"), r["window_start_ms"].alias("window_start_ms"),
        r["timestamp_ms"].alias("timestamp_ms"),
        (r["value"] / F.lit(100.0)).alias("value"),
        r["event_id"].alias("event_id"), r["machine_type"].alias("machine_type"))


ASOF_GRACE_MS = 60_000


@register("stream_asof_lookup", O.with_views(O.SPARSE) + f""",
l AS (SELECT event_id, user_id, timestamp_ms, value_c100 FROM sparse WHERE series = 'purchase'),
r AS (SELECT user_id, timestamp_ms, value_c100 FROM sparse WHERE series = 'error'),
w AS (SELECT least((SELECT max(timestamp_ms) FROM l), (SELECT max(timestamp_ms) FROM r)) - {ASOF_GRACE_MS} AS watermark)
SELECT l.event_id, l.user_id, l.timestamp_ms, l.value_c100,
  CASE WHEN l.timestamp_ms - r.timestamp_ms <= {O.ASOF_TOLERANCE_MS} THEN r.value_c100 END AS err_value_c100,
  CASE WHEN l.timestamp_ms - r.timestamp_ms <= {O.ASOF_TOLERANCE_MS} THEN r.timestamp_ms END AS err_asof_ts
FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.timestamp_ms >= r.timestamp_ms
WHERE l.timestamp_ms < (SELECT watermark FROM w)""")
def q_stream_asof_lookup(spark, sf_dir):
    """JN-3 between two streams: ``asof_lookup``'s rule for every left event
    that the watermark has passed at the end of the replay."""
    from faultline.streaming.asof import asof_stream
    ensure_utc(spark)

    def series(name):
        sp = fx.sparse(ss.replay_events(spark, sf_dir)).where(F.col("series") == name)
        return sp.select("event_id", "user_id", "timestamp_ms", "value_c100")

    return _run(spark, "asof", asof_stream(series("purchase"), series("error"), ["user_id"], "timestamp_ms", "timestamp_ms",
                                           ["value_c100"], O.ASOF_TOLERANCE_MS, tie="event_id", prefix="err_", grace_ms=ASOF_GRACE_MS))


@register("stream_store_writes", VS + ", " + __import__(
    "faultline.plans.queries_store", fromlist=["x"])._stream_writes_sql() + " SELECT * FROM stream_store")
def q_stream_store_writes(spark, sf_dir):
    """C3 + SNK-4 as a streaming job: keyed sliding features appended to the
    long feature table through ``foreachBatch``; the table is read back."""
    from faultline.streaming.jobs import feature_writer
    ensure_utc(spark)
    base = scratch_path(spark, "store")
    feature_writer(ss.reading_stream(spark, sf_dir, scaled=True), f"{base}/store",
                   f"{base}/_checkpoint", unit_scale=100.0).awaitTermination()
    s = spark.read.parquet(f"{base}/store")
    return s.select("machine_id", "feature_name", "value", "written_at_ms", "expires_at_ms")


@register("stream_predictions")
def q_stream_predictions(spark, sf_dir):
    """C5 + ST-6: the scoring stream over replayed readings, with the store
    filled by periodic batch runs and the streaming feature writer."""
    from faultline.operators import store as st
    from faultline.plans.queries_model import _train
    from faultline.streaming.jobs import feature_writer, scorer
    ensure_utc(spark)
    from faultline.operators.feature_store import FeatureStore
    base = scratch_path(spark, "scoring")
    model, _ = _train(spark, sf_dir)
    readings = sensor_scaled(spark, sf_dir)
    store = FeatureStore(spark, f"{base}/store")
    store.append(st.materialize_periodic(unscale(readings, SENSORS), 300_000), "batch-periodic")
    feature_writer(ss.reading_stream(spark, sf_dir), store, f"{base}/_ckpt_features").awaitTermination()
    scorer(ss.reading_stream(spark, sf_dir), model, store, f"{base}/predictions",
           f"{base}/_ckpt_scoring").awaitTermination()
    return spark.read.parquet(f"{base}/predictions").drop("write_id")


LIVE_GRACE_MS = 60_000


def _scored_keys_sql(facts, where):
    """The readings that are scored, with facts that hold for each."""
    from faultline.plans.queries_store import _score_vector_sql
    head, _, vectors = _score_vector_sql().rpartition("\nSELECT ev.machine_id")
    return (f"{head},\nvectors AS (SELECT ev.machine_id{vectors})\n"
            f"SELECT machine_id, timestamp_ms, {facts} FROM vectors WHERE {where}")


@register("stream_prediction_facts", _scored_keys_sql(
    "true AS equals_batch, true AS flag_ok", f"timestamp_ms < (SELECT max(timestamp_ms) FROM sensor_scaled) - {LIVE_GRACE_MS}"))
def q_stream_prediction_facts(spark, sf_dir):
    """ML-6, PRJ-14, ST-6: readings and feature writes joined as two streams and
    scored, against the batch scoring of the same readings over the whole store.  Every
    reading with its batch features that the watermark has passed is there once;
    its record equals the batch one, and the flag follows the unrounded probability."""
    from faultline.operators import model as ml
    from faultline.operators.scoring import feature_vectors, prediction_records
    from faultline.plans.queries_model import _train
    from faultline.plans.queries_store import _stream_writes, q_periodic_materialize
    from faultline.schemas import FAULT_THRESHOLD
    from faultline.streaming.jobs import live_scorer
    ensure_utc(spark)
    base = scratch_path(spark, "live")
    model, _ = _train(spark, sf_dir)
    r = sensor_scaled(spark, sf_dir)
    store = stored(q_periodic_materialize(spark, sf_dir).unionByName(_stream_writes(r)), f"{base}/writes")
    live_scorer(ss.reading_stream(spark, sf_dir), spark.readStream.schema(store.schema).parquet(f"{base}/writes"), model,
                f"{base}/out", f"{base}/_checkpoint", grace_ms=LIVE_GRACE_MS).awaitTermination()
    ev = unscale(r.select("machine_id", "timestamp_ms", "machine_type", *SENSORS), SENSORS)
    raw = stored(ml.fault_probability(model, feature_vectors(ev, store)), f"{base}/raw")  # read twice
    keys = ["machine_id", "timestamp_ms"]
    batch = prediction_records(raw).select(*keys, F.col("faulty_proba").alias("p"), F.col("faulty").alias("f")) \
        .join(raw.select(*keys, F.col("faulty_proba_raw").alias("raw")), keys)
    live = spark.read.parquet(f"{base}/out")
    return live.join(batch, keys, "left").select(
        *keys, F.coalesce((F.col("faulty_proba") == F.col("p")) & (F.col("faulty") == F.col("f")), F.lit(False)).alias("equals_batch"),
        F.coalesce((F.col("faulty") == (F.col("raw") >= FAULT_THRESHOLD)) & F.col("faulty_proba").between(0, 1),
                   F.lit(False)).alias("flag_ok"))


@register("fault_prediction_facts", _scored_keys_sql("true AS probability_ok, true AS flag_ok, true AS rounded_ok", "true"))
def q_fault_prediction_facts(spark, sf_dir):
    """ML-6, PRJ-14 over history: every reading with its batch features has one
    record; its probability lies in [0, 1], the flag follows the unrounded one, and
    the published one is within half a thousandth of it."""
    from faultline.operators import model as ml
    from faultline.operators.scoring import feature_vectors, prediction_records
    from faultline.plans.queries_model import _train
    from faultline.plans.queries_store import _stream_writes, q_periodic_materialize
    from faultline.schemas import FAULT_THRESHOLD
    model, _ = _train(spark, sf_dir)
    r = sensor_scaled(spark, sf_dir)
    base = scratch_path(spark, "fault-prediction-facts")
    store = stored(q_periodic_materialize(spark, sf_dir).unionByName(_stream_writes(r)), f"{base}/writes")
    ev = unscale(r.select("machine_id", "timestamp_ms", "machine_type", *SENSORS), SENSORS)
    raw = stored(ml.fault_probability(model, feature_vectors(ev, store)), f"{base}/raw")  # read twice
    keys = ["machine_id", "timestamp_ms"]
    p = F.col("faulty_proba_raw")
    return prediction_records(raw).join(raw.select(*keys, p), keys).select(
        *keys, p.between(0, 1).alias("probability_ok"), (F.col("faulty") == (p >= FAULT_THRESHOLD)).alias("flag_ok"),
        (F.abs(F.col("faulty_proba") - p) <= 0.0005 + 1e-12).alias("rounded_ok"))


def _sliding_part(kind):
    names = [n for n in STREAM_FEATURES if n.startswith(kind)]

    def q(spark, sf_dir):
        return q_stream_sliding(spark, sf_dir).select("machine_id", "timestamp_ms", *names)

    sql = _sliding_sql().replace("SELECT machine_id, timestamp_ms, ", "SELECT * FROM (SELECT machine_id, timestamp_ms, ", 1) \
        + ") t"
    sql = sql.replace("SELECT * FROM (", "SELECT machine_id, timestamp_ms, " + ", ".join(names)
                      + " FROM (", 1)
    return q, sql


for _kind, _name in (("max_", "stream_sliding_max"), ("avg_", "stream_sliding_mean")):
    _q, _sql = _sliding_part(_kind)
    register(_name, _sql)(_q)


@register("alerts", VS + """, t AS (
SELECT 'window_mean' AS kind, machine_id, w * 10000 AS window_start_ms, w * 10000 + 10000 AS window_end_ms,
  avg(temperature_C) / 100.0 AS value, CAST(NULL AS BIGINT) AS timestamp_ms,
  CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS DOUBLE) AS temperature_C, CAST(NULL AS DOUBLE) AS vibration_mm_per_s,
  CAST(NULL AS DOUBLE) AS pressure_kPa, CAST(NULL AS DOUBLE) AS rotor_speed_rpm, CAST(NULL AS VARCHAR) AS machine_type,
  CAST(NULL AS INTEGER) AS faulty
FROM (SELECT *, timestamp_ms // 10000 AS w FROM sensor_scaled) s GROUP BY machine_id, w)
SELECT * FROM t
UNION ALL
SELECT 'threshold' AS kind, machine_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
  temperature_C / 100.0, timestamp_ms, event_id, temperature_C / 100.0, vibration_mm_per_s / 100.0,
  pressure_kPa / 100.0, rotor_speed_rpm / 100.0, machine_type, faulty FROM sensor_scaled WHERE temperature_C > 5000""")
def q_alerts(spark, sf_dir):
    """FLT-4 + SET-1 in batch form: every tumbling window (a batch has no
    open windows) plus the threshold rows, one tagged table."""
    r = sensor_scaled(spark, sf_dir).withColumn("event_time", F.timestamp_millis("timestamp_ms"))
    return unscale(sw.alerts(r, "temperature_C", threshold=5000.0), ["value", *SENSORS])
