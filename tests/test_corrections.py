"""Inputs that earlier versions got wrong."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from faultline.functions.scalar import parse_number
from faultline.operators import split as sp
from faultline.operators.windows import FrameAgg, trailing_aggregates
from faultline.session import scratch_path
from faultline.sources.tables import read_table
from faultline.streaming import sources as ss
from faultline.streaming import windows as sw


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_replay_reads_a_directory_by_any_path(spark, tmp_path, scheme):
    ev = read_table(spark, SF_SMALL, "events")
    ev.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    out = scratch_path(spark, "replay")
    ss.run_available(ss.replay_events(spark, f"{scheme}{tmp_path}"), f"{out}/t", f"{out}/c")
    assert spark.read.parquet(f"{out}/t").count() == ev.count()


def test_special_values_touch_only_their_frames(spark):
    hour = 3_600_000
    rows = [(1000, float("nan")), (4 * hour - 1, 1.0), (4 * hour, 2.0), (6 * hour - 1, 1.0), (6 * hour, 2.0),
            (8 * hour, 1e17), (10 * hour - 2, 1.0), (10 * hour - 1, 2.0), (10 * hour, 3.0), (12 * hour, float("inf")),
            (14 * hour - 1, -1.0), (14 * hour, 5.0)]
    df = spark.createDataFrame([(1, t, v) for t, v in rows], "k int, t long, v double")
    aggs = [FrameAgg("avg", "v", hour, "a"), FrameAgg("max", "v", hour, "m"), FrameAgg("sum", "v", 2 * hour + 1, "s")]
    plain = {r.t: (r.a, r.m, r.s) for r in trailing_aggregates(df, "k", "t", aggs, bucket_ms=None).collect()}
    got = {r.t: (r.a, r.m, r.s) for r in trailing_aggregates(df, "k", "t", aggs).collect()}
    assert {k: tuple(map(str, v)) for k, v in got.items()} == {k: tuple(map(str, v)) for k, v in plain.items()}
    assert got[4 * hour][0] == 1.0 and got[10 * hour][:2] == (1.5, 2.0) and got[14 * hour][0] == -1.0


def test_dense_machine_is_linear_in_rows(spark):
    """Rows at every millisecond of a minute-long frame: no frame is aggregated anew."""
    df = spark.range(0, 30_000).select(F.lit(1).alias("k"), F.col("id").alias("t"), (F.col("id") * 7919 % 10007).cast("double").alias("v"))
    out = trailing_aggregates(df, "k", "t", [FrameAgg("max", "v", 10_000, "m"), FrameAgg("count", "v", 10_000, "c")])
    got = {r.t: (r.m, r.c) for r in out.where("t % 2999 = 0").collect()}
    for t, (m, c) in got.items():
        frame = [x * 7919 % 10007 for x in range(max(0, t - 10_000), t)]
        assert c == len(frame) and m == (float(max(frame)) if frame else None)


def test_undersample_keeps_every_label_exactly(spark):
    df = spark.createDataFrame([(i, [0, 1, 2, None][i % 4] if i % 20 else 1) for i in range(400)], "id int, faulty int")
    assert sp.undersample(df, target_rows=1000).count() == 400
    got = {r.faulty: r["count"] for r in sp.undersample(df, target_rows=100).groupBy("faulty").count().collect()}
    sizes = {r.faulty: r["count"] for r in df.groupBy("faulty").count().collect()}
    assert got == {k: round(n / 4) for k, n in sizes.items()}


def test_positions_of_identical_rows(spark, monkeypatch):
    monkeypatch.setattr(sp, "COPY_CHUNK", 64)
    df = spark.createDataFrame([("a", 5, 1)] * 1000 + [("a", 5, 2), ("b", 5, 1), ("a", 4, None)], "k string, t long, e int")
    got = sp.running_position(df, ["k"], "t", ["e"]).collect()
    assert sorted(r.position for r in got if r.k == "a") == list(range(1, 1003))
    assert [(r.t, r.e) for r in got if r.k == "a" and r.position == 1] == [(4, None)]
    assert [r.position for r in got if r.e == 2] == [1002]


def test_temporal_split_orders_below_a_millisecond(spark):
    df = spark.sql("SELECT timestamp_micros(1000000 + x) AS event_timestamp, 10 - x AS machine_id FROM range(10) AS r(x)")
    got = sp.temporal_split(df).orderBy("position").collect()
    assert [r.machine_id for r in got] == list(range(10, 0, -1)) and sum(r.is_train for r in got) == 8


def test_numbers_that_only_java_reads(spark):
    texts = ["1d", "2.5f", "0x1p3", "None", "", " 7 ", "-1.5e3", ".5", "5.", "+3", "nan", "1 2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_number("t").alias("x"))
    got = {r.t: r.x for r in df.collect()}
    assert [got[t] for t in texts[:5]] == [None] * 5 and got["1 2"] is None and math.isnan(got["nan"])
    assert (got[" 7 "], got["-1.5e3"], got[".5"], got["5."], got["+3"]) == (7.0, -1500.0, 0.5, 5.0, 3.0)


def test_alerts_carry_the_whole_reading(spark):
    df = spark.createDataFrame([(1, 1000, 9.0, "x"), (1, 2000, 1.0, "y")], "machine_id int, timestamp_ms long, v double, note string") \
        .withColumn("event_time", F.timestamp_millis("timestamp_ms"))
    hits = sw.alerts(df, "v", 5.0).where("kind = 'threshold'").collect()
    assert [(r.machine_id, r.timestamp_ms, r.value, r.v, r.note) for r in hits] == [(1, 1000, 9.0, 9.0, "x")]


def test_malformed_and_late_readings(spark, tmp_path):
    """Readings without key or time go to the rejects; a late one within the
    grace finds its frame, an older one is dropped."""
    schema = "machine_id int, timestamp_ms long, v double"
    batches = [[(1, 0, 1.0), (1, 1000, 3.0), (1, 600_000, 5.0), (None, 5, 1.0), (2, None, 1.0)],
               [(1, 2000, 99.0), (1, 400_000, 7.0)]]
    src = f"{tmp_path}/in"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    out = scratch_path(spark, "late")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/{i}")
        ss.run_available(sw.sliding_features(stream, sensors=["v"]), f"{out}/t", f"{out}/c")
    got = {r.timestamp_ms: r.avg_v_5min for r in spark.read.parquet(f"{out}/t").collect()}
    assert got == {0: 1.0, 1000: 2.0, 600_000: 5.0, 400_000: 7.0}
    static = spark.createDataFrame(batches[0], schema)
    assert sw.rejects(static).count() == 2 and sw.keyed(static).count() == 3
