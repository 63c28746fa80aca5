"""Sliding features in block state: doubles, released state, several tasks per machine, late readings."""

import math
import tempfile

import numpy as np
import pandas as pd
import pytest
from test_streaming import SCHEMA, write_batches

from faultline.streaming import sliding as sl
from faultline.streaming import sources as ss
from faultline.streaming.jobs import feature_writer

ONE = ["temperature_C"]


def stream_of(spark, batches):
    pdfs = [pd.DataFrame(b, columns=["machine_id", "timestamp_ms", "temperature_C"]).astype({"machine_id": "int32"}) for b in batches]
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(write_batches(pdfs))


def run(spark, batches, **kw):
    out = tempfile.mkdtemp(prefix="faultline-test-out-")
    ss.run_available(sl.tagged(stream_of(spark, batches), ONE, **kw), f"{out}/t", f"{out}/c")
    return f"{out}/c", sorted((r.machine_id, r.timestamp_ms, r.late, r.avg_temperature_C_5min, r.max_temperature_C_1min)
                              for r in spark.read.parquet(f"{out}/t").collect())


@pytest.mark.parametrize("first, means, tops", [
    (1e17, [1e17, 1.0, 1.5], [1e17, 1.0, 2.0]), (math.inf, [math.inf, 1.0, 1.5], [math.inf, 1.0, 2.0])])
def test_large_and_infinite_readings_stay_in_their_frames(spark, first, means, tops):
    for cut in (1, 3):
        rows = [(1, 0, first), (1, 400_000, 1.0), (1, 500_000, 2.0)]
        _, got = run(spark, [rows[:cut], rows[cut:]] if cut < 3 else [rows])
        assert [g[3] for g in got] == means and [g[4] for g in got] == tops


def test_frames_equal_brute_force_at_cut_and_block_edges():
    """Random times, on both sides of cut and block boundaries, against sums over the frame."""
    rng = np.random.default_rng(2)
    ts = np.unique(np.concatenate((rng.integers(0, 3000, 300), np.arange(0, 3000, 100), np.arange(99, 3000, 100))))
    v = rng.integers(-50, 50, (2, len(ts))).astype(float)
    for length in (1, 7, 100, 250, 2999, 10_000):
        total, top = sl.framed(ts, v, length, np.add), sl.framed(ts, v, length, np.maximum)
        for k, t in enumerate(ts):
            inside = (ts >= t - length) & (ts <= t)
            assert (total[:, k] == v[:, inside].sum(1)).all() and (top[:, k] == v[:, inside].max(1)).all()


def test_frames_reach_into_the_block_before(spark):
    """Blocks as short as the longest frame and far longer ones give the same rows, over several micro-batches."""
    rng = np.random.default_rng(4)
    batches = [[(int(m), int(t), float(rng.integers(0, 90))) for m in (1, 2) for t in np.sort(rng.integers(b * 150, b * 150 + 300, 60))]
               for b in range(3)]
    want = None
    for block in (40, 100, 5000):
        _, got = run(spark, batches, mean_ms=40, max_ms=25, grace_ms=100_000, block_ms=block)
        assert want is None or got == want
        want = got
    assert len(want) == 360 and not any(r[2] for r in want)


def test_null_is_ignored_and_nan_is_a_value(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1000, 3.0), (1, 2000, math.nan), (1, 70_000, 5.0)], SCHEMA)
    src = tempfile.mkdtemp(prefix="faultline-test-src-") + "/in"
    rows.write.parquet(src)
    out = tempfile.mkdtemp(prefix="faultline-test-out-")
    ss.run_available(sl.sliding_features(spark.readStream.schema(SCHEMA).parquet(src), ONE), f"{out}/t", f"{out}/c")
    got = {r.timestamp_ms: r for r in spark.read.parquet(f"{out}/t").collect()}
    assert got[0].avg_temperature_C_5min is None and got[0].max_temperature_C_1min is None
    assert got[1000].avg_temperature_C_5min == got[1000].max_temperature_C_1min == 3.0
    assert math.isnan(got[2000].avg_temperature_C_5min) and math.isnan(got[2000].max_temperature_C_1min)
    assert math.isnan(got[70_000].avg_temperature_C_5min) and got[70_000].max_temperature_C_1min == 5.0


def state_rows(spark, checkpoint):
    return spark.read.format("statestore").option("stateVarName", "parts").option("flattenCollectionTypes", True).load(checkpoint)


def test_a_hot_machine_is_spread_over_tasks(spark):
    """One machine's readings of one micro-batch, in blocks: the state lies in several partitions."""
    ckpt, got = run(spark, [[(1, t, 1.0) for t in range(0, 40_000, 10)]], mean_ms=500, max_ms=500, grace_ms=10**8)
    assert len(got) == 4000
    assert state_rows(spark, ckpt).select("partition_id").distinct().count() >= 4


def test_silent_machines_leave_no_state(spark):
    """Machine 1 stops; once the others' time has passed its blocks, nothing of it is kept."""
    batches = [[(1, t, 1.0) for t in range(0, 2000, 100)] + [(2, 0, 1.0)], [(2, 3000, 1.0)], [(2, 60_000, 1.0)], [(2, 61_000, 1.0)]]
    ckpt, got = run(spark, batches, mean_ms=500, max_ms=500, grace_ms=1000)
    assert len(got) == 24 and not any(r[2] for r in got)
    assert {r.machine_id for r in state_rows(spark, ckpt).select("key.machine_id").collect()} == {2}


def test_late_readings_come_out_tagged_and_change_nothing(spark):
    batches = [[(1, 100_000, 1.0)], [(1, 101_000, 2.0)], [(1, 50_000, 99.0), (1, 99_500, 3.0), (1, 102_000, 4.0)]]
    _, got = run(spark, batches, mean_ms=60_000, max_ms=60_000, grace_ms=2000)
    assert [(r[1], r[2]) for r in got] == [(50_000, True), (99_500, False), (100_000, False), (101_000, False), (102_000, False)]
    assert got[0][3] is None and got[-1][3] == 2.5 and got[-1][4] == 4.0


def test_feature_writer_counts_late_readings(spark):
    sensors = ["temperature_C", "vibration_mm_per_s", "pressure_kPa", "rotor_speed_rpm"]
    batches = [pd.DataFrame({"machine_id": np.int32(1), "timestamp_ms": ts, **{s: 1.0 for s in sensors}})
               for ts in ([1_000_000], [1_001_000], [5, 10, 1_002_000])]
    src = write_batches(batches, ["machine_id", "timestamp_ms", *sensors])
    stream = spark.readStream.schema("machine_id int, timestamp_ms bigint, " + ", ".join(f"{s} double" for s in sensors)) \
        .option("maxFilesPerTrigger", 1).parquet(src)
    out = tempfile.mkdtemp(prefix="faultline-test-out-")
    feature_writer(stream, f"{out}/s", f"{out}/c", late_path=f"{out}/late").awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{out}/late").select("machine_id", "late_readings", "first_ms", "last_ms").collect()] \
        == [(1, 2, 5, 10)]
    assert spark.read.parquet(f"{out}/s").count() == 3 * 8
