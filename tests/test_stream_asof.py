"""As-of join of two streams: order of arrival, ties, tolerance, late rows, released state, hot keys."""

import datetime
import os
import random
import tempfile

import pytest

from faultline.streaming import asof
from faultline.streaming import sources as ss

LEFT = "k int, t bigint, i int, note string, at timestamp"
RIGHT = "k int, w bigint, tie bigint, c string, v double"


def source(spark, batches, schema):
    """A stream that gives one batch per micro-batch; an empty one is a file without rows."""
    d = tempfile.mkdtemp(prefix="faultline-test-src-")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/b{n}")
        for f in os.listdir(f"{d}/b{n}"):
            if f.endswith(".parquet"):
                os.utime(f"{d}/b{n}/{f}", (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/*")


def left_row(k, t, i, note="x"):
    return (k, t, i, note, datetime.datetime(2026, 1, 1, 0, 0, 0, 123456))


def run(spark, df):
    out = tempfile.mkdtemp(prefix="faultline-test-out-")
    ss.run_available(df, f"{out}/t", f"{out}/c")
    return spark.read.parquet(f"{out}/t"), f"{out}/c"


def brute(lefts, rights, tolerance, watermark):
    out = []
    for k, t, i, *_ in lefts:
        if k is not None and t is not None and t < watermark:
            best = max(((w, -2**63 if tie is None else tie, v) for key, w, tie, _, v in rights
                        if key == k and w is not None and t - tolerance <= w <= t), default=None)
            out.append((i, best and best[2], best and best[0]))
    return sorted(out)


@pytest.mark.parametrize("block", [50, 1000])
def test_equals_brute_force_over_micro_batches(spark, block):
    """Rows of both sides come out of order within the grace, with ties, nulls and repeated rows."""
    rng = random.Random(block)
    lefts = [[left_row(rng.choice([1, 1, 1, 2, None]), rng.randrange(b * 200, b * 200 + 400), 100 * b + n) for n in range(50)] for b in range(4)]
    rights = [[(rng.choice([1, 1, 2]), rng.randrange(b * 200, b * 200 + 400), rng.choice([None, 1, 2, 3]), None, float(1000 * b + n))
               for n in range(60)] for b in range(4)]
    lefts[3] += lefts[3][:2] + [left_row(1, None, 999)]
    end = min(max(r[1] for b in lefts for r in b if r[1] is not None and r[0] is not None), max(r[1] for b in rights for r in b)) - 500
    got, _ = run(spark, asof.asof_stream(source(spark, lefts, LEFT), source(spark, rights, RIGHT), ["k"], "t", "w", ["v"], 40,
                                         tie="tie", grace_ms=500, block_ms=block))
    flat, all_rights = sum(lefts, []), sum(rights, [])
    want = brute(flat, all_rights, 40, end)
    rows = got.collect()
    # equal time and tie: the larger JSON text, the same in every run
    same = [(a, b) for a, b in zip(sorted((r.i, r.v, r.asof_ts) for r in rows), want)]
    assert len(rows) == len(want) > 50
    for (i, v, t), (j, x, w) in same:
        assert (i, t) == (j, w) and ((v is None) == (x is None))
        ties = {r[2] for r in all_rights if r[1] == t and r[4] in (v, x)}
        assert v == x or len(ties) == 1
    assert {r.at for r in rows} == {datetime.datetime(2026, 1, 1, 0, 0, 0, 123456)} and {r.note for r in rows} == {"x"}


def test_channels_and_tolerance(spark):
    lefts = [[left_row(1, t, t) for t in (10, 20, 45, 90)], [left_row(2, 10_000, 0)]]
    rights = [[(1, 5, 0, "a", 1.0), (1, 20, 0, "b", 2.0), (1, 40, 0, "a", float("nan")), (1, 41, 0, "other", 9.0)], [(3, 10_000, 0, "a", 0.0)]]
    got, _ = run(spark, asof.asof_stream(source(spark, lefts, LEFT), source(spark, rights, RIGHT), ["k"], "t", "w", ["v"], 30,
                                         tie="tie", channel="c", channels=["a", "b", "none"], grace_ms=100))
    rows = {r.i: (r.a_v if r.a_v == r.a_v else "nan", r.a_asof_ts, r.b_v, r.none_v) for r in got.collect()}
    assert rows == {10: (1.0, 5, None, None), 20: (1.0, 5, 2.0, None), 45: ("nan", 40, 2.0, None), 90: (None, None, None, None)}


def test_late_rows_of_both_sides_are_tagged(spark):
    lefts = [[left_row(1, 1000, 1)], [left_row(1, 2000, 2)], [left_row(1, 500, 3), left_row(1, 3000, 4)]]
    rights = [[(1, 990, 0, "a", 1.0)], [(1, 2000, 0, "a", 2.0)], [(1, 400, 0, "a", 3.0), (1, 3000, 0, "a", 4.0)]]
    got, _ = run(spark, asof.tagged(source(spark, lefts, LEFT), source(spark, rights, RIGHT), ["k"], "t", "w", 100, ["v"], grace_ms=200))
    rows = got.collect()
    assert sorted((r.side, r.late) for r in rows) == [("left", False), ("left", False), ("left", True), ("right", True)]
    assert ['"i":3' in r.body for r in rows if r.late and r.side == "left"] == [True]


def test_state_is_released_and_a_hot_key_is_spread(spark):
    """Old blocks go, what waits stays; one key's rows lie in several partitions."""
    lefts = [[left_row(1, t, t) for t in range(0, 4000, 10)], [left_row(1, 1_000_000, 0)], [left_row(1, 1_000_001, 1)]]
    rights = [[(1, t, 0, "a", 1.0) for t in range(0, 4000, 10)], [(1, 1_000_000, 0, "a", 1.0)], [(1, 1_000_001, 0, "a", 1.0)]]

    def state(path, var):
        return spark.read.format("statestore").option("stateVarName", var).option("flattenCollectionTypes", True).load(path)

    joined = [asof.asof_stream(source(spark, a, LEFT), source(spark, b, RIGHT), ["k"], "t", "w", ["v"], 50, grace_ms=100)
              for a, b in ((lefts[:1], rights[:1]), (lefts, rights))]
    got, path = run(spark, joined[0])
    assert got.count() == 389  # up to the watermark
    assert state(path, "waiting").count() == 11
    got, path = run(spark, joined[1])
    assert got.count() == 400 and got.where("v is null").count() == 0
    assert {r.block for r in state(path, "writes").select("key.block").distinct().collect()} == {10_000}
    plenty = asof.asof_stream(source(spark, lefts[:1], LEFT), source(spark, rights[:1], RIGHT), ["k"], "t", "w", ["v"], 50, grace_ms=10**6)
    _, path = run(spark, plenty)
    assert state(path, "waiting").select("partition_id").distinct().count() >= 4


def test_live_scorer_equals_batch_scoring(spark):
    from faultline.operators import model as ml
    from faultline.operators import store as st
    from faultline.operators.scoring import feature_vectors, prediction_records
    from faultline.plans.queries_model import training
    from faultline.plans.queries_store import _stream_writes
    from faultline.plans.registry import sensor, sensor_scaled
    from faultline.schemas import SENSORS
    from faultline.streaming.jobs import live_scorer

    sf = "/root/testdata/sf0.001"
    model, _ = ml.train(training(spark, sf), n_trees=3, max_depth=3)
    d = tempfile.mkdtemp(prefix="faultline-test-live-")
    readings = sensor(spark, sf).select("machine_id", "timestamp_ms", "machine_type", *SENSORS)
    readings.repartition(3).write.parquet(f"{d}/r")
    st.materialize_periodic(readings, 10_000).unionByName(_stream_writes(sensor_scaled(spark, sf))).write.parquet(f"{d}/w")
    r, w = spark.read.parquet(f"{d}/r"), spark.read.parquet(f"{d}/w")
    live_scorer(spark.readStream.schema(r.schema).parquet(f"{d}/r"), spark.readStream.schema(w.schema).parquet(f"{d}/w"),
                model, f"{d}/out", f"{d}/c", grace_ms=20_000).awaitTermination()
    end = r.agg({"timestamp_ms": "max"}).first()[0] - 20_000
    names = ["machine_id", "timestamp_ms", "faulty_proba", "faulty"]
    got = sorted(tuple(x) for x in spark.read.parquet(f"{d}/out").select(names).collect())
    want = sorted(tuple(x) for x in prediction_records(ml.fault_probability(model, feature_vectors(r, w))).select(names).collect() if x[1] < end)
    assert got == want and len(got) > 500


def test_writes_are_kept_in_parts_and_one_per_time(spark):
    """Each row was an element of the state, whatever it counted for."""
    lefts = [[left_row(1, t, t) for t in range(0, 400)], [left_row(1, 500, 500)]]
    rights = [[(1, t, tie, c, float(t)) for t in range(0, 400) for tie in (None, 1, 2) for c in ("a", "b", None)], [(1, 500, 0, "a", 1.0)]]
    got, path = run(spark, asof.asof_stream(source(spark, lefts, LEFT), source(spark, rights, RIGHT), ["k"], "t", "w", ["v"], 50, tie="tie",
                                            channel="c", channels=["a", "b"], grace_ms=300))
    assert {(r.i, r.a_v, r.b_v) for r in got.collect()} == {(t, float(t), float(t)) for t in range(200)}
    parts = spark.read.format("statestore").option("stateVarName", "writes").option("flattenCollectionTypes", True).load(path)
    assert 0 < parts.count() < 20


@pytest.mark.parametrize("seed", range(3))
def test_the_write_that_counts(seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(5), rng.randrange(3), rng.choice(["a", "b", None]), f'{{"v":{rng.randrange(9)}}}') for _ in range(200)]
    parts = [asof.Writes.stored(asof.Writes.table(*map(list, zip(*rows[k::3])))) for k in range(3)]
    writes = asof.Writes.read(parts)
    want = {}
    for t, tie, c, body in rows:
        if c is not None:
            want[c, t] = max(want.get((c, t), (-1, "")), (tie, body))
    kept = asof.Writes.read([writes.where(writes.code >= 0)])
    for w in (writes, kept):
        assert {(n, int(t)): (int(tie), body) for n, s in w.channels() for t, tie, body in zip(w.t[s], w.tie[s], w.body[s])} == want
    assert asof.Writes.read([]).hits(asof.np.array([1, 2]), 5) == ["{}", "{}"]
