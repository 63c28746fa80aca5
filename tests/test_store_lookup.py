"""Feature table: melt/pivot, expiry, cold start, parsing; as-of join."""

import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from faultline.functions.scalar import parse_number
from faultline.operators import lookup as lk
from faultline.operators import store as st

NAMES = ["f1", "f2"]


def test_melt_then_pivot_is_identity(spark):
    wide = spark.createDataFrame([(1, 1.5, 2.5), (2, 3.0, None)], "machine_id int, f1 double, f2 double")
    back = st.pivot(st.melt(wide, NAMES), NAMES)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def store_df(spark, rows):
    return spark.createDataFrame(rows, "machine_id int, feature_name string, value double, "
                                       "written_at_ms bigint, expires_at_ms bigint")


def test_expiry_boundary_and_overwrite(spark):
    s = store_df(spark, [(1, "f1", 1.0, 0, 60_000), (1, "f1", 2.0, 10_000, 20_000),
                         (2, "f1", 3.0, 0, 60_000)])
    at = {(r.machine_id, r.feature_name): r.value for r in st.current(s, 19_999).collect()}
    assert at == {(1, "f1"): 2.0, (2, "f1"): 3.0}
    # The latest write expired: the older, longer-lived one stays hidden.
    at = {(r.machine_id, r.feature_name): r.value for r in st.current(s, 20_000).collect()}
    assert at == {(2, "f1"): 3.0}
    assert st.current(s, 60_000).count() == 0


def test_cold_start_and_zero_fill(spark):
    ev = spark.createDataFrame([(1, 5), (2, 6)], "machine_id int, timestamp_ms bigint")
    s = store_df(spark, [(1, "f1", 1.0, 0, 100), (1, "f2", 2.0, 0, 100), (2, "f1", 3.0, 0, 100)])
    req = lk.enrich_current(ev, s, NAMES, 10, required=True).collect()
    assert [(r.machine_id, r.f1, r.f2) for r in req] == [(1, 1.0, 2.0)]
    opt = {r.machine_id: (r.f1, r.f2) for r in lk.enrich_current(ev, s, NAMES, 10, required=False).collect()}
    assert opt == {1: (1.0, 2.0), 2: (3.0, 0.0)}


def test_parse_number(spark):
    df = spark.createDataFrame([("12.5",), ("None",), ("abc",), (None,), (" 7 ",)], "v string")
    got = [r.p for r in df.select(parse_number("v").alias("p")).collect()]
    assert got == [12.5, None, None, None, 7.0]


def asof_brute(left, right, tol):
    out = []
    for _, l in left.iterrows():
        r = right[(right.k == l.k) & (right.t <= l.t)]
        if r.empty:
            out.append((l.id, None, None))
            continue
        r = r.sort_values(["t", "tie"]).iloc[-1]
        ok = tol is None or l.t - r.t <= tol
        out.append((l.id, float(r.v) if ok else None, int(r.t) if ok else None))
    return sorted(out, key=lambda x: x[0])


def test_asof_join_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    left = pd.DataFrame({"id": range(300), "k": rng.integers(0, 4, 300), "t": rng.integers(0, 100_000, 300)})
    right = pd.DataFrame({"k": rng.integers(0, 4, 80), "t": rng.integers(0, 100_000, 80),
                          "v": rng.integers(0, 50, 80).astype(float), "tie": range(80)})
    L, R = spark.createDataFrame(left), spark.createDataFrame(right)
    for tol in (None, 5_000):
        for bucket in (1_000, 7_000, 1_000_000):
            got = lk.asof_join(L, R, ["k"], "t", "t", ["v"], tie="tie", tolerance_ms=tol,
                               bucket_ms=bucket).select("id", "v", "asof_ts").collect()
            got = sorted([(r.id, r.v, r.asof_ts) for r in got], key=lambda x: x[0])
            assert got == asof_brute(left, right, tol), (tol, bucket)


def test_enrich_asof_respects_expiry(spark):
    ev = spark.createDataFrame([(1, 50), (1, 150), (1, 250)], "machine_id int, timestamp_ms bigint")
    s = store_df(spark, [(1, "f1", 1.0, 0, 100), (1, "f1", 2.0, 150, 200), (1, "f2", 9.0, 0, 10_000)])
    got = {r.timestamp_ms: (r.f1, r.f2) for r in lk.enrich_asof(ev, s, NAMES, bucket_ms=60).collect()}
    assert got == {50: (1.0, 9.0), 150: (2.0, 9.0), 250: (None, 9.0)}


def test_asof_join_hot_key_channels_nulls(spark):
    # One hot key with many left rows at the same ms, right rows sharing a
    # ms, gaps of empty buckets, a null-valued write overriding an older
    # value, null keys / times on the left, two channels.
    left = [(i, 1, 5_000) for i in range(200)] + [(200 + i, 1, 10 * i) for i in range(50)] \
        + [(300, 2, 99_999), (301, None, 5_000), (302, 1, None), (303, 3, 1)]
    right = [(1, 5_000, "a", 1.0, 0), (1, 5_000, "a", 2.0, 1), (1, 3_000, "a", None, 2),
             (1, 100, "b", 7.0, 3), (1, 2_500, "a", 3.0, 4), (2, 10, "b", 4.0, 5),
             (2, 60_000, "a", None, 6), (None, 0, "a", 9.0, 7)]
    L = spark.createDataFrame(left, "id int, k int, t long")
    R = spark.createDataFrame(right, "k int, t long, ch string, v double, tie long")
    for bucket in (700, 4_000, 1_000_000):
        got = lk.asof_join(L, R, ["k"], "t", "t", ["v"], tie="tie", bucket_ms=bucket,
                           channel="ch", channels=["a", "b"]).collect()
        got = {r.id: (r.a_v, r.a_asof_ts, r.b_v, r.b_asof_ts) for r in got}
        assert len(got) == len(left)
        for i, k, t in left:
            exp = []
            for ch in ("a", "b"):
                cand = [r for r in right if r[0] == k and k is not None and t is not None
                        and r[2] == ch and r[1] <= t]
                best = max(cand, key=lambda r: (r[1], r[4])) if cand else None
                exp += [best[3], best[1]] if best else [None, None]
            assert got[i] == tuple(exp), (bucket, i, got[i], exp)


def test_periodic_runs_match_brute_force(spark):
    from faultline.operators import store as st
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"machine_id": rng.integers(1, 4, 400).astype("int32"),
                        "timestamp_ms": rng.integers(0, 50_000, 400),
                        "x": rng.integers(0, 100, 400).astype("float64")})
    pdf.loc[pdf.machine_id == 3, "x"] = np.nan       # a machine with no values
    df = spark.createDataFrame(pdf)
    for period, window in ((1_000, 7_000), (3_000, 7_000), (5_000, 5_000)):
        got = st.materialize_periodic(df, period, window, sensors=["x"], suffix="w").collect()
        got = {(r.machine_id, r.written_at_ms): r.value for r in got}
        exp = {}
        for m, g in pdf.groupby("machine_id"):
            runs = set()
            for t in g.timestamp_ms:
                runs |= set(range(-(-t // period), -(-(t + window) // period)))
            for k in runs:
                T = k * period
                v = g[(g.timestamp_ms > T - window) & (g.timestamp_ms <= T)].x
                exp[(m, T)] = None if v.isna().all() else v.mean()
        assert got.keys() == exp.keys()
        for key, v in exp.items():
            assert (v is None and got[key] is None) or abs(got[key] - v) < 1e-9


def test_asof_input_is_shuffled_once(spark):
    """The long table's rows and the readings' times go through one shuffle, which both branches read."""
    wide = spark.createDataFrame([(1, 10, 1.5, 2.5), (2, 20, 3.0, None), (None, 20, 4.0, 5.0), (1, None, 6.0, 7.0)],
                                 "machine_id int, timestamp_ms bigint, f1 double, f2 double")
    writes = st.store_rows(st.melt(wide, NAMES, ("machine_id", "timestamp_ms")), F.col("timestamp_ms"), 60)
    ev = spark.createDataFrame([(1, 15), (2, 15), (2, 20), (None, 30), (1, None)], "machine_id int, timestamp_ms bigint")
    own = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lk.enrich_asof(ev, writes, NAMES)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, out.collect()), key=str)
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"- Exchange hashpartitioning\(machine_id#\d+, __b#\d+L", plan)) == 2  # input; carried rows
    assert "ReusedExchange [machine_id" in plan
    assert got == sorted([(1, 15, 1.5, 2.5), (2, 15, None, None), (2, 20, 3.0, None), (None, 30, None, None),
                          (1, None, None, None)], key=str)
