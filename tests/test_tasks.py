"""Tasks of bounded size: the settings of shuffles that grow with the readings."""

from faultline.plans.registry import QUERIES
from faultline.session import TASK_CONF, bound_tasks


def test_settings_are_made_once_and_leave_those_of_the_session(spark):
    own = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    for name in TASK_CONF:
        spark.conf.unset(name)
    spark.conf.set(own, "3m")
    try:
        bound_tasks(spark)
        assert spark.conf.get(own) == "3m"
        assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 500
    finally:
        spark.conf.unset(own)


def test_training_table_is_shuffled_into_many_parts(spark):
    """The 8 partitions of the session, before: their size grew with the readings."""
    for name in TASK_CONF:
        spark.conf.unset(name)
    t = QUERIES["training_table"](spark, "/root/testdata/sf0.001")
    plan = t._jdf.queryExecution().executedPlan().toString()
    n = TASK_CONF["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    assert "hashpartitioning" in plan and f", {n})" in plan and ", 8)" not in plan


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def wait_for(condition):
    import time
    for _ in range(50):
        if condition():
            return True
        time.sleep(0.1)
    return False


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """They stayed until the driver collected garbage, so those of one step lay beside those of the next."""
    import tempfile

    from faultline.operators import store as st
    from faultline.operators.feature_store import FeatureStore
    from faultline.session import FREE_SHUFFLES, stored
    d = tempfile.mkdtemp(prefix="faultline-test-stored-")
    df = spark.range(0, 5000, 1, 4).selectExpr("id % 97 AS k", "id AS v").groupBy("k").agg({"v": "sum"})
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, "false")
    df.write.parquet(f"{d}/plain")
    assert shuffle_files(spark) - before  # what the test looks for
    before = shuffle_files(spark)
    back = stored(df, f"{d}/t")
    assert wait_for(lambda: not shuffle_files(spark) - before)
    assert sorted(back.collect()) == sorted(df.collect()) and back.schema == df.schema
    before = shuffle_files(spark)
    st.append(st.store_rows(df.selectExpr("k AS machine_id", "'a' AS feature_name", "k AS value"), 5, 60), f"{d}/s", "w")
    assert wait_for(lambda: not shuffle_files(spark) - before)
    assert spark.conf.get(FREE_SHUFFLES, "false") == setting
    assert FeatureStore(spark, f"{d}/f").append(st.store_rows(df.selectExpr("k AS machine_id", "'a' AS feature_name", "k AS value"), 5, 60), "w") == 0
    assert spark.conf.get(FREE_SHUFFLES, "false") == setting


def test_a_fit_keeps_no_node_ids():
    """One number per row and tree, on the executors' disks and in the shared folder."""
    from faultline.operators import model as ml
    assert ml.build_pipeline().getStages()[-1].getCacheNodeIds() is False


def test_positions_shuffle_whole_rows_twice(spark):
    """By all columns and for the closing window: offsets come as rows of that window, not by a join."""
    from pyspark.sql import functions as F

    from faultline.operators import split as sp
    df = spark.createDataFrame([(t, m, x) for t in (5, 5, 7, None) for m in (1, 1, 2, None) for x in ("a", "a", None)],
                               "t bigint, m int, x string")
    out = sp.global_position(df, ["t", "m"], F.col("t"), total_col="n")
    assert sorted(r.position for r in out.collect()) == list(range(1, 49)) and {r.n for r in out.collect()} == {48}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2


def test_blocks_carry_the_parts_of_their_length_only(spark):
    """A frame's rows had the sums and maxima of all frames in both shuffles."""
    from faultline.operators import windows as w
    df = spark.createDataFrame([(1, t, t) for t in range(1, 9)], "k int, ts bigint, v bigint")
    aggs = [w.FrameAgg("avg", "v", 4, "a"), w.FrameAgg("max", "v", 2, "b")]
    names, lengths = w._part_names(aggs), [2, 4]
    used = {n: [lengths.index(a.length_ms) for a in aggs if a.column == c and p in w._PARTS[a.agg]] for (c, p), n in names.items()}
    rows = w._blocks(w.time_parts(df, "k", "ts", aggs), ["k"], "ts", names, lengths, True, used).collect()
    top, total = names[("v", "x")], names[("v", "s")]
    assert {r["__i"] for r in rows if r[top] is not None} == {0} and {r["__i"] for r in rows if r[total] is not None} == {1}
    got = {r.ts: (r.a, r.b) for r in w.trailing_aggregates(df, "k", "ts", aggs, include_current=True).collect()}
    assert got[8] == (6.0, 8) and got[1] == (1.0, 1)


def test_what_is_visible_is_settled_before_the_join_with_the_events(spark):
    """The join shuffled a struct of time, tie, value and expiry for each name."""
    from faultline.operators import lookup as lk
    ev = spark.createDataFrame([(1, 10, "x"), (1, 200, "y"), (None, 10, "z"), (1, None, "u")], "machine_id int, timestamp_ms bigint, note string")
    s = spark.createDataFrame([(1, "a", 1.5, 5, 100), (1, "b", None, 7, 1000), (1, "b", 9.0, 6, 1000)],
                              "machine_id int, feature_name string, value double, written_at_ms bigint, expires_at_ms bigint")
    out = lk.enrich_asof(ev, s, ["a", "b"], fill_zero=["b"])
    assert {(r.note, r.a, r.b) for r in out.collect()} == {("x", 1.5, 0.0), ("y", None, 0.0), ("z", None, 0.0), ("u", None, 0.0)}
    above, _, below = out._jdf.queryExecution().optimizedPlan().toString().partition("Join ")
    assert "AS __seen0" in below and ".value" not in above
