"""Batch job entry points: training-table write with observed counts,
materialisation append, training + registration."""

import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from faultline.operators import store as st
from faultline.operators.feature_store import FeatureStore
from faultline.plans import jobs
from faultline.plans.registry import sensor
from faultline.schemas import BATCH_FEATURES, SENSOR_SCHEMA


def raw_readings(spark, d):
    s = sensor(spark, "/root/testdata/sf0.001").select(*[f.name for f in SENSOR_SCHEMA.fields])
    s.write.parquet(f"{d}/raw")
    return f"{d}/raw"


def test_training_table_job_counts_rows_once(spark):
    d = tempfile.mkdtemp(prefix="faultline-test-jobs-")
    counts = jobs.training_table_job(spark, raw_readings(spark, d), f"{d}/features")
    back = spark.read.parquet(f"{d}/features")
    assert counts == {"rows": 988, "positives": back.where("faulty = 1").count()} and back.count() == 988


def test_missing_input_raises(spark):
    """SRC-3: both batch sources refuse a path that isn't there."""
    from faultline.sources.tables import load_readings, load_training_table
    for load in (load_readings, load_training_table):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            load(spark, "/nonexistent/readings")


def test_materialize_job_appends_visible_batch_features(spark):
    d = tempfile.mkdtemp(prefix="faultline-test-jobs-")
    raw = raw_readings(spark, d)
    jobs.materialize_job(spark, raw, f"{d}/store", as_of_ms=None)
    jobs.materialize_job(spark, raw, f"{d}/store", as_of_ms=None)   # a re-run replaces its write
    store = spark.read.parquet(f"{d}/store")
    assert store.count() == 12 * len(BATCH_FEATURES)
    versioned = FeatureStore(spark, f"{d}/versioned")
    for _ in range(2):
        jobs.materialize_job(spark, raw, versioned)
    assert versioned.read().drop("write_seq").exceptAll(store.select(versioned.read().drop("write_seq").columns)).count() == 0
    assert versioned.read().count() == store.count()
    cur = st.current(store)
    assert cur.count() == 12 * len(BATCH_FEATURES)
    end = spark.read.parquet(raw).agg(F.max("timestamp_ms")).first()[0]
    assert st.current(store, end + 3_600_000 - 1).count() == 48
    assert st.current(store, end + 3_600_000).count() == 0


def test_training_job_logs_a_run(spark):
    d = tempfile.mkdtemp(prefix="faultline-test-jobs-")
    jobs.training_table_job(spark, raw_readings(spark, d), f"{d}/features")
    row = jobs.training_job(spark, f"{d}/features", f"{d}/models", f"{d}/runs").first()
    assert row.version == 1 and row.n_estimators == 80 and row.max_depth == 8
    assert 0.0 <= row.f1_fault <= 1.0
    import json
    ex = json.loads(row.input_example)
    assert len(ex) == 3 and list(ex[0])[0] == "temperature_C" and "machine_type" in ex[0]
