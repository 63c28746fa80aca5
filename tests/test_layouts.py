"""Hour folders and the table in global order."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from faultline.operators import ordered
from faultline.operators import split as sp
from faultline.operators import store as st
from faultline.operators.feature_store import FeatureStore
from faultline.plans import jobs
from faultline.schemas import ONE_HOUR_MS, SENSOR_SCHEMA
from faultline.sources import hourly
from faultline.sources.tables import load_readings


def folder(name):
    return tempfile.mkdtemp(prefix="faultline-test-layout-") + "/" + name


def readings(spark, hours, per_hour=20):
    rows = [(i % 3, h * ONE_HOUR_MS + i * 90_000, float(i), float(h), 1.0, 2.0, "A", 0)
            for h in hours for i in range(per_hour)]
    return spark.createDataFrame(rows, SENSOR_SCHEMA)


def averages(df):
    return sorted(tuple(r) for r in df.collect())


def test_only_the_last_hours_are_read(spark):
    df, path = readings(spark, range(100, 110)), folder("r")
    hourly.write_hourly(df, path)
    assert hourly.hours(spark, path) == list(range(100, 110))
    for h in range(100, 108):   # not readable any more
        for f in glob.glob(f"{path}/{hourly.HOUR}={h}/*.parquet"):
            with open(f, "wb") as out:
                out.write(b"gone")
    assert averages(st.latest_window_avg(hourly.recent(spark, path))) == averages(st.latest_window_avg(df))
    as_of = 109 * ONE_HOUR_MS + 400_000
    assert averages(st.latest_window_avg(hourly.recent(spark, path, as_of_ms=as_of), as_of_ms=as_of)) \
        == averages(st.latest_window_avg(df, as_of_ms=as_of))
    with pytest.raises(Exception):
        hourly.load_hourly(spark, path).agg(F.sum("temperature_C")).collect()


def test_hours_are_replaced_and_edges(spark):
    path = folder("r")
    hourly.write_hourly(readings(spark, [-1, 0, 5]), path)
    hourly.write_hourly(readings(spark, [5], per_hour=7), path)
    counts = {r[0]: r[1] for r in hourly.load_hourly(spark, path).groupBy(hourly.HOUR).count().collect()}
    assert counts == {-1: 20, 0: 20, 5: 7}
    os.makedirs(f"{path}/{hourly.HOUR}=9")   # an empty folder is passed over
    assert averages(st.latest_window_avg(hourly.recent(spark, path))) == averages(
        st.latest_window_avg(readings(spark, [5], per_hour=7)))
    long = st.latest_window_avg(hourly.recent(spark, path, 6 * ONE_HOUR_MS), 6 * ONE_HOUR_MS)
    assert averages(long) == averages(st.latest_window_avg(hourly.load_hourly(spark, path), 6 * ONE_HOUR_MS))
    none = folder("none")
    hourly.write_hourly(readings(spark, [1]).limit(0), none)
    assert hourly.recent(spark, none).collect() == []
    with pytest.raises(AnalysisException):
        hourly.recent(spark, folder("missing"))
    with pytest.raises(AnalysisException):
        load_readings(spark, folder("missing"))
    nullable = readings(spark, [1]).withColumn("timestamp_ms", F.lit(None).cast("bigint"))
    with pytest.raises(Exception, match="no timestamp_ms"):
        hourly.write_hourly(nullable, folder("null"))


def test_materialize_from_hour_folders(spark):
    df, path, flat = readings(spark, [3, 4, 5]), folder("r"), folder("flat")
    hourly.write_hourly(df, path)
    df.write.parquet(flat)
    stores = [FeatureStore(spark, folder("s")) for _ in range(2)]
    jobs.materialize_job(spark, path, stores[0], by_hour=True)
    jobs.materialize_job(spark, flat, stores[1])
    cols = ["machine_id", "feature_name", "value", "written_at_ms", "expires_at_ms"]
    a, b = (averages(s.read().select(*cols)) for s in stores)
    assert a == b and a


def test_ordered_table_agrees_with_positions(spark):
    df = spark.range(5000).select((F.col("id") % 7).cast("int").alias("machine_id"),
                                  F.timestamp_millis(F.pmod(F.hash("id"), F.lit(900)) * 1000).alias("event_timestamp"),
                                  (F.col("id") % 50).alias("v")).unionByName(
        spark.range(300).select(F.lit(1).alias("machine_id"), F.timestamp_millis(F.lit(5000)).alias("event_timestamp"),
                                F.lit(0).cast("bigint").alias("v")))   # equal rows
    path = folder("o")
    got = ordered.temporal_split(df, path)
    rows = got.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 5301))
    keys = [(r.event_timestamp, r.machine_id) for r in rows]
    assert keys == sorted(keys)
    assert [r.is_train for r in rows] == [k < 4240 for k in range(5300)]
    at = lambda d: sorted((r.event_timestamp, r.machine_id, r.position, r.is_train) for r in d.collect())
    assert at(got) == at(sp.temporal_split(df))
    # one range of the order per file, and no shuffle of rows on reading
    ranges = (spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy(ordered.RANGE)
              .agg(F.min("event_timestamp").alias("a"), F.max("event_timestamp").alias("b"),
                   F.count_distinct("f").alias("files")).orderBy(ordered.RANGE).collect())
    assert all(r.files == 1 for r in ranges) and all(p.b <= q.a for p, q in zip(ranges, ranges[1:]))
    again = ordered.temporal_split(df, folder("o"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))
    assert ordered.temporal_split(df.limit(0), folder("o")).collect() == []
