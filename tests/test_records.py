"""Published records: failed and replayed epochs appear once."""

import json
import tempfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_sliding import stream_of

from faultline.sources import files
from faultline.streaming.jobs import alert_writer
from faultline.streaming.records import RecordLog
from faultline.streaming.sources import decode_readings, encode_records


def folder():
    return tempfile.mkdtemp(prefix="faultline-test-topic-")


def frames(spark, *values):
    return encode_records(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "machine_id int, v string"), headers={"n": F.lit(7)})


def test_replay_and_order(spark):
    log = RecordLog(spark, folder())
    assert log.read().count() == 0 and log.epochs() == [] and log.clean() == []
    assert log.publish(frames(spark, "a", "é"), 0) and log.publish(frames(spark), 1) and log.publish(frames(spark, "c"), 2)
    assert not log.publish(frames(spark, "other"), 0)
    rows = log.read().collect()
    assert sorted((r.epoch, r.key, json.loads(r.value)["v"], r.headers[0].key, bytes(r.headers[0].value)) for r in rows) == [
        (0, "0", "a", "n", b"7"), (0, "1", "é", "n", b"7"), (2, "0", "c", "n", b"7")]
    assert [r.epoch for r in log.read(after=0).collect()] == [2] and log.read(upto=0).count() == 2 and log.read(after=2).count() == 0


def test_attempts_side_by_side_leave_one(spark, monkeypatch):
    """A second attempt of an epoch publishes while the first one stages."""
    log = RecordLog(spark, folder())
    publish, done = files.publish, []

    def slow(spark_, path, text):
        if not done:
            done.append(True)
            assert log.publish(frames(spark, "second"), 5)
        return publish(spark_, path, text)

    monkeypatch.setattr(files, "publish", slow)
    assert not log.publish(frames(spark, "first"), 5)
    assert [json.loads(r.value)["v"] for r in log.read().collect()] == ["second"] and log.clean() == []


@pytest.mark.parametrize("after_entry", [False, True])
def test_failed_epoch_appears_once_after_the_restart(spark, monkeypatch, after_entry):
    """The job dies between staging and the entry, or between the entry and the checkpoint's commit."""
    batches = [[(1, 1000, 5.0), (1, 2000, 7.5)], [(2, 15_000, 9.0)], [(1, 40_000, 8.0)]]
    stream, out = stream_of(spark, batches), folder()
    log = RecordLog(spark, f"{out}/topic")
    publish, calls = files.publish, []

    def failing(spark_, path, text):
        calls.append(path)
        if len(calls) == 2:
            if after_entry:
                publish(spark_, path, text)
            raise OSError("lost")
        return publish(spark_, path, text)

    monkeypatch.setattr(files, "publish", failing)

    def start():
        alert_writer(stream, "temperature_C", 6.0, f"{out}/table", f"{out}/c", topic=log).awaitTermination()

    with pytest.raises(StreamingQueryException):
        start()
    start()
    got = sorted((json.loads(r.value)["kind"], r.key, json.loads(r.value)["value"]) for r in log.read().collect())
    assert [g for g in got if g[0] == "threshold"] == [("threshold", "1", 7.5), ("threshold", "1", 8.0), ("threshold", "2", 9.0)]
    assert [g for g in got if g[0] == "window_mean"] == [("window_mean", "1", 6.25), ("window_mean", "2", 9.0)]
    assert len(log.clean()) == (0 if after_entry else 1) and len(log.read().collect()) == 5


def test_published_readings_are_decoded_with_their_headers(spark):
    """DOR-5, UDF-3: the under-load flag and the headers survive the round trip."""
    readings = spark.createDataFrame([(3, 5, 50.5, True, True), (4, 6, None, None, False)],
                                     "machine_id int, timestamp_ms long, temperature_C double, is_under_load boolean, faulty boolean")
    log = RecordLog(spark, folder())
    log.publish(encode_records(readings, headers={"origin": F.concat(F.lit("line-"), F.col("machine_id"))}), 0)
    got = decode_readings(log.read().withColumn("timestamp", F.current_timestamp())).orderBy("machine_id").collect()
    assert [(r.key, r.timestamp_ms, r.temperature_C, r.is_under_load, r.faulty, bytes(r.headers[0].value)) for r in got] == [
        ("3", 5, 50.5, True, 1, b"line-3"), ("4", 6, None, None, 0, b"line-4")]
