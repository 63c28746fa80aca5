"""Stream sources and sinks: keyed JSON topics and file replays
(SRC-4..6, SNK-2, SNK-4).

No Kafka connector ships with this PySpark build and there is no broker, so
the topic functions are thin wrappers around ``format("kafka")``; the decode
and encode steps are plain column functions over ``(key, value, timestamp)``
frames and are tested on file streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from faultline.schemas import SENSORS, STREAM_SCHEMA
from faultline.sources import fixtures as fx

EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()),
    StructField("user_id", LongType()), StructField("event_type", StringType()),
    StructField("value", DoubleType()), StructField("props", StringType())])


def topic_source(spark: SparkSession, servers: str, topic: str,
                 starting: str = "latest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC-4 (``latest``) / SRC-5 (``earliest``): a keyed topic.

    ``max_offsets_per_trigger`` caps the records of one micro-batch (and so
    the rows one machine can bring into a keyed state operator at once);
    the backlog is read over more micro-batches, nothing is dropped."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
         .option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def decode_readings(frames: DataFrame) -> DataFrame:
    """SRC-6 + PRJ-6: key bytes -> machine id; JSON value -> reading columns
    (``faulty`` boolean -> int, PRJ-5).  Broker time is kept as
    ``broker_ts``, headers if the frames have them; event time is the payload
    ``timestamp_ms``.  A malformed value leaves its fields null (see
    ``windows.rejects``)."""
    kept = [F.col("headers")] if "headers" in frames.columns else []
    v = F.from_json(F.col("value").cast("string"), STREAM_SCHEMA)
    return frames.select(
        F.col("key").cast("string").alias("key"),
        F.col("timestamp").alias("broker_ts"), v.alias("r"), *kept).select(
        "key", "broker_ts", *kept,
        F.coalesce(F.col("r.machine_id"), F.col("key").try_cast("int")).alias("machine_id"),
        "r.timestamp_ms", *[f"r.{s}" for s in SENSORS], "r.machine_type",
        "r.is_under_load", F.col("r.faulty").cast("int").alias("faulty"))


def encode_records(df: DataFrame, key_col: str = "machine_id", headers: dict | None = None) -> DataFrame:
    """SNK-2 frame: string key + JSON object of all columns; ``headers`` (name
    to column) add the records' headers."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"),
                     *([_headers(headers)] if headers is not None else []))


def _headers(headers: dict) -> Column:
    if not headers:
        return F.array().cast("array<struct<key:string,value:binary>>").alias("headers")
    return F.array(*[F.struct(F.lit(n).alias("key"), c.cast("string").cast("binary").alias("value"))
                     for n, c in headers.items()]).alias("headers")


def topic_sink(frames: DataFrame, servers: str, topic: str, checkpoint: str):
    """SNK-2: write an encoded stream to a topic (thin wrapper)."""
    return (frames.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))


def replay_events(spark: SparkSession, sf_dir: str, max_files: int | None = None,
                  max_bytes: int | None = None) -> DataFrame:
    """The provided ``events`` table as a stream (file source), by any path
    that Spark can read.  The source wants a folder or a glob: as a glob, the
    table may be one file or a directory of part files.
    ``max_files`` or ``max_bytes`` (one of the two, bytes as an integer)
    caps one micro-batch; the rest follows in later micro-batches
    (``availableNow`` honours both)."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.parquet(f"{sf_dir.rstrip('/')}/[e]vents.parquet")


def reading_stream(spark: SparkSession, sf_dir: str, scaled: bool = False,
                   max_files: int | None = None) -> DataFrame:
    """Sensor readings derived from the replayed events, with an event-time
    column ``event_time``."""
    ev = replay_events(spark, sf_dir, max_files=max_files)
    r = fx.sensor_scaled(ev) if scaled else fx.sensor(ev)
    return r.withColumn("event_time", F.timestamp_millis("timestamp_ms"))


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append",
                  fmt: str = "parquet") -> None:
    """Run a streaming query over everything available, into a table."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(path))
    q.awaitTermination()
