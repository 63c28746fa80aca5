"""Published records that appear exactly once (SNK-2, ST-8).

A job publishes keyed records (key, value, headers) per micro-batch.  The
records of an epoch are staged as Parquet files under a name of their own and become
visible by one ledger entry, a small file that is published whole or not at all.
An epoch that failed before its entry leaves only files that no entry names; its
replay stages them anew.  An epoch that failed after its entry finds it on
replay and publishes nothing.  So a consumer that reads by the ledger sees each epoch
once, whole, and in the order of epochs.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.sources import files

SCHEMA = "key string, value string, headers array<struct<key:string,value:binary>>"


class RecordLog:
    """A topic as files: ``publish`` per epoch, ``read`` a range of epochs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entry(self, epoch: int) -> str:
        return f"{self.path}/ledger/{epoch:015d}.json"

    def epochs(self) -> list[int]:
        return [int(n[:-5]) for n in files.children(self.spark, f"{self.path}/ledger") if n.endswith(".json")]

    def publish(self, records: DataFrame, epoch: int) -> bool:
        """Make the records (``SCHEMA``) of an epoch visible; false if the epoch is there already."""
        if epoch in self.epochs():
            return False
        staged = f"{epoch:015d}-{uuid.uuid4().hex[:12]}"
        records.select("key", "value", "headers").write.parquet(f"{self.path}/data/{staged}")
        if files.publish(self.spark, self._entry(epoch), json.dumps({"data": staged})):
            return True
        files.remove(self.spark, f"{self.path}/data/{staged}")  # another attempt of the epoch was first
        return False

    def read(self, after: int = -1, upto: int | None = None) -> DataFrame:
        """The records of the epochs after one, with their ``epoch``."""
        names = [json.loads(files.read_text(self.spark, self._entry(e)))["data"]
                 for e in self.epochs() if e > after and (upto is None or e <= upto)]
        if not names:
            return self.spark.createDataFrame([], SCHEMA + ", epoch long")
        folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
        return (self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/data/{n}" for n in names])
                .withColumn("epoch", F.substring_index(folder, "-", 1).cast("long")))

    def clean(self) -> list[str]:
        """Delete what failed attempts left.  No writer may be at work."""
        live = {json.loads(files.read_text(self.spark, self._entry(e)))["data"] for e in self.epochs()}
        gone = [n for n in files.children(self.spark, f"{self.path}/data") if n not in live]
        for n in gone:
            files.remove(self.spark, f"{self.path}/data/{n}")
        return gone
