"""Small helpers of the operators: shared tables, bounded bit filters, components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import ensure_utc, scratch_path
from faultline.sources.tables import read_table

#: Rows of an Arrow batch: bounds what a Python worker holds at once.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with the session set up for the operators."""
    prepare(spark)
    return read_table(spark, sf_dir, name)


def prepare(spark: SparkSession) -> None:
    ensure_utc(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage in
    a way that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with all columns but the needed ones in one struct, so that
    their names can't clash with those of an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed]
    return docs.select(*needed, (F.struct(*others) if others else F.lit(True)).alias("_rest"))


def unboxed(df: DataFrame, columns: list[str], *needed: str) -> DataFrame:
    """The original columns, in their order, of a boxed frame."""
    return df.select(*[F.col(c) if c in needed else F.col("_rest").getField(c).alias(c) for c in columns])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class BitFilter:
    """A bitmap of fixed size over 64-bit keys: no false negatives.  Its size
    does not grow with the data, so it can be broadcast at any scale; false
    positives only cost work, as an exact join follows."""

    def __init__(self, keys: DataFrame, column: str, bits: int = 1 << 26):
        spark = keys.sparkSession
        self.bits = bits
        at = F.pmod(F.col(column), F.lit(bits))
        # the bitmap functions count positive values from 1
        rows = (keys.select((at + 1).alias("at"))
                .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")).collect())
        bitmap = np.zeros(bits // 8 + 4096, np.uint8)
        for r in rows:
            piece = np.frombuffer(bytes(r["map"]), np.uint8)
            first = (int(r["bucket"]) - 1) * 4096
            bitmap[first:first + len(piece)] |= piece
        self.bitmap = spark.sparkContext.broadcast(bitmap)

    def __getstate__(self):
        return {"bits": self.bits, "bitmap": self.bitmap}

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Which of the int64 keys may be among those the filter was built on."""
        at = np.mod(keys.astype(np.int64), self.bits)
        return (self.bitmap.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges.

    Alternating large-star and small-star steps; every step links nodes to the
    smallest neighbour seen, found with a partial aggregate, so no neighbour
    list is gathered.  Joins on a hot node can be split by AQE.  Each round is
    written to the shared folder.  Self-edges keep lone nodes."""
    e = stored(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
               .where("u is not null and v is not null").distinct(), "edges")
    last = None
    while True:
        # large star: every neighbour larger than u goes to u's smallest neighbour (or u)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v >= u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = stored(small, "star")
        now = e.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if last == (now["n"], now["h"]):
            break
        last = (now["n"], now["h"])
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
