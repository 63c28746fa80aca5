"""As-of join of two streams (JN-3 and JN-1 "in streaming").

Each left row gets the last right row of its key at or before it, per channel,
if it is no older than the tolerance: the rule of ``operators.lookup.asof_join``,
without a table of writes to list and open in every micro-batch.

The state is keyed by key and time block.  A right row goes to its own block
and to those that its tolerance reaches into, so a block never needs another
one and a hot key runs in several tasks.  Left rows wait until the watermark
(the slower of both streams' latest times less their grace) has passed them,
as only then no right row before them can still come; an event-time timer lets
them out.  Of the right rows a block keeps the last one the watermark has passed,
per channel and unless it is out of tolerance, and those after it; at the end of
the block everything goes.

Rows older than the watermark are late: they change nothing and come out
tagged.  Rows without key or time come out of neither side (``windows.rejects``).
Of right rows at one time the one with the larger ``tie`` counts (null is the
smallest), then the larger by its JSON text, whatever the order of arrival.
Columns travel as JSON text, so any type that Spark writes to JSON and reads
back is kept.

Right rows are many times the left ones.  The state has them in parts, one Arrow
table for what a micro-batch brings, and they are sorted and looked up as columns;
of those at one time only the one that counts is kept.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultline.session import ship_package, use_rocksdb

GRACE_MS = 5 * 60 * 1000
OUT = "side STRING, late BOOLEAN, body STRING, hits STRING"
OUT_ROWS = 10_000
#: Parts that a block's right rows may consist of before they are merged into one.
MOST_PARTS = 16
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


class Writes:
    """Right rows of one (key, block) by channel and time (rising), at most one
    each: the one that counts."""

    def __init__(self, names, code, t, tie, body):
        self.names, self.code, self.t, self.tie, self.body = names, code, t, tie, body

    @classmethod
    def settled(cls, names, code, t, tie, body) -> Writes:
        """Rows in any order."""
        order = np.lexsort((tie, t, code))
        code, t, tie, body = code[order], t[order], tie[order], body[order]
        same = (code[1:] == code[:-1]) & (t[1:] == t[:-1])
        for k in np.flatnonzero(same & (tie[1:] == tie[:-1])):  # the larger text moves to the end
            if body[k] > body[k + 1]:
                body[k], body[k + 1] = body[k + 1], body[k]
        last = np.append(~same, True)[:len(t)]
        return cls(names, code[last], t[last], tie[last], body[last])

    @classmethod
    def read(cls, parts: list[bytes]) -> Writes:
        tables = [pa.ipc.open_stream(p).read_all() for p in parts]
        w = (pa.concat_tables(tables) if tables else cls.table([], [], [], [])).to_pandas()
        code, names = pd.factorize(w["channel"])
        return cls.settled(list(names), code, w["t"].to_numpy(np.int64), w["tie"].to_numpy(np.int64),
                           w["body"].to_numpy(object, copy=True))

    @staticmethod
    def table(t, tie, channel, body) -> pa.Table:
        return pa.table({"t": pa.array(t, pa.int64()), "tie": pa.array(tie, pa.int64()),
                         "channel": pa.array(channel, pa.string()), "body": pa.array(body, pa.string())})

    @staticmethod
    def stored(table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def where(self, kept: np.ndarray) -> bytes:
        return self.stored(self.table(self.t[kept], self.tie[kept], np.array([*self.names, None], object)[self.code[kept]],
                                      self.body[kept]))

    def channels(self) -> Iterator[tuple[str, slice]]:
        """Names and their rows; rows without a channel (code -1) meet none."""
        for c, name in enumerate(self.names):
            yield name, slice(*np.searchsorted(self.code, (c, c + 1)))

    def hits(self, at: np.ndarray, tolerance_ms: int) -> list[str]:
        """Per time the hit of each channel, as a JSON object."""
        found = []
        for name, rows in self.channels():
            t, body, label = self.t[rows], self.body[rows], json.dumps(name)
            k = np.searchsorted(t, at, side="right") - 1
            k[(k >= 0) & (at - t[k] > tolerance_ms)] = -1
            text = {int(i): f'{label}:{{"t":{t[i]},"v":{body[i]}}}' for i in np.unique(k) if i >= 0}
            found.append([text.get(i) for i in k.tolist()])
        return ["{" + ",".join(filter(None, some)) + "}" for some in zip(*found)] if found else ["{}"] * len(at)


class AsOf(StatefulProcessor):
    """Left rows of one (key, block) waiting for the watermark, and right rows."""

    def __init__(self, tolerance_ms: int, block_ms: int):
        self.tolerance_ms, self.block_ms = tolerance_ms, block_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t BIGINT, body STRING")
        self.writes = handle.getListState("writes", "part BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        first = None
        for pdf in rows:
            late = pdf["t"].to_numpy(np.int64) < watermark
            own = pdf["own"].to_numpy(bool)
            tardy = pdf[late & own]
            if len(tardy):
                yield pd.DataFrame({"side": np.where(tardy["left"].to_numpy(bool), "left", "right"), "late": True,
                                    "body": tardy["body"].to_numpy(), "hits": None})
            pdf = pdf[~late]
            left = pdf[pdf["left"].to_numpy(bool)]
            right = pdf[~pdf["left"].to_numpy(bool)]
            if len(left):
                self.waiting.appendList(list(zip(left["t"].tolist(), left["body"].tolist())))
                first = min(int(left["t"].min()), first if first is not None else 2**62)
            if len(right):
                part = Writes.table(right["t"].to_numpy(), right["tie"].to_numpy(), right["channel"].tolist(), right["body"].tolist())
                self.writes.appendValue((Writes.stored(part),))
        # once the watermark has passed the first waiting row, and when the block is over
        if first is not None:
            self.handle.registerTimer(first + 1)
        self.handle.registerTimer((int(key[-1]) + 1) * self.block_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(tuple(r) for r in self.waiting.get())
        parts = [bytes(r[0]) for r in self.writes.get()]
        writes = Writes.read(parts)
        ready = bisect_right(waiting, (watermark,))
        for a in range(0, ready, OUT_ROWS):
            some = waiting[a:min(ready, a + OUT_ROWS)]
            hits = writes.hits(np.array([t for t, _ in some], np.int64), self.tolerance_ms)
            yield pd.DataFrame({"side": "left", "late": False, "body": [b for _, b in some], "hits": hits})
        if watermark >= (int(key[-1]) + 1) * self.block_ms:
            self.waiting.clear()
            self.writes.clear()
            return
        if ready:
            self.waiting.put(waiting[ready:]) if ready < len(waiting) else self.waiting.clear()
        kept = writes.t + self.tolerance_ms >= watermark
        kept[writes.code < 0] = False
        for _, rows in writes.channels():
            last = max(int(np.searchsorted(writes.t[rows], watermark, side="right")) - 1, 0)
            kept[rows.start:rows.start + last] = False
        if not kept.any():
            self.writes.clear()
        elif not kept.all() or len(parts) > MOST_PARTS:
            self.writes.put([(writes.where(kept),)])
        if ready < len(waiting):
            self.handle.registerTimer(waiting[ready][0] + 1)

    def close(self) -> None:
        pass


def tagged(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, tolerance_ms: int,
           values: list[str], tie: str | None = None, channel: str | None = None, grace_ms: int = GRACE_MS,
           block_ms: int | None = None) -> DataFrame:
    """(side, late, body, hits) in JSON: left rows with the hit of each channel, and late rows of both sides."""
    spark = left.sparkSession
    ship_package(spark)
    use_rocksdb(spark)
    block_ms = block_ms or max(2 * tolerance_ms, 1)

    def pieces(df: DataFrame, ts: str, is_left: bool) -> DataFrame:
        t = F.col(ts).cast("long")
        own = F.floor(t / F.lit(block_ms)).cast("long")
        reach = own if is_left else F.floor((t + F.lit(tolerance_ms)) / F.lit(block_ms)).cast("long")
        body = F.struct(*[F.col(c) for c in (df.columns if is_left else values)])
        order = F.coalesce(F.col(tie).cast("long"), F.lit(-2**63)) if tie and not is_left else F.lit(0).cast("long")
        placed = df.where(t.isNotNull())
        for b in by:
            placed = placed.where(F.col(b).isNotNull())
        return (placed.withColumn("_at", F.timestamp_millis(t)).withWatermark("_at", f"{grace_ms} milliseconds")
                .select(*[F.col(b).alias(f"key{i}") for i, b in enumerate(by)], t.alias("t"), own.alias("_own"),
                        order.alias("tie"), F.lit(is_left).alias("left"),
                        (F.col(channel).cast("string") if channel and not is_left else F.lit("")).alias("channel"),
                        F.to_json(body, JSON).alias("body"), F.explode(F.sequence(own, reach)).alias("block"))
                .withColumn("own", F.col("_own") == F.col("block")).drop("_own"))

    both = pieces(left, left_ts, True).union(pieces(right, right_ts, False))
    return both.groupBy(*[f"key{i}" for i in range(len(by))], "block").transformWithStateInPandas(
        AsOf(tolerance_ms, block_ms), OUT, "append", "eventtime")


def asof_stream(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, values: list[str],
                tolerance_ms: int, tie: str | None = None, channel: str | None = None, channels: list[str] | None = None,
                prefix: str = "", grace_ms: int = GRACE_MS, block_ms: int | None = None) -> DataFrame:
    """Left rows with ``<prefix><value>`` and ``<prefix>asof_ts`` (with
    ``channel``: ``<prefix><channel>_<value>``), named as ``lookup.asof_join``
    does.  Rows come out when the watermark has passed them."""
    out = tagged(left, right, by, left_ts, right_ts, tolerance_ms, values, tie, channel, grace_ms, block_ms)
    row = T.StructType([T.StructField(f.name, f.dataType) for f in left.schema])
    value = T.StructType([T.StructField(v, right.schema[v].dataType) for v in values])
    hits = T.MapType(T.StringType(), T.StructType([T.StructField("t", T.LongType()), T.StructField("v", value)]))
    read = out.where("side = 'left' and not late").select(F.from_json("body", row, JSON).alias("l"),
                                                          F.from_json("hits", hits, JSON).alias("h"))
    cols = []
    for c in (channels if channel else [""]):
        name = f"{prefix}{c}_" if channel else prefix
        hit = F.col("h").getItem(c)
        cols += [hit["v"][v].alias(f"{name}{v}") for v in values]
        cols.append(hit["t"].alias(f"{name}asof_ts"))
    return read.select(*[F.col("l")[c].alias(c) for c in left.columns], *cols)
