"""Sliding features of live readings in keyed state (ST-1, ST-2, ST-7).

No built-in operator emits one value per event over ``[t - d, t]``.  The state
is keyed by ``(machine, time block)``, not by the machine alone, so that the
readings which a hot machine brings into one micro-batch run in several tasks.
A reading goes to its own block and, while a frame of a later block can still
reach it, to that block as well (a halo copy without output).

What a block keeps are mergeable summaries, one per distinct millisecond: per
sensor the sum, the number and the maximum of its readings.  A frame is put
together from them as in ``operators.windows``: time is cut at multiples of
the frame's length, a frame is the end of one cut and the beginning of the next,
and both are running aggregates.  Parts are added or compared, never subtracted, so a
NaN, an infinity or a huge value changes only the frames that hold it.  Nulls
are ignored; NaN counts as a value and as the largest one, as in the batch form.

A reading older than the watermark (the latest event time of earlier
micro-batches less the grace) is late: it changes no state and comes out
tagged, without features, for a side output.  An event-time timer at the end
of a block releases its state, so a silent machine leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultline.schemas import SENSORS, feature_name
from faultline.session import ship_package, use_rocksdb

MEAN_MS = 5 * 60 * 1000
MAX_MS = 60 * 1000
GRACE_MS = 5 * 60 * 1000
#: Parts that a block's state may consist of before they are merged into one.
MOST_PARTS = 16
OUT_ROWS = 10_000


class Summary:
    """Per distinct millisecond ``ts`` (rising): the number of readings that
    are to come out (``own``) and per sensor sum, number and maximum."""

    def __init__(self, ts, own, total, count, top):
        self.ts, self.own, self.total, self.count, self.top = ts, own, total, count, top

    @classmethod
    def grouped(cls, ts, own, total, count, top) -> Summary:
        """Entries of any order and repeated times, merged by time."""
        at, place = np.unique(ts, return_inverse=True)
        k, sensors = len(at), len(total)
        best = np.full((sensors, k), -np.inf)
        for i in range(sensors):
            np.maximum.at(best[i], place, top[i])  # NaN wins
        return cls(at, np.bincount(place, own, k).astype(np.int64),
                   np.stack([np.bincount(place, total[i], k) for i in range(sensors)]),
                   np.stack([np.bincount(place, count[i], k).astype(np.int64) for i in range(sensors)]), best)

    @classmethod
    def merged(cls, parts: list[Summary]) -> Summary:
        if len(parts) == 1:
            return parts[0]
        return cls.grouped(*(np.concatenate([getattr(p, f) for p in parts], axis=-1)
                             for f in ("ts", "own", "total", "count", "top")))

    def stored(self) -> tuple[bytes, bytes]:
        """The state's form; what has come out is not kept."""
        return np.vstack((self.ts, self.count)).tobytes(), np.vstack((self.total, self.top)).tobytes()

    @classmethod
    def read(cls, longs: bytes, doubles: bytes, sensors: int) -> Summary:
        n = np.frombuffer(bytes(longs), np.int64).reshape(sensors + 1, -1)
        x = np.frombuffer(bytes(doubles), np.float64).reshape(2 * sensors, -1)
        return cls(n[0], np.zeros(n.shape[1], np.int64), x[:sensors], n[1:], x[sensors:])


def running(values: np.ndarray, cuts: np.ndarray, how) -> tuple[np.ndarray, np.ndarray]:
    """Running aggregates from the beginning and to the end of each cut."""
    first, last = np.empty_like(values), np.empty_like(values)
    for a, b in zip(cuts[:-1], cuts[1:]):
        first[..., a:b] = how.accumulate(values[..., a:b], axis=-1)
        last[..., a:b] = how.accumulate(values[..., a:b][..., ::-1], axis=-1)[..., ::-1]
    return first, last


def framed(ts: np.ndarray, values: np.ndarray, length: int, how) -> np.ndarray:
    """The aggregate of ``values`` over ``[t - length, t]`` at each time."""
    cut = ts // length
    starts = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1])))
    first, last = running(values, np.append(starts, len(ts)), how)
    begin = starts[np.searchsorted(starts, np.arange(len(ts)), side="right") - 1]
    low = np.searchsorted(ts, ts - length, side="left")
    out = first.copy()
    before = low < begin
    out[..., before] = how(last[..., low[before]], first[..., before])
    return out


class SlidingFeatures(StatefulProcessor):
    """Means over ``mean_ms`` and maxima over ``max_ms`` of one (machine, block)."""

    def __init__(self, sensors: list[str], mean_ms: int, max_ms: int, block_ms: int):
        self.sensors, self.mean_ms, self.max_ms, self.block_ms = sensors, mean_ms, max_ms, block_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getListState("parts", "longs BINARY, doubles BINARY")

    def summary(self, pdf: pd.DataFrame) -> Summary:
        has = np.stack([pdf[f"has{i}"].to_numpy(bool) for i in range(len(self.sensors))])
        value = np.stack([pdf[f"v{i}"].to_numpy(np.float64) for i in range(len(self.sensors))])
        return Summary.grouped(pdf["timestamp_ms"].to_numpy(np.int64), pdf["own"].to_numpy(np.int64),
                               np.where(has, value, 0.0), has.astype(np.int64), np.where(has, value, -np.inf))

    def rows(self, machine: int, ts: np.ndarray, own: np.ndarray, found: dict | None) -> Iterator[pd.DataFrame]:
        """One row per reading that is to come out; without features it is late."""
        each = np.repeat(np.arange(len(ts)), own)
        for a in range(0, len(each), OUT_ROWS):
            at = each[a:a + OUT_ROWS]
            out = {"machine_id": np.full(len(at), machine, np.int32), "timestamp_ms": ts[at], "late": found is None}
            for i in range(len(self.sensors)):
                for name, kind in ((f"mean{i}", np.float64), (f"nmean{i}", np.int64), (f"max{i}", np.float64), (f"nmax{i}", np.int64)):
                    out[name] = np.zeros(len(at), kind) if found is None else found[name[:-len(str(i))]][i][at]
            yield pd.DataFrame(out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        machine, block = int(key[0]), int(key[1])
        watermark = timerValues.getCurrentWatermarkInMs()
        new = None
        for pdf in rows:
            late = pdf["timestamp_ms"].to_numpy(np.int64) < watermark
            if late.any():
                tardy = pdf[late & pdf["own"].to_numpy(bool)]
                yield from self.rows(machine, tardy["timestamp_ms"].to_numpy(np.int64), np.ones(len(tardy), np.int64), None)
                pdf = pdf[~late]
            if len(pdf):
                now = self.summary(pdf)
                new = now if new is None else Summary.merged([new, now])
        if new is None:
            return
        old = [Summary.read(*p, len(self.sensors)) for p in self.parts.get()]
        if len(old) >= MOST_PARTS:
            whole = Summary.merged(old)
            self.parts.put([whole.stored()])
            old = [whole]
        self.parts.appendValue(new.stored())
        self.handle.registerTimer((block + 1) * self.block_ms)
        if not new.own.any():
            return
        every = Summary.merged([*old, new])
        count = framed(every.ts, every.count, self.mean_ms, np.add)
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = framed(every.ts, every.total, self.mean_ms, np.add) / count
        found = {"mean": mean, "nmean": count, "max": framed(every.ts, every.top, self.max_ms, np.maximum),
                 "nmax": framed(every.ts, every.count, self.max_ms, np.add)}
        yield from self.rows(machine, every.ts, every.own, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.parts.clear()
        return iter(())

    def close(self) -> None:
        pass


def tagged(stream: DataFrame, sensors=SENSORS, mean_ms: int = MEAN_MS, max_ms: int = MAX_MS,
           grace_ms: int = GRACE_MS, block_ms: int | None = None) -> DataFrame:
    """One row per reading with key and time, in one keyed state operator (the
    source is read once): ``late`` ones without features, all others with the
    mean and the maximum of every sensor over ``[t - d, t]`` of the machine.
    Values are unrounded; a frame without a value of a sensor is null."""
    spark = stream.sparkSession
    ship_package(spark)
    use_rocksdb(spark)
    sensors = list(sensors)
    reach = max(mean_ms, max_ms)
    block_ms = block_ms or 2 * reach
    t = F.col("timestamp_ms")
    block = F.floor(t / F.lit(block_ms)).cast("long")
    halo = F.floor((t + F.lit(reach)) / F.lit(block_ms)).cast("long")
    pieces = (stream.where(F.col("machine_id").isNotNull() & t.isNotNull())
              .withColumn("_at", F.timestamp_millis(t)).withWatermark("_at", f"{grace_ms} milliseconds")
              .select(F.col("machine_id").cast("int").alias("machine_id"), t.cast("long").alias("timestamp_ms"), block.alias("_own"),
                      F.explode(F.sequence(block, halo)).alias("block"),
                      *[F.coalesce(F.col(s).cast("double"), F.lit(0.0)).alias(f"v{i}") for i, s in enumerate(sensors)],
                      *[F.col(s).isNotNull().alias(f"has{i}") for i, s in enumerate(sensors)])
              .withColumn("own", F.col("_own") == F.col("block")).drop("_own"))
    schema = "machine_id INT, timestamp_ms BIGINT, late BOOLEAN, " + ", ".join(
        f"mean{i} DOUBLE, nmean{i} BIGINT, max{i} DOUBLE, nmax{i} BIGINT" for i in range(len(sensors)))
    out = pieces.groupBy("machine_id", "block").transformWithStateInPandas(
        SlidingFeatures(sensors, mean_ms, max_ms, block_ms), schema, "append", "eventtime")

    def shown(value, n):
        # pandas has one form for null and NaN; the counts tell them apart
        return F.when(F.col(n) > 0, F.coalesce(F.col(value), F.lit(float("nan"))))

    return out.select("machine_id", "timestamp_ms", "late", *[c for i, s in enumerate(sensors) for c in (
        shown(f"mean{i}", f"nmean{i}").alias(feature_name("avg", s, "5min")),
        shown(f"max{i}", f"nmax{i}").alias(feature_name("max", s, "1min")))])


def sliding_features(stream: DataFrame, sensors=SENSORS, mean_ms: int = MEAN_MS, max_ms: int = MAX_MS,
                     grace_ms: int = GRACE_MS, block_ms: int | None = None) -> DataFrame:
    """ST-1 + ST-2 + ST-7: the features of the readings that are not late."""
    return tagged(stream, sensors, mean_ms, max_ms, grace_ms, block_ms).where("not late").drop("late")
