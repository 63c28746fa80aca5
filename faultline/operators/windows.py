"""Per-key trailing time-frame aggregates (WIN-1..12) from block aggregates.

A frame ``[t - d, t - 1]`` (or ``[t - d, t]``) per key is a range window
partitioned by the key.  That caps parallelism at the number of keys, and
Spark aggregates every sliding frame anew, so a dense key costs rows x frame.
Instead time is cut into blocks of the frame's own length ``d``.  A frame then
covers exactly two blocks: the end of the block before, from ``t - d`` on, and
the beginning of the own block.  Both are running aggregates inside one block
(forward for the own block, backward for the one before, read off at ``t - d``
by a probe row), linear in the rows, and a window partition holds one block of
one key.  The two parts are added or compared, never subtracted, so a NaN, an
infinity or a huge value affects only the frames that contain it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGGS = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum, "count": F.count}

# Default bucket = this many times the longest frame: ~12% extra rows shuffled.
DEFAULT_BUCKET_FACTOR = 8
# A bucket that short against the frame copies a row so many times at most.
MOST_COPIES = 64


@dataclass(frozen=True)
class FrameAgg:
    """One output column: ``agg(column)`` over the trailing ``length_ms``."""
    agg: str
    column: str
    length_ms: int
    alias: str


def trailing_aggregates(df: DataFrame, key: str | list[str], ts: str,
                        aggs: list[FrameAgg], include_current: bool = False,
                        bucket_ms: int | None = -1,
                        default: float | None = None,
                        per_time: bool = True,
                        earlier: DataFrame | None = None) -> DataFrame:
    """Add one column per ``FrameAgg`` to every row of ``df``.

    ``include_current=False`` gives the training frame ``[t-d, t-1]`` (no
    leakage of the current row or of rows with the same timestamp);
    ``True`` gives the serving frame ``[t-d, t]``.  ``default`` replaces
    empty frames.  All plans give the plain window's answer; they differ in
    cost only:

    * the default reduces the rows to one per ``(key, time)`` (per-column sum,
      count, max, min; combined before the shuffle), builds the frames of that
      table from blocks, and joins them back on ``(key, time)``, where AQE's
      skew join can split a hot key;
    * ``per_time=False`` runs plain range windows over ``(key, bucket)`` in one
      shuffle, with rows copied into the buckets they are visible from
      (``bucket_ms=-1``: ``DEFAULT_BUCKET_FACTOR`` x the longest frame); its
      cost grows with the rows in a frame, so it suits sparse series;
    * ``bucket_ms=None`` is the plain window per key.

    ``earlier`` (first plan only) holds the ``time_parts`` of rows that are not
    in ``df`` but in its frames.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not aggs:
        return df
    if min(a.length_ms for a in aggs) < 1:
        raise ValueError("frame lengths must be positive")
    if per_time and bucket_ms is not None:
        return _per_time(df, keys, ts, aggs, include_current, default, earlier)
    if earlier is not None:
        raise ValueError("earlier rows need the per-time plan")
    return _frames(df, keys, ts, aggs, include_current, bucket_ms, default)


_PARTS = {"avg": ("s", "n"), "sum": ("s", "n"), "count": ("n",), "max": ("x",), "min": ("m",)}
_PART_AGG = {"s": F.sum, "n": F.count, "x": F.max, "m": F.min}


def _blocks(per: DataFrame, keys: list[str], ts: str, names: dict, lengths: list[int],
            include_current: bool, used: dict) -> DataFrame:
    """Per key, time and frame length (``__i`` indexes ``lengths``): two rows,
    one with the running parts of the own block, one with those of the block
    before, from ``t - d`` on.  A length's rows have the parts that it is ``used``
    for; the others are null, which costs next to nothing in a shuffle."""
    kinds = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("probe"),
                               (F.col(ts) - d if p else F.col(ts)).alias("pos"),
                               F.floor((F.col(ts) - d if p else F.col(ts)) / F.lit(d)).cast("bigint").alias("block"))
                      for i, d in enumerate(lengths) for p in (False, True)])
    rows = per.withColumn("__x", F.explode(kinds)).select(
        *keys, F.col(ts), F.col("__x.i").alias("__i"), F.col("__x.probe").alias("__probe"),
        F.col("__x.pos").alias("__pos"), F.col("__x.block").alias("__block"),
        *[F.when(~F.col("__x.probe") & F.col("__x.i").isin(*used[n]), F.col(n)).alias(n) for n in names.values()])
    part = Window.partitionBy(*keys, "__i", "__block")
    own = part.orderBy("__pos").rangeBetween(Window.unboundedPreceding, 0 if include_current else -1)
    before = part.orderBy(F.desc("__pos")).rangeBetween(Window.unboundedPreceding, 0)
    outs = []
    for (_, p), n in names.items():
        fn = F.sum if p in "sn" else _PART_AGG[p]
        outs.append(F.when(F.col("__probe"), fn(n).over(before)).otherwise(fn(n).over(own)).alias(n))
    return rows.select(*keys, ts, "__i", *outs)


def _part_names(aggs: list[FrameAgg]) -> dict:
    parts = sorted({(a.column, p) for a in aggs for p in _PARTS[a.agg]})
    return {(c, p): f"__{p}_{i}" for i, (c, p) in enumerate(parts)}


def time_parts(df: DataFrame, key: str | list[str], ts: str, aggs: list[FrameAgg],
               earlier: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` reduced to one per ``(key, time)`` with the sums,
    counts and extremes that ``aggs`` need; ``earlier`` is such a table of
    other rows, to be merged."""
    keys = [key] if isinstance(key, str) else list(key)
    names = _part_names(aggs)
    per = (df.where(F.col(ts).isNotNull()).groupBy(*keys, F.col(ts).cast("bigint").alias(ts))
             .agg(*[_PART_AGG[p](F.col(c)).alias(n) for (c, p), n in names.items()]))
    if earlier is None:
        return per
    merge = {"s": F.sum, "n": F.sum, "x": F.max, "m": F.min}
    return (per.unionByName(earlier).groupBy(*keys, ts)
            .agg(*[merge[p](n).alias(n) for (_, p), n in names.items()]))


def _per_time(df, keys, ts, aggs, include_current, default, earlier=None):
    names = _part_names(aggs)
    per = time_parts(df, keys, ts, aggs, earlier)
    lengths = sorted({a.length_ms for a in aggs})
    used = {n: sorted({lengths.index(a.length_ms) for a in aggs if a.column == c and p in _PARTS[a.agg]})
            for (c, p), n in names.items()}
    rows = _blocks(per, keys, ts, names, lengths, include_current, used)

    def part(a, p):
        n = names[(a.column, p)]
        fn = F.sum if p in "sn" else _PART_AGG[p]
        return fn(F.when(F.col("__i") == lengths.index(a.length_ms), F.col(n)))

    outs = []
    for a in aggs:
        if a.agg in ("avg", "sum", "count"):
            n = F.coalesce(part(a, "n"), F.lit(0))
        if a.agg == "avg":
            c = F.when(n > 0, part(a, "s").cast("double") / n)
        elif a.agg == "sum":
            c = F.when(n > 0, part(a, "s"))
        elif a.agg == "count":
            c = n
        else:
            c = part(a, "x" if a.agg == "max" else "m")
        outs.append(c.alias(a.alias))
    feats = rows.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(ts).alias("__k_ts")).agg(*outs)
    # Null-safe on the keys: null-key rows get the frames of their own
    # (null) group, as in a plain window.
    cond = F.col(ts) == F.col("__k_ts")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    out = df.join(feats, cond, "left")
    if default is not None:
        out = out.fillna(default, subset=[a.alias for a in aggs])
    return out.select(*df.columns, *[a.alias for a in aggs])


def _frames(df, keys, ts, aggs, include_current, bucket_ms, default):
    upper = 0 if include_current else -1
    halo = max(a.length_ms for a in aggs)
    if bucket_ms == -1:
        bucket_ms = max(DEFAULT_BUCKET_FACTOR * halo, 1)

    elif bucket_ms is not None and bucket_ms * MOST_COPIES < halo:
        raise ValueError(f"a bucket of {bucket_ms} ms copies each row more than {MOST_COPIES} times")

    work = df
    part_cols = list(keys)
    if bucket_ms is not None:
        own = F.floor(F.col(ts) / F.lit(bucket_ms)).cast("bigint")
        # Buckets this row is visible from: its own up to the one holding ts + d.
        last = F.floor((F.col(ts) + F.lit(halo)) / F.lit(bucket_ms)).cast("bigint")
        work = (work.withColumn("__own_bucket", own)
                    .withColumn("__bucket", F.explode(F.sequence(own, last))))
        part_cols = keys + ["__bucket"]

    base_spec = Window.partitionBy(*part_cols).orderBy(F.col(ts))
    specs = {d: base_spec.rangeBetween(-d, upper) for d in {a.length_ms for a in aggs}}
    out_cols: list[Column] = []
    for a in aggs:
        c = _AGGS[a.agg](F.col(a.column)).over(specs[a.length_ms])
        if default is not None:
            c = F.coalesce(c, F.lit(default))
        out_cols.append(c.alias(a.alias))

    work = work.select("*", *out_cols)
    if bucket_ms is not None:
        work = (work.where(F.col("__bucket") == F.col("__own_bucket"))
                    .drop("__bucket", "__own_bucket"))
    return work
