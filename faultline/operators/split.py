"""Label statistics, class weights, temporal split, undersampling
(AGG-3..5, SRT-1, SRT-2, PRJ-16, DOR-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.schemas import TEST_FRACTION


def label_stats(df: DataFrame, label: str = "faulty") -> DataFrame:
    """AGG-3 + AGG-4: rows, positives and prevalence in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.col(label).cast("bigint")).alias("n_positive"),
                  F.avg(F.col(label).cast("double")).alias("prevalence"))


def class_weights(df: DataFrame, label: str = "faulty") -> DataFrame:
    """AGG-5: balanced weight per class, ``n / (n_classes * n_c)``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy()   # over the tiny per-class table only
    return counts.select(
        F.col(label), "n_c",
        (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = "faulty", out: str = "weight") -> DataFrame:
    """Attach the balanced weight of each row's class.  The weight table has
    one row per class and is broadcast: a shuffle by the label would put all
    rows of a class into one task, and AQE keeps that join, as nearly all of its
    partitions are empty."""
    cw = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(cw), label, "left")


# Rows that share the full order key are spread over this many salts.
POSITION_SALTS = 64
HOUR_US = 3_600_000_000
# Positions of a block of identical rows are handed out in chunks of this size.
COPY_CHUNK = 100_000


def _join_null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Equi-join on ``on`` where null keys match (``<=>``)."""
    r = right.select(*[F.col(c).alias("__r_" + c) for c in on],
                     *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        e = left[c].eqNullSafe(r["__r_" + c])
        cond = e if cond is None else cond & e
    return left.join(r, cond).drop(*["__r_" + c for c in on])


def _positions(df: DataFrame, keys: list[str], ts_ms: Column, rest: list[str],
               bucket_ms: int, salts: int = POSITION_SALTS,
               total_col: str | None = None) -> DataFrame:
    """1-based position of every row in the order ``(ts_ms, *rest)`` within
    its ``keys`` group (the whole frame when ``keys`` is empty).

    No window partition holds a hot group's rows.  Counts are aggregated
    (partially, before the shuffle) per ``(keys, bucket, ms, rest, salt)``
    and offsets come from windows over count tables, one level at a time:
    buckets of a key (bounded by its time span), time values of a bucket
    (bounded by the bucket length in ms), ``(rest, salt)`` values of one
    time value (bounded by the distinct order values at one time).  Rows
    equal in every column are counted first and get consecutive positions
    from their count.  Different rows that share the whole order key are
    spread over ``salts`` hash salts, so the closing window runs per
    ``(keys, ms, rest, salt)`` group, in the order of all columns.

    ``total_col`` also adds the row count of each key group, summed over
    the per-bucket count table (no second pass over ``df``).
    """
    cols = df.columns
    # Rows equal in every column are interchangeable: one row with a count.
    base = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__m"))
              .withColumn("__ms", ts_ms)
              .withColumn("__b", F.floor(F.col("__ms") / F.lit(bucket_ms)).cast("bigint"))
              .withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]),
                                           F.lit(salts))))
    grp = [*keys, "__b", "__ms", *rest, "__salt"]
    c3 = base.groupBy(*grp).agg(F.sum("__m").alias("__n"))
    per_ms = c3.groupBy(*keys, "__b", "__ms").agg(F.sum("__n").alias("__n"))
    per_b = per_ms.groupBy(*keys, "__b").agg(F.sum("__n").alias("__n"))

    def before(part, order):
        return F.coalesce(F.sum("__n").over(
            Window.partitionBy(*part).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    extra = [F.sum("__n").over(Window.partitionBy(*keys)).alias("__total")] if total_col else []
    b_off = per_b.select(*keys, "__b", before(keys, ["__b"]).alias("__off_b"), *extra)
    ms_off = _join_null_safe(
        per_ms.select(*keys, "__b", "__ms", before([*keys, "__b"], ["__ms"]).alias("__off_ms")),
        b_off, [*keys, "__b"])
    g_off = _join_null_safe(
        c3.select(*grp, before([*keys, "__ms"], [*rest, "__salt"]).alias("__off_g")),
        ms_off, [*keys, "__b", "__ms"])
    g_off = g_off.select(*grp, (F.col("__off_b") + F.col("__off_ms") + F.col("__off_g"))
                         .alias("__off"), *([F.col("__total").alias(total_col)] if total_col else []))
    # A group's offset is the first row of its window, not a join: whole rows are
    # shuffled for the window only.
    in_group = Window.partitionBy(*grp).orderBy("__mark", *[F.col(c) for c in cols])
    marked = base.withColumn("__mark", F.lit(1)).unionByName(g_off.withColumn("__mark", F.lit(0)), allowMissingColumns=True)
    offsets = ["__off", *([total_col] if total_col else [])]
    earlier = F.coalesce(F.sum("__m").over(in_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = (marked.select(*cols, "__m", "__ms", "__b", "__salt", "__mark", earlier.alias("__earlier"),
                         *[F.first(c).over(in_group.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in offsets])
           .where(F.col("__mark") == 1).withColumn("__off", F.col("__off") + F.col("__earlier")).drop("__mark", "__earlier")
           .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__m") - 1,
                                                      F.lit(COPY_CHUNK).cast("bigint"))))
           .withColumn("__k", F.explode(F.sequence(
               F.col("__from") + 1, F.least(F.col("__from") + COPY_CHUNK, F.col("__m"))))))
    return (out.withColumn("position", F.col("__off") + F.col("__k"))
            .drop("__ms", "__b", "__salt", "__off", "__m", "__from", "__k"))


def global_position(df: DataFrame, order: list[str], ts_ms: Column,
                    bucket_ms: int = 3_600_000, total_col: str | None = None) -> DataFrame:
    """SRT-1/2: exact 1-based position of every row in the total order
    ``order`` (whose first column is time, ``ts_ms`` its epoch ms), without a
    single-partition window over rows and without a window partition per
    time value (see ``_positions``)."""
    return _positions(df, [], ts_ms, list(order[1:]), bucket_ms, total_col=total_col)


def running_position(df: DataFrame, keys: list[str], ts: str, tie: list[str],
                     bucket_ms: int = 3_600_000) -> DataFrame:
    """ST-5 in batch form: per key, the 1-based position of each row in
    ``(ts, *tie)`` order (a running count).  A hot key is not one window
    partition: see ``_positions``."""
    return _positions(df, list(keys), F.col(ts).cast("bigint"), list(tie), bucket_ms)


def temporal_split(df: DataFrame, ts: str = "event_timestamp", tie: str = "machine_id",
                   test_fraction: float = TEST_FRACTION) -> DataFrame:
    """SRT-2: the first ``int(n * (1 - test_fraction))`` rows in time order
    are ``train``, the rest ``test`` (past vs future).  Adds ``position``
    and ``is_train``."""
    pos = global_position(df, [ts, tie], F.unix_micros(F.col(ts)), HOUR_US, total_col="__n")
    cut = F.floor(F.col("__n") * F.lit(1.0 - test_fraction))
    return pos.withColumn("is_train", F.col("position") <= cut).drop("__n")


def time_series_folds(df: DataFrame, n_splits: int = 5, ts: str = "event_timestamp",
                      tie: str = "machine_id") -> DataFrame:
    """DOR-3: expanding-window time-series folds over the total order
    ``(ts, tie)``, one row per input row (no per-fold copies).

    With ``n`` rows and ``size = n // (n_splits + 1)``, fold ``k``
    (0-based) tests the rows at 0-based positions
    ``[n - (n_splits - k) * size, n - (n_splits - k - 1) * size)`` and trains
    on every row before them.  Adds ``position`` (1-based), ``test_fold``
    (the fold testing the row, or null) and ``first_train_fold`` (the first
    fold training on it; the row trains every later fold too, null if none).
    Fold ``k``: train ``first_train_fold <= k``, test ``test_fold == k``.
    """
    pos = global_position(df, [ts, tie], F.unix_micros(F.col(ts)), HOUR_US, total_col="__n")
    n = F.col("__n")
    size = F.floor(n / F.lit(n_splits + 1))
    first_test = n - F.lit(n_splits) * size
    idx = F.col("position") - 1
    test_fold = F.when((size > 0) & (idx >= first_test),
                       F.floor((idx - first_test) / size)).cast("bigint")
    first_train = F.when(idx < first_test, F.lit(0)).when(
        test_fold < F.lit(n_splits - 1), test_fold + 1).cast("bigint")
    return pos.select("*", test_fold.alias("test_fold"), first_train.alias("first_train_fold")) \
        .drop("__n")


def fold_rows(folds: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of fold ``k`` of ``time_series_folds``."""
    return (folds.where(F.col("first_train_fold") <= F.lit(k)),
            folds.where(F.col("test_fold") == F.lit(k)))


def undersample(df: DataFrame, label: str = "faulty", target_rows: int = 10_000,
                order: Column | None = None) -> DataFrame:
    """DOR-2: stratified sample, of every class (null included) exactly the
    share ``target_rows / n`` of its rows, rounded half to even.

    The rows with the smallest ``order`` stay (a hash that is a bigint from 0
    to 2**32 - 1; by default one of all columns).  Each class is counted per
    hash bucket; only rows of the one bucket that is cut are ranked."""
    cols = df.columns
    order = F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(1 << 32)) if order is None else order
    base = df.withColumn("__o", order).withColumn("__b", F.shiftright("__o", 16))
    counts = base.groupBy(F.col(label).alias("__l"), "__b").agg(F.count(F.lit(1)).alias("__c"))
    per_class = Window.partitionBy("__l")
    total = counts.agg(F.sum("__c").alias("__n"))
    counts = (counts.crossJoin(F.broadcast(total))  # one row
              .withColumn("__class", F.sum("__c").over(per_class))
              .withColumn("__upto", F.sum("__c").over(per_class.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("__take", F.rint(F.col("__class") * F.least(F.lit(1.0), F.lit(target_rows) / F.col("__n")))
                          .cast("bigint") - (F.col("__upto") - F.col("__c")))
              .where("__take > 0").select("__l", "__b", "__c", "__take"))
    kept = base.join(counts, base[label].eqNullSafe(counts["__l"]) & (base["__b"] == counts["__b"])) \
        .drop(counts["__b"])
    whole = kept.where("__take >= __c").select(*cols)
    cut = kept.where("__take < __c")
    rank = F.row_number().over(Window.partitionBy("__l", "__b").orderBy("__o", *cols))
    return whole.unionByName(cut.withColumn("__r", rank).where("__r <= __take").select(*cols))
