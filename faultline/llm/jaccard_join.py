"""N-gram Jaccard self-join by vertical partitioning (operator 10).

A text's set holds its distinct 5-word shingles (64-bit hashes).  Texts link
when ``100 * intersection >= 80 * union``.  Steps:

1. Texts with equal sets are one class (signature of the whole set, combined
   before the shuffle), so copies are never compared.
2. The n-gram order (hash order) is cut into fragments.  Fragments of its
   lower half count how many of a class's n-grams no other class has.  A class
   that lacks partners for over a fifth of its set can link with nothing and
   leaves (lossless).  Map tasks send one entry per n-gram and batch, so a hot
   n-gram costs one entry per batch.
3. For the others, document frequencies give the rarest-first order.  Linked
   sets share an n-gram of their prefixes under it (the first
   ``n - ceil(0.8 n) + 1``), and their sizes differ by a fifth at most.
4. Candidates come in two rounds.  First every class is paired with one leader
   of its prefix groups, a star, linear in the group size; verified links form
   components.  Then all remaining candidate pairs between different
   components follow, less those whose overlap is bounded below the threshold
   by positions and by the count in the prefix fragment.  So no link that
   matters to a component is missed, and a group of near copies is not
   expanded into all its pairs.
5. A pair's overlap is counted per fragment of the n-gram order, and the
   partial counts are summed per pair.

Defined results: empty, blank and null texts have an empty set, size 0, and
are alone.  Repeated rows get equal results.  Rows with a null doc_id link as
others do; a component of such rows alone has a null id.  Rows that repeat a
doc_id with another text are separate texts.  Other columns are ignored.  An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm import shared, text

#: Fragments of the n-gram order in which a pair's overlap is counted.
FRAGMENTS = 4
HALF = np.uint64(1 << 63)


def class_of(s: np.ndarray) -> int:
    """A signature of a sorted distinct set, never 0 unless the set is empty."""
    if not len(s):
        return 0
    total = text.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(text.mix(total[None])[0].astype(np.int64)) or 1


def concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, th, cls, n): text hash, class and set size of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("cls", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(class_of(s), len(s)) for s in text.shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x[0] for x in got], pa.int64()),
                                              pa.array([x[1] for x in got], pa.int64())], schema=schema)

    return (docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
            .mapInArrow(run, "doc_id long, th long, cls long, n long"))


def lone_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """(cls, lone): n-grams of the lower half of the order that only this class has."""
    sent = pa.schema([("dest", pa.int32()), ("key", pa.binary()), ("cls", pa.binary())])

    def packed(dest: np.ndarray, key: np.ndarray, cls: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(np.concatenate(([True], dest[1:] != dest[:-1]))) if len(dest) else np.zeros(0, int)
        ends = [*at[1:], len(dest)]
        return pa.RecordBatch.from_pydict({
            "dest": dest[at].astype(np.int32), "key": [key[i:j].tobytes() for i, j in zip(at, ends)],
            "cls": [cls[i:j].tobytes() for i, j in zip(at, ends)]}, schema=sent)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, hs, owners = set(), [], []
            for s in text.shingle_sets(batch.column(0)):
                cls = class_of(s)
                if cls and cls not in seen:
                    seen.add(cls)
                    low = s[:np.searchsorted(s, HALF)]
                    hs.append(low)
                    owners.append(np.full(len(low), cls, np.int64))
            h, owner = concat(hs, np.uint64), concat(owners, np.int64)
            order = np.argsort(h)
            h, owner = h[order], owner[order]
            if not len(h):
                continue
            at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            size = np.diff([*at, len(h)])
            h, owner = h[at], np.where(size > 1, 0, owner[at])  # 0: several classes
            dest = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(31)
            yield packed(dest, h, owner)

    def count(key, got):
        h, cls = joined(got["key"], np.uint64), joined(got["cls"], np.int64)
        order = np.argsort(h)
        h, cls = h[order], cls[order]
        at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        low, high = np.minimum.reduceat(cls, at), np.maximum.reduceat(cls, at)
        who, n = np.unique(low[(low == high) & (low != 0)], return_counts=True)
        dest = who.view(np.uint64) % np.uint64(buckets)
        order = np.argsort(dest, kind="stable")
        return pa.Table.from_batches([packed(dest[order], n[order].astype(np.int32), who[order])])

    def total(key, got):
        n, cls = joined(got["key"], np.int32), joined(got["cls"], np.int64)
        who, at = np.unique(cls, return_inverse=True)
        return pa.table({"cls": who, "lone": np.bincount(at, n, len(who)).astype(np.int64)})

    rows = docs.select("text").mapInArrow(send, "dest int, key binary, cls binary")
    rows = rows.groupBy("dest").applyInArrow(count, "dest int, key binary, cls binary")
    return rows.groupBy("dest").applyInArrow(total, "cls long, lone long")


def shingle_tables(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, n, grams): sorted shingle hashes of the classes in ``wanted`` (cls,
    rep), from a row whose doc_id is rep, which is null for classes without ids."""
    bits = shared.BitFilter(wanted.where("rep is not null"), "rep")
    nameless = not wanted.where("rep is null").isEmpty()
    schema = pa.schema([("doc_id", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(np.where(null, nameless, bits.has(ids))))
            ids, sets = batch.column(0).to_pylist(), list(text.shingle_sets(batch.column(1)))
            rows = {(i, class_of(s)): s for i, s in zip(ids, sets)}  # copies in a batch go once
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.int64()),
                 pa.array([len(s) for s in rows.values()], pa.int64()),
                 pa.array([s.tobytes() for s in rows.values()], pa.binary())], schema=schema)

    wanted = wanted.select("rep", F.col("cls").alias("wanted"))
    return (docs.mapInArrow(run, "doc_id long, cls long, n long, grams binary")
            .join(wanted, (F.col("cls") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
            .dropDuplicates(["cls"]).drop("doc_id"))


def prefixes(sets: DataFrame) -> DataFrame:
    """(cls, n, s, pre): for each class that can link, its size, how many of its
    n-grams others share, and the shared n-grams of its rarest-first prefix, in
    order.  The ``n - s`` n-grams that only it has come first and are left out."""
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("h", pa.int64())])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.repeat(n, n)),
                 pa.array(joined(batch.column(2), np.int64))], schema=schema)

    rows = sets.select("cls", "n", "grams").mapInArrow(explode, "cls long, n long, h long")
    df = rows.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    take = F.size("g") - at_least("n", 4, 5).cast("int") + 1
    return (rows.join(df, "h").groupBy("cls", "n")
            .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("g"))
            .where(take > 0)
            .select("cls", "n", F.size("g").cast("long").alias("s"),
                    F.transform(F.slice("g", F.lit(1), take), lambda x: x["h"]).alias("pre")))


def at_least(n: str, a: int, b: int):
    """ceil(n * a / b) in whole numbers."""
    return F.floor((F.col(n) * a + (b - 1)) / b)


def close_sizes(a: str, b: str):
    return (F.col(a) * 5 >= F.col(b) * 4) & (F.col(b) * 5 >= F.col(a) * 4)


def candidates(spread: DataFrame) -> DataFrame:
    """(a, b) of classes in different components that may link.

    For ``overlap >= 4/9 (na + nb)`` the smaller set (b) needs a common n-gram
    among its first ``n - ceil(8/9 n) + 1``, the larger one among its prefix.
    A pair comes from its first common n-gram only.  What follows that n-gram
    on either side, and the common n-grams of both prefixes with what follows
    the prefixes, bound the overlap from above."""
    own = spread.select("h", *[F.col(c).alias(f"{c}a") for c in ("cls", "n", "s", "r", "component", "pre")])
    other = spread.where(F.col("n") - F.col("s") + F.col("r") <= F.col("n") - at_least("n", 8, 9)) \
        .select("h", *[F.col(c).alias(f"{c}b") for c in ("cls", "n", "s", "r", "component", "pre")])
    need = 4 * (F.col("na") + F.col("nb"))
    common = F.array_intersect("prea", "preb")
    beyond = F.greatest(at_least("na", 4, 5), at_least("nb", 4, 5)) - 1
    return (own.join(other, "h")
            .where((F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("clsb") < F.col("clsa"))))
            .where(F.col("componenta") != F.col("componentb")).where(close_sizes("na", "nb"))
            .where(9 * F.least(F.col("sa") - F.col("ra"), F.col("sb") - F.col("rb")) >= need)
            .where((F.get(common, F.lit(0)) == F.col("h")) & (9 * (F.size(common) + beyond) >= need))
            .select(F.col("clsa").alias("a"), F.col("clsb").alias("b")).distinct())


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b): partial overlaps per fragment, summed per pair."""
    seg = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("fragment", pa.int32()), ("part", pa.binary())])
    cuts = np.array([(i << 64) // FRAGMENTS for i in range(1, FRAGMENTS)], np.uint64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.frombuffer(g, np.uint64) for g in batch.column(2).to_pylist()]
            parts = [p.tobytes() for s in grams for p in np.split(s, np.searchsorted(s, cuts))]
            rep = lambda c: pa.array(np.repeat(c.to_numpy(), FRAGMENTS))
            yield pa.RecordBatch.from_arrays(
                [rep(batch.column(0)), rep(batch.column(1)),
                 pa.array(np.tile(np.arange(FRAGMENTS, dtype=np.int32), batch.num_rows)),
                 pa.array(parts, pa.binary())], schema=seg)

    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("total", pa.int64()), ("overlap", pa.int64())])

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = []
            for x, y in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                if not len(x):
                    n.append(0)
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                n.append(int((y[at] == x).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64())], schema=out)

    segments = sets.select("cls", "n", "grams").mapInArrow(cut, "cls long, n long, fragment int, part binary")
    left = segments.select(F.col("cls").alias("a"), F.col("n").alias("na"), "fragment", F.col("part").alias("pa"))
    right = segments.select(F.col("cls").alias("b"), F.col("n").alias("nb"), "fragment", F.col("part").alias("pb"))
    rows = (pairs.join(left, "a").join(right, ["b", "fragment"])
            .select("a", "b", (F.col("na") + F.col("nb")).alias("total"), "pa", "pb")
            .mapInArrow(overlap, "a long, b long, total long, overlap long"))
    return (rows.groupBy("a", "b").agg(F.first("total").alias("total"), F.sum("overlap").alias("i"))
            .where("100 * i >= 80 * (total - i)").select("a", "b"))


def parted(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n, cls, root, component_id) of every row of ``docs`` (doc_id,
    text): root is a class of its component, null for empty sets."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = shared.stored(signatures(docs), "sig")
    classes = rows.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("rep"))
    lone = lone_counts(docs, 2 * shared.shuffle_partitions(spark))
    wanted = shared.stored(classes.join(lone, "cls", "left").where("5 * coalesce(lone, 0) <= n")
                           .select("cls", "rep"), "viable")
    sets = shared.stored(shingle_tables(docs, wanted), "sets")
    prefixed = shared.stored(prefixes(sets), "prefix")
    prefix = prefixed.select("cls", "n", "s", F.posexplode("pre").alias("r", "h"))

    # stars: each class with the leader that leads most of its groups; a group
    # is led by the class with the fewest n-grams of its own
    leads = prefix.groupBy("h").agg(F.min(F.struct(F.col("n") - F.col("s"), F.xxhash64("cls"), "cls", "n")).alias("l"),
                                    F.count("*").alias("k")) \
        .where("k > 1").select("h", F.col("l.cls").alias("a"), F.col("l.n").alias("na"))
    stars = (prefix.join(leads, "h").where(F.col("cls") != F.col("a")).where(close_sizes("n", "na"))
             .groupBy(F.col("cls").alias("b"), "a").agg(F.count("*").alias("k"))
             .groupBy("b").agg(F.max(F.struct("k", "a")).alias("best")).select(F.col("best.a").alias("a"), "b"))
    links = shared.stored(verify(stars, sets), "links")
    own = sets.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    parts = shared.components(links.union(own))

    # all candidates that are left between different components
    spread = prefix.join(parts.withColumnRenamed("node", "cls"), "cls")
    mixed = spread.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    spread = shared.stored(spread.join(mixed.select("h"), "h").join(prefixed.select("cls", "pre"), "cls"), "spread")
    rest = candidates(spread)
    more = shared.stored(verify(rest, sets), "links")
    merged = shared.components(
        more.join(parts.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a")
        .join(parts.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
        .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        .union(parts.select(F.col("component").alias("a"), F.col("component").alias("b"))))
    parts = (parts.join(merged.select(F.col("node").alias("component"), F.col("component").alias("root")), "component")
             .select(F.col("node").alias("cls"), "root"))

    named = classes.select("cls", "rep").join(parts, "cls", "left") \
        .select("cls", "rep", F.coalesce("root", "cls").alias("root"))
    roots = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = named.join(roots, "root").select("cls", "root", "component_id")
    return rows.join(named, "cls", "left").select("doc_id", "th", "n", "cls", "root", "component_id")


def link(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    return parted(docs).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def heads(rows: DataFrame) -> DataFrame:
    """(doc_id, th, every): the texts that stay, of ``parted`` rows; ``every``
    row of them or one.  A component keeps one text, whatever the ids of the others."""
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "cls", "th")
    one = rows.where("n > 0").groupBy("root").agg(F.min(rank).alias("r")).select("r.doc_id", "r.th", F.lit(False).alias("every"))
    return one.union(rows.where("n = 0").select("doc_id", "th", F.lit(True)).distinct())


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of linked texts one row stays, that with the
    smallest doc_id, or one without id if there is no other.  Texts that are
    linked with no other stay, also several under one doc_id; rows that repeat
    doc_id and text are copies of one another.  Rows without a word all stay."""
    shared.prepare(spark)
    keys = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_key"), F.col("doc_id").isNull().alias("_null")]
    kept = heads(shared.stored(parted(docs), "parted")).select(*keys, F.col("th").alias("_th"), "every")
    out = (shared.boxed(docs, "doc_id", "text").select("*", *keys, F.xxhash64(F.col("text").cast("string")).alias("_th"))
           .join(kept, ["_key", "_null", "_th"])
           .withColumn("_own", F.when(F.col("every"), F.monotonically_increasing_id()))
           .dropDuplicates(["_key", "_null", "_th", "_own"]))
    return shared.unboxed(out, docs.columns, "doc_id", "text")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document with its set size and component."""
    return link(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
