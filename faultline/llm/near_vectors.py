"""Near duplicates among embeddings by cross-polytope hashing (operator 5).

A hash turns a vector by three rounds of random signs and fast Hadamard
transforms and takes the closest of the 2H signed axes.  ``k`` hashes make a
bucket; a vector is at home in one bucket of each table and visits the
``PROBES`` next best ones.  Two vectors meet in a table if one visits, or
lives in, the other's home.  ``k`` follows from the number of vectors, so that
buckets stay small at any size, and the number of tables from the chance to
meet at the threshold (computed for the dimension), so that a pair at the
threshold is missed with at most ``MISS`` probability.

Every pair that meets is verified by its cosine in double precision; it counts
in the first table where it meets.  A bucket of more than ``BLOCK`` rows is cut
into blocks, and each pair of blocks is a cell of its own: cells are matrix
products of bounded size, and give per vector its number of links and one edge
of a spanning forest, never a list of pairs.  Equal vectors are one class.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component link with nothing, nor do vectors of different lengths.
Repeated rows are vectors of their own.  A null vec_id takes part; a component
of such rows alone has a null id.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm import shared

THRESHOLD = 0.9
PROBES = 2
BLOCK = 2048
BUCKET_ROWS = 2048
MISS = 0.001
SEED = 7


class Hashes:
    """The tables' hash functions for vectors of one length."""

    def __init__(self, dims: int, k: int, tables: int):
        self.width, self.k, self.tables = 1 << max(1, (dims - 1).bit_length()), k, tables
        signs = np.random.default_rng([SEED, dims]).integers(0, 2, (tables, k, 3, self.width))
        self.signs = signs * 2.0 - 1

    def rotate(self, x: np.ndarray, signs: np.ndarray) -> np.ndarray:
        for flip in signs:
            x = x * flip
            step = 1
            while step < self.width:
                y = x.reshape(len(x), -1, 2, step)
                x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(len(x), -1)
                step *= 2
            x = x / math.sqrt(self.width)
        return x

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """int64[rows, tables, 1 + PROBES]: home and visited buckets."""
        x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        out = np.empty((len(x), self.tables, 1 + PROBES), np.int64)
        rows = np.arange(len(x))
        take = min(PROBES + 1, self.width)
        for t in range(self.tables):
            axis, loss = [], []
            for s in self.signs[t]:
                y = self.rotate(x, s)
                top = np.argpartition(-np.abs(y), take - 1, axis=1)[:, :take]
                size = np.abs(np.take_along_axis(y, top, 1))
                order = np.argsort(-size, axis=1, kind="stable")
                top, size = np.take_along_axis(top, order, 1), np.take_along_axis(size, order, 1)
                axis.append(2 * top + (np.take_along_axis(y, top, 1) < 0))
                loss.append(size[:, :1] - size)
            weight = [pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(self.k)]
            weight = np.array(weight, np.uint64).view(np.int64)
            home = sum(a[:, 0] * w for a, w in zip(axis, weight))
            # the next best buckets replace one axis by a lower one
            change = np.concatenate([(a[:, 1:] - a[:, :1]) * w for a, w in zip(axis, weight)], axis=1)
            cost = np.concatenate([v[:, 1:] for v in loss], axis=1)
            best = np.argsort(cost, axis=1, kind="stable")[:, :PROBES]
            out[:, t, 0] = home
            for p in range(PROBES):
                out[:, t, 1 + p] = home + change[rows, best[:, min(p, best.shape[1] - 1)]]
        return out


def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """bool[rows, tables]: whether the vectors with buckets ``a`` and ``b`` meet."""
    return (a[..., :1] == b).any(-1) | (b[..., :1] == a).any(-1)


def design(count: int, dims: int, threshold: float) -> tuple[int, int]:
    """k and the number of tables for so many vectors of this length."""
    width = 1 << max(1, (dims - 1).bit_length())
    k = max(1, math.ceil(math.log(max(count * (1 + PROBES) / BUCKET_ROWS, 1)) / math.log(2 * width)))
    rng = np.random.default_rng([SEED, dims, 1])
    x, y = rng.normal(size=(2, 2000, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    y = threshold * x + math.sqrt(1 - threshold**2) * y
    h = Hashes(dims, k, 4)
    chance = min(max(float(meet(h.buckets(x), h.buckets(y)).mean()), 1e-3), 1 - 1e-9)
    return k, max(2, math.ceil(math.log(MISS) / math.log(1 - chance)))


def unit_rows(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows of an array column are usable, and the unit vectors of those."""
    ok, rows = np.zeros(len(column), bool), []
    for r, v in enumerate(column):
        values = v.values
        if values is None or not len(values) or values.null_count:
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(x).max()
        if not np.isfinite(top) or top == 0:
            continue
        x = x / top  # keeps the norm finite and above zero
        rows.append(x / math.sqrt(float(x @ x)))
        ok[r] = True
    return ok, rows


def cell_links(x: np.ndarray, ids: np.ndarray, weight: np.ndarray, home: np.ndarray, side: np.ndarray,
               buckets: np.ndarray, table: int, bucket: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links counted here, smallest id each is linked to within the cell)."""
    left, right = (np.flatnonzero(side <= 0), np.flatnonzero(side == 1)) if (side >= 0).any() else \
        (np.arange(len(x)),) * 2
    a, b = np.nonzero(x[left] @ x[right].T >= threshold)
    a, b = left[a], right[b]
    ok = (home[a] | home[b]) & (ids[a] != ids[b])
    a, b = a[ok], b[ok]
    root = ids.copy()
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        if (low == root).all():
            break
        root = low
    if left is right or (side < 0).all():
        a, b = a[a < b], b[a < b]
    first = meet(buckets[a], buckets[b]).argmax(1) == table
    # two vectors may be in each other's home: then the home of the smaller id counts
    low, high = np.where(ids[a] < ids[b], a, b), np.where(ids[a] < ids[b], b, a)
    in_low = (buckets[high, table] == buckets[low, table, :1]).any(1)
    first &= np.where(in_low, buckets[low, table, 0], buckets[high, table, 0]) == bucket
    n = np.zeros(len(x), np.int64)
    np.add.at(n, a[first], weight[b[first]])
    np.add.at(n, b[first], weight[a[first]])
    return ids, n, root


def placed(classes: DataFrame, dims: int, k: int, tables: int) -> DataFrame:
    """One row per table and bucket that a class lives in or visits."""
    schema = pa.schema([("t", pa.int32()), ("b", pa.int64()), ("home", pa.bool_()), ("cls", pa.int64()),
                        ("m", pa.int64()), ("buckets", pa.binary()), ("vector", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(dims, k, tables)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(-1, dims)
            got = hashes.buckets(x)
            n, p = len(x), 1 + PROBES
            # short vectors may have fewer buckets than that; each counts once
            new = np.stack([(got[:, :, i:i + 1] != got[:, :, :i]).all(-1) for i in range(p)], axis=-1).reshape(-1)
            at = np.repeat(np.arange(n), tables * p)[new]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), p), n)[new]),
                 pa.array(got.reshape(-1)[new]), pa.array(np.tile(np.arange(p) == 0, n * tables)[new]),
                 batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                 pa.array([v.tobytes() for v in got], pa.binary()).take(pa.array(at)),
                 batch.column(2).take(pa.array(at))], schema=schema)

    return classes.select("cls", "m", "vector").mapInArrow(
        run, "t int, b long, home boolean, cls long, m long, buckets binary, vector binary")


def linked(classes: DataFrame, dims: int, count: int, threshold: float) -> DataFrame:
    """(cls, links, root): partial link counts and forest edges of the classes of one length."""
    k, tables = design(count, dims, threshold)
    rows = shared.stored(placed(classes, dims, k, tables), "buckets")
    sizes = rows.groupBy("t", "b").agg(F.count("*").alias("size")).where("size > 1")
    salt = F.xxhash64("cls", "t")
    cells = (rows.join(sizes, ["t", "b"])
             .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
             .withColumn("own", F.pmod(salt, F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("t", "b", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
                     .cast("int").alias("side"), "home", "cls", "m", "buckets", "vector"))
    cells = cells.repartition("t", "b", "i", "j").sortWithinPartitions("t", "b", "i", "j")
    out = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def solve(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = pa.Table.from_batches(parts)
        side, home, ids, weight = (cell[c].to_numpy() for c in ("side", "home", "cls", "m"))
        buckets = np.frombuffer(b"".join(cell["buckets"].to_pylist()), np.int64).reshape(len(ids), tables, -1)
        x = np.frombuffer(b"".join(cell["vector"].to_pylist()), np.float64).reshape(len(ids), dims)
        return cell_links(x, ids, weight, home, side, buckets, cell["t"][0].as_py(), cell["b"][0].as_py(), threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        done: list[tuple] = []

        def flush():
            ids, n, root = (np.concatenate(x) for x in zip(*done))
            done.clear()
            some = (n > 0) | (root != ids)
            return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some]), pa.array(root[some])], schema=out)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(4)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                now = tuple(key[:, a])
                if now != last and held:
                    if sum(h.num_rows for h in held) > 1:
                        done.append(solve(held))
                    held = []
                last = now
                held.append(batch.slice(a, b - a))
            if sum(len(x[0]) for x in done) > 10_000:
                yield flush()
        if sum(h.num_rows for h in held) > 1:
            done.append(solve(held))
        if done:
            yield flush()

    return cells.mapInArrow(run, "cls long, links long, root long")


def link(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    keyed = vectors.withColumn("cls", F.xxhash64("embedding"))
    classes = keyed.where("embedding is not null").groupBy("cls").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("embedding").alias("embedding"))
    schema = pa.schema([("cls", pa.int64()), ("rep", pa.int64()), ("m", pa.int64()), ("dims", pa.int32()),
                        ("vector", pa.binary())])

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, rows = unit_rows(batch.column(3))
            own = batch.filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array([len(v) for v in rows], pa.int32()),
                                              pa.array([v.tobytes() for v in rows], pa.binary())], schema=schema)

    classes = shared.stored(classes.mapInArrow(units, "cls long, rep long, m long, dims int, vector binary"), "units")
    sizes = classes.groupBy("dims").agg(F.count("*").alias("n")).collect()  # one row per vector length
    found = classes.select("cls", F.lit(0).cast("long").alias("links"), F.col("cls").alias("root"))
    for r in sorted(sizes):
        found = found.union(linked(classes.where(F.col("dims") == r["dims"]), r["dims"], r["n"], threshold))
    found = shared.stored(found, "links")
    parts = shared.components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    named = (classes.select("cls", "rep", "m").join(counts, "cls")
             .join(parts.withColumnRenamed("node", "cls"), "cls"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("cls", "component_id",
                                                  (F.col("links") + F.col("m") - 1).alias("n_links"))
    alone = F.col("n_links").isNull()
    return (keyed.select("vec_id", "cls", "embedding").join(named, "cls", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def query(spark, sf_dir: str) -> DataFrame:
    """Every vector with its links and component."""
    return link(shared.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
