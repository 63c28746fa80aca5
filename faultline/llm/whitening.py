"""Embedding whitening from bit-sliced scatter sums (operator 13).

Every entry c of a vector becomes the integer x = floor(64 c) + 1,000,000.
The fit list is each distinct x vector once.  Its cross-products are exact
integers: within a block of rows every dimension is shifted by its smallest
value, the shifted values are cut into bit planes, a plane is packed over the
rows into 64-bit words, and the product sum of two dimensions is the sum of
2**(b + b') times the population count of the AND of plane b of one and plane
b' of the other.  Blocks are shifted back, added up in Spark as integers and
centred as integers, n * sum(x_i x_j) - S_i S_j, before the one conversion to
double; ``eigh`` then runs on a matrix of dims x dims, whatever the rows.

What reaches the driver is bounded by the dimension: dims * (dims + 1) / 2
product sums, the dimension sums, and 16 x 16 sums of the whitened fit list.

Defined results: a row whose vector is null, empty, or holds a null or
non-finite entry is dropped, and so is one with an entry whose x no exact
integer sum can hold (64 |c| of 2**40 or more).  Vectors of another length
than the most frequent one (of equally frequent ones the longest) are dropped
too: one covariance has one dimension.  Repeated rows give equal rows each,
and count once in the fit list.  A null vec_id stays null.  Directions in
which the fit list doesn't vary (eigenvalue zero to rounding) are no
components, so a single distinct vector, like an empty table, gives no rows.
A deviation beyond a long is null.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm import shared

SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 40)
COMPONENTS = 16
#: Rows of a block, at most; fewer for long vectors (``BLOCK_CELLS`` entries).
BLOCK_ROWS = 1 << 14
BLOCK_CELLS = 1 << 21
RESULT = ("vec_id long, component int, n long, deviation long, whitened double, "
          "explained double, identity_error double")


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` finds: n distinct vectors, integer sums of x - OFFSET,
    eigenvalues (falling), components as columns, their share of the trace."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that remain: v = floor(64 c), which is x - OFFSET."""
    double = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                            F.col("embedding").cast("array<double>").alias("c"))
    usable = F.expr(f"c is not null and size(c) > 0 and forall(c, e -> e is not null and abs({SCALE} * e) < {LARGEST}D)")
    return (double.where(usable)
            .select("vec_id", F.transform("c", lambda e: F.floor(F.lit(float(SCALE)) * e)).alias("v")))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of an Arrow list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def bit_planes(u: np.ndarray, bits: int) -> np.ndarray:
    """[dims, bits, words]: bit b of every row's entry, 64 rows a word."""
    rows, dims = u.shape
    padded = np.zeros((dims, -(-rows // 64) * 64), np.uint64)
    padded[:, :rows] = u.T
    planes = [np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1).view(np.uint64)
              for b in range(bits)]
    return np.stack(planes, axis=1)


def block_sums(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums [dims] and product sums [dims, dims] (upper triangle) of a block of rows."""
    rows, dims = v.shape
    shift = v.min(0)
    u = (v - shift).astype(np.uint64)
    bits = max(1, int(u.max()).bit_length())
    # products of at most this size, times the rows, stay within a long
    reach = max(bits, int(np.abs(shift).max()).bit_length())
    kind = np.int64 if 2 * reach + rows.bit_length() + 2 < 62 else object
    weight = np.array([1 << b for b in range(bits)], dtype=kind)
    planes = bit_planes(u, bits)
    sums = np.bitwise_count(planes).sum(-1, dtype=np.int64).astype(kind) @ weight
    cross = np.zeros((dims, dims), dtype=kind)
    for i in range(dims):
        for b in range(bits):
            both = np.bitwise_count(planes[i, b] & planes[i:]).sum(-1, dtype=np.int64)
            cross[i, i:] += (both.astype(kind) @ weight) * weight[b]
    m = shift.astype(kind)
    cross += np.outer(m, sums) + np.outer(sums, m) + rows * np.outer(m, m)
    return sums + rows * m, np.triu(cross)


def scatter(rows: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, product sums) of the vectors ``v``, exact."""
    block = max(64, min(BLOCK_ROWS, BLOCK_CELLS // dims))
    low = (1 << 32) - 1
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # row 0 holds the count, row 1 the sums, the others the product sums
        hi, lo = np.zeros((dims + 2, dims), np.int64), np.zeros((dims + 2, dims), np.int64)

        def add(v: np.ndarray) -> None:
            sums, cross = block_sums(v)
            now = np.vstack((sums, cross))
            hi[1:] += (now >> 32).astype(np.int64)
            lo[1:] += (now & low).astype(np.int64)
            hi[1:] += lo[1:] >> 32
            lo[1:] &= low
            lo[0, 0] += len(v)

        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(matrix(batch.column(0)))
                size += batch.num_rows
            while size >= block:
                v = np.concatenate(held)
                add(v[:block])
                held, size = [v[block:]], size - block
        if size:
            add(np.concatenate(held))
        i, j = np.nonzero((hi != 0) | (lo != 0))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array(hi[i, j]), pa.array(lo[i, j])], schema=schema)

    total = (rows.select("v").mapInArrow(run, "i int, j int, hi long, lo long").groupBy("i", "j")
             .agg(F.sum(F.col("hi").cast("decimal(20,0)")).alias("hi"), F.sum("lo").alias("lo")).collect())
    exact = [[0] * dims for _ in range(dims + 2)]
    for r in total:
        exact[r["i"]][r["j"]] = (int(r["hi"]) << 32) + r["lo"]
    return exact[0][0], exact[1], exact[2:]


def fit(distinct: DataFrame, dims: int, most: int = COMPONENTS) -> Whitening | None:
    """The whitening of a list of distinct vectors ``v``; None if it is empty."""
    n, sums, cross = scatter(distinct, dims)
    if not n:
        return None
    v = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * cross[i][j] - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = values > max(values[0], 0.0) * dims * np.finfo(float).eps
    k = min(most, int(some.sum()))
    share = values[:k] / max(np.trace(v), np.finfo(float).tiny)
    return Whitening(n, tuple(sums), values[:k].copy(), vectors[:, :k].copy(), share)


def centred(v: np.ndarray, model: Whitening) -> np.ndarray:
    """n x - S, exact."""
    n, sums = model.n, model.sums
    reach = n * int(np.abs(v).max(initial=0)) + max(abs(s) for s in sums)
    kind = np.int64 if reach < 1 << 62 else object
    return v.astype(kind) * n - np.array(sums, dtype=kind)


def projected(d: np.ndarray, model: Whitening) -> np.ndarray:
    """The whitened rows of n x - S."""
    return (d.astype(np.float64) / model.n) @ model.components / np.sqrt(model.values)


def deviations(d: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n x - S)**2 of each row, exact."""
    largest = int(np.abs(d).max(initial=0))
    if d.dtype == np.int64 and largest * largest * max(d.shape[1], 1) < 1 << 63:
        return (d * d).sum(1).tolist()
    sums = [sum(int(e) * int(e) for e in row) for row in d]
    return [s if s < 1 << 63 else None for s in sums]


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])
    i, j = np.indices((k + 1, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = projected(centred(matrix(batch.column(0)), model), model)
                total += np.vstack((w.sum(0), w.T @ w))
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                          pa.array(total.ravel())], schema=schema)

    total = np.zeros((k + 1, k))
    for r in distinct.select("v").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r["i"], r["j"]] = r["s"] / model.n
    # the rows are centred already; their mean is what rounding leaves of zero
    cov = total[1:] - np.outer(total[0], total[0])
    return float(np.abs(cov - np.eye(k)).max())


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row per remaining row of ``vectors`` (vec_id, embedding) and component."""
    spark = vectors.sparkSession
    rows = quantised(vectors)
    length = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if length is None:
        return spark.createDataFrame([], RESULT)
    dims = length["dims"]
    rows = rows.where(F.size("v") == dims)
    distinct = shared.stored(rows.select("v").distinct(), "distinct-vectors")
    model = fit(distinct, dims, most)
    if model is None or not len(model.values):
        return spark.createDataFrame([], RESULT)
    error = identity_error(distinct, model)
    k = len(model.values)
    out = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                     ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = batch.num_rows
            if not r:
                continue
            d = centred(matrix(batch.column(1)), model)
            each = pa.array(np.repeat(np.arange(r), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), r), pa.int32()),
                pa.array(np.full(r * k, model.n)), pa.array(deviations(d), pa.int64()).take(each),
                pa.array(projected(d, model).ravel()), pa.array(np.tile(model.explained, r)),
                pa.array(np.full(r * k, error))], schema=out)

    return rows.mapInArrow(run, RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    """All embeddings, whitened."""
    return whiten(shared.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
