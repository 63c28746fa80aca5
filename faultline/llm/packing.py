"""Best-fit packing with exact-complement hashing (operator 6).

Documents become token pieces of at most ``LENGTH`` ids.  Only their lengths
matter to the plan, so the plan works on the histogram of lengths (at most
``LENGTH`` counts, whatever the corpus): for each length, from the longest,
the gap it leaves is looked up among single lengths, sums of pairs and sums of
triples, and combinations that fill the gap exactly are consumed as often as
the counts allow.  What remains is placed by best fit, longest first.  The
plan is tried for a few shares that the first length of a combination must
take of its gap, and the one with the fewest sequences is used.  It is a list of slots, ranges of ranks within a length; its size is bounded
by the number of lengths, not of documents.  Each piece finds its slot by its
rank among the pieces of its length; ranks are counted per hash salt, so a
length that many documents share is spread over ``SALTS`` window groups.

Defined results: a null or empty text is one piece, the end id alone.
Repeated rows are packed each.  Only documents of more than ``LENGTH`` ids are
cut; their first piece takes the remainder.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm import shared, tokens

LENGTH = 1024
END_ID = 2
SALTS = 256


@dataclass
class Slot:
    """``count`` pieces of ``length``, ``each`` per sequence, in ranks from ``rank``."""

    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


class Plan:
    """Slots for a histogram of lengths.  In an exact combination each length
    but the last takes at least ``share`` of the gap that is still open."""

    def __init__(self, counts: np.ndarray, share: float = 0.0):
        self.share = share
        self.left = counts.astype(np.int64).copy()
        self.rank = np.zeros_like(self.left)
        self.slots: list[Slot] = []
        self.sequences = 0
        self.limit = len(counts) - 1
        self.complements()
        self.best_fit()

    def take(self, length: int, each: int, bins: int, sequence: int, offset: int, count: int | None = None) -> None:
        count = each * bins if count is None else count
        self.slots.append(Slot(length, int(self.rank[length]), count, each, sequence, offset))
        self.rank[length] += count
        self.left[length] -= count

    def fill(self, lengths: list[int]) -> int:
        """Consume a combination that fills a sequence exactly, as often as it can be."""
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        bins = min(int(self.left[x]) // k for x, k in need.items())
        if bins:
            offset = 0
            for x, k in need.items():
                self.take(x, k, bins, self.sequences, offset)
                offset += k * x
            self.sequences += bins
        return bins

    def complements(self) -> None:
        for a in range(self.limit, 0, -1):
            gap = self.limit - a
            if gap == 0:
                self.fill([a])
                continue
            if self.left[a] and gap <= a:
                self.fill([a, gap])
            for b in self.available(min(gap - 1, a)):  # pairs b + c = gap, b >= c
                if not self.left[a] or b < max(0.5, self.share) * gap:
                    break
                self.fill([a, b, gap - b])
            for b in self.available(min(gap - 2, a)):  # triples b + c + d = gap, b >= c >= d
                if not self.left[a] or b < max(1 / 3, self.share) * gap:
                    break
                for c in self.available(min(gap - b - 1, b)):
                    if not (self.left[a] and self.left[b]) or c < max(0.5, self.share) * (gap - b):
                        break
                    if self.left[gap - b - c]:
                        self.fill([a, b, c, gap - b - c])

    def available(self, most: int) -> list[int]:
        """Lengths up to ``most`` that are left, from the longest."""
        return (np.flatnonzero(self.left[1:most + 1])[::-1] + 1).tolist() if most > 0 else []

    def best_fit(self) -> None:
        open_: list[list[tuple[int, int]]] = [[] for _ in range(self.limit + 1)]  # by free length: (first, sequences)
        for x in range(self.limit, 0, -1):
            free = x
            while self.left[x]:
                while free <= self.limit and not open_[free]:
                    free += 1
                if free <= self.limit:
                    first, bins = open_[free].pop()
                else:
                    free = self.limit
                    first, bins = self.sequences, -(-int(self.left[x]) // (free // x))
                    self.sequences += bins
                each = free // x
                full = min(bins, int(self.left[x]) // each)
                if full:
                    self.take(x, each, full, first, self.limit - free)
                    open_[free - each * x].append((first, full))
                first, bins = first + full, bins - full
                if bins and self.left[x]:
                    some = int(self.left[x])
                    self.take(x, some, 1, first, self.limit - free)
                    open_[free - some * x].append((first, 1))
                    first, bins = first + 1, bins - 1
                if bins:
                    open_[free].append((first, bins))

    def arrays(self) -> dict[int, np.ndarray]:
        """By length: rows of rank, each, sequence, offset, in the order of ranks."""
        by: dict[int, list] = {}
        for s in self.slots:
            by.setdefault(s.length, []).append((s.rank, s.each, s.sequence, s.offset))
        return {k: np.array(v, np.int64) for k, v in by.items()}


#: Shares that are tried.  Combinations of many short lengths fill sequences
#: exactly but use up what later gaps need, so the best share depends on the
#: histogram; at 1 only single complements are consumed before the best fit.
SHARES = (0.0, 0.6, 0.8, 0.9, 0.95, 1.0)


def best_plan(counts: np.ndarray) -> Plan:
    """The plan with the fewest sequences; the lower share on a tie."""
    return min((Plan(counts, share) for share in SHARES), key=lambda p: p.sequences)


def pieces(docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None,
           length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""
    kind = docs.schema["doc_id"].dataType
    out = f"doc_id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(vocabulary, ranks)
        last = np.array([end_id], np.uint32)
        for batch in batches:
            row, piece, start, size, crc = [], [], [], [], []
            for i, j, ids, ends in tokens.encode_column(batch.column(1), enc):
                for r in range(j - i):
                    own = np.concatenate((ids[ends[r]:ends[r + 1]], last)).astype("<u4")
                    n = len(own)
                    cuts = [0, *range(n % length or min(n, length), n, length), n]
                    for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                        row.append(i + r)
                        piece.append(p)
                        start.append(a)
                        size.append(b - a)
                        crc.append(zlib.crc32(own[a:b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)


def pack(items: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces with their sequence_id and offset; ``items`` is read several
    times, so it should be a stored table."""
    counts = np.zeros(length + 1, np.int64)
    for r in items.groupBy("length").agg(F.count("*").alias("n")).collect():
        counts[r["length"]] = r["n"]
    slots = best_plan(counts).arrays()

    salted = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    by_salt = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "salt", F.coalesce(F.sum("n").over(by_salt), F.lit(0)).alias("before"))
    in_salt = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("rank", F.row_number().over(in_salt) - 1)
              .join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")))
    kind = items.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for x in np.unique(size):
                own, s = size == x, slots[int(x)]
                at = np.searchsorted(s[:, 0], rank[own], side="right") - 1
                k = rank[own] - s[at, 0]
                sequence[own] = s[at, 2] + k // s[at, 1]
                offset[own] = s[at, 3] + k % s[at, 1] * x
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of the documents."""
    shared.prepare(spark)
    return pack(shared.stored(pieces(docs), "pieces"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed."""
    return stage(spark, shared.table(spark, sf_dir, "documents"), sf_dir)
