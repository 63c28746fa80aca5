"""Document fingerprints by consistent weighted sampling (operator 12).

A text's terms are its distinct five-word shingles (ASCII lower-cased words;
with fewer words the whole sequence is one), each with the number of its
occurrences as weight S.  For every term and sample, hashing gives two
Gamma(2, 1) variates r and c and a uniform b; with

    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1)

the sample is the pair (term, t) with the smallest a.  The draws depend on the
term alone, so two texts choose the same pair with a probability equal to
their generalised Jaccard similarity, sum of min weights / sum of max weights.
A fingerprint holds 16 bits of each of ``SAMPLES`` pairs in hexadecimal; the
likeness of two is the share of equal samples, with a standard error of at
most 0.5 / sqrt(SAMPLES).

``compare`` also sets each document beside an edited copy of itself, whose
last third is replaced by the beginning of the next document.  Documents are
ordered by doc_id descending (null last), of equal ids by a hash of the text;
rows equal in both are one document there, which gives one result row for each
of them, and are combined before the shuffle.  The texts are shuffled once, in
ranges of that order found from the keys alone; the first document of a range
goes to the range before as well, that of the first one to the last.  A single
document is its own next one.  No text is cut: a long one is processed whole,
its terms in tiles.

Defined results: a null text counts as empty; a text without words has the
fingerprint "" whose likeness to another "" is 1 and to anything else 0.
Equal texts have equal fingerprints.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm import shared, text

SAMPLES = 96
#: Terms evaluated at once: keeps the temporaries in the cache.
TILE = 256
CHUNK_CHARS = 1 << 18
RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
FOUND = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                   ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                   ("copies", pa.int64())])
#: Copies that one row of the intermediate result stands for, at most.
COPIES = 1000
#: Documents a task remembers to combine their copies.
SEEN = 100_000

STEPS = 1 << 16


def gamma_quantiles() -> np.ndarray:
    """Gamma(2, 1) variates at the middle of each of ``STEPS`` equal shares, by
    Newton's method on the logarithm of 1 - (1 + x) exp(-x)."""
    share = (np.arange(STEPS) + 0.5) / STEPS
    x = np.where(share < 0.5, np.sqrt(2 * share), 1 - np.log(1 - share))
    for _ in range(60):
        below = -np.expm1(np.log1p(x) - x)
        x = np.maximum(x - (np.log(below) - np.log(share)) * below / (x * np.exp(-x)), x / 4)
    return x


_rng = np.random.default_rng(1212)
FACTORS = _rng.integers(1, 2**64 - 1, SAMPLES, dtype=np.uint64) | np.uint64(1)
SPREAD = np.uint64(0xD1342543DE82EF95)
R = gamma_quantiles().astype(np.float32)
LOG_C = np.log(gamma_quantiles()).astype(np.float32)


def draws(terms: np.ndarray, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and 1 - b of each term and sample, as functions of the two alone:
    16 bits of a hash each choose r and c, 24 others are b."""
    bits = terms[:, None] * FACTORS[:samples]
    bits ^= bits >> np.uint64(32)
    bits *= SPREAD
    bits ^= bits >> np.uint64(32)
    lanes = bits.view(np.uint16).reshape(*bits.shape, 4)
    rest = (bits.view(np.uint32).reshape(*bits.shape, 2)[:, :, 1] >> np.uint32(8)).astype(np.float32)
    rest += 1
    rest *= np.float32(2.0**-24)
    return R.take(lanes[:, :, 0]), LOG_C.take(lanes[:, :, 1]), rest


def least(terms: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted terms and their weights, for every sample: the smallest ln a,
    its term (of equal values the smallest) and its pair (term, t) as one hash."""
    best = np.full(samples, np.inf, np.float32)
    term, pair = np.zeros(samples, np.uint64), np.zeros(samples, np.uint64)
    column = np.arange(samples)
    for first in range(0, len(terms), TILE):
        part, s = terms[first:first + TILE], weights[first:first + TILE]
        r, log_c, rest = draws(part, samples)
        a = log_c - r * rest  # t is 0 where the weight is 1
        more = np.flatnonzero(s != 1)
        steps = np.zeros((len(part) if len(more) else 1, samples), np.float32)
        if len(more):
            steps[more] = np.floor(np.log(s[more]).astype(np.float32)[:, None] / r[more] + (1 - rest[more]))
            a[more] = log_c[more] - r[more] * (steps[more] + rest[more])
        at = a.argmin(0)
        low = a[at, column]
        better = low < best
        t = steps[at if len(more) else 0, column]
        best = np.where(better, low, best)
        term = np.where(better, part[at], term)
        pair = np.where(better, text.mix(part[at] + t.astype(np.int64).astype(np.uint64) * SPREAD), pair)
    return best, term, pair


def signature(*groups: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of every sample's pair, from the least ones of disjoint groups of terms."""
    best, term, pair = groups[0]
    for low, other, its in groups[1:]:
        better = (low < best) | ((low == best) & (other < term))
        best, term, pair = np.where(better, low, best), np.where(better, other, term), np.where(better, its, pair)
    return (pair >> np.uint64(48)).astype(np.uint16) if np.isfinite(best).all() else np.zeros(0, np.uint16)


def signatures(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Both texts' signatures; what they share with equal weights is sampled once."""
    shared_terms, i, j = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    equal = one[1][i] == other[1][j]
    i, j = i[equal], j[equal]
    common = least(shared_terms[equal], one[1][i])
    rest = []
    for (terms, n), at in ((one, i), (other, j)):
        own = np.ones(len(terms), bool)
        own[at] = False
        rest.append(signature(common, least(terms[own], n[own])))
    return rest[0], rest[1]


def weighted_terms(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The sorted distinct shingles of each text and how often each occurs."""
    for i, j, data, off in text.chunks(pa.array(texts, pa.large_string())):
        w, word_off = text.words(data, off)
        for k in range(j - i):
            yield np.unique(text.shingles(w[word_off[k]:word_off[k + 1]]), return_counts=True)


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def alike(one: np.ndarray, other: np.ndarray) -> float:
    """The share of equal samples."""
    if len(one) != len(other):
        return 0.0
    return float((one == other).mean()) if len(one) else 1.0


def likeness(one: Column, other: Column) -> Column:
    """The likeness of two columns of fingerprints."""
    n = F.length(one) / 4
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(SAMPLES - 1)),
                            lambda k: F.substr(one, k * 4 + 1, F.lit(4)) == F.substr(other, k * 4 + 1, F.lit(4))))
    return (F.when(one == other, 1.0).when((one == "") | (other == ""), 0.0).otherwise(equal / n))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [written(signature(least(t, n))) for t, n in weighted_terms([x or "" for x in batch.column(1).to_pylist()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def edited(one: str, following: str) -> str:
    """``one`` with its last third replaced by the beginning of ``following``."""
    cut = len(one) // 3
    return one[:len(one) - cut] + following[:cut]


def compared(docs: list[list]) -> Iterator[tuple]:
    """The results of all but the last of consecutive documents (doc_id, copies, text)."""
    texts = [d[2] for d in docs]
    others = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, new = [], []
    for mine, cut in zip(weighted_terms(texts), weighted_terms(others)):
        a, b = signatures(mine, cut)
        own.append(a)
        new.append(b)
    own.append(signature(least(*next(weighted_terms(texts[-1:])))))
    for k, (doc_id, copies, _) in enumerate(docs[:-1]):
        row = (doc_id, len(texts[k]), hashlib.sha256(others[k].encode()).hexdigest(), written(own[k]), written(new[k]),
               alike(own[k], new[k]), alike(own[k], own[k + 1]))
        for first in range(0, copies, COPIES):
            yield *row, min(COPIES, copies - first)


def records(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows as batches of bounded size."""
    while some := list(islice(rows, shared.BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def combine(batches: Iterator[pa.RecordBatch], firsts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Each document (o, k, th, text) with its range; what of its copies the
    task has seen since is one row with their count and no text.  The first
    document of a range goes to the range before too, as its ``tail``."""
    schema = pa.schema([("range", pa.int32()), ("tail", pa.bool_()), ("o", pa.bool_()), ("k", pa.int64()),
                        ("th", pa.int64()), ("copies", pa.int64()), ("text", pa.string())])
    copies: dict[tuple, int] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        yield from records(((bisect_right(firsts, key) - 1, False, *key, n, None) for key, n in copies.items() if n), schema)
        copies.clear()

    for batch in batches:
        at, rows = [], []
        for n, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
            if key in copies:
                copies[key] += 1
                continue
            copies[key] = 0
            p = bisect_right(firsts, key) - 1
            at.append(n)
            rows.append((p, False, *key, 1))
            if firsts[p] == key:
                at.append(n)
                rows.append(((p - 1) % len(firsts), True, *key, 1))
        if rows:
            yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(zip(*rows), schema)),
                                              batch.column(3).take(pa.array(at))], schema=schema)
        if len(copies) > SEEN:
            yield from counted()
    yield from counted()


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Results of the documents of each range, which come in order, its tail last."""
    held: list[list] = []  # doc_id, copies, text
    last, size = None, 0
    for batch in batches:
        for where, tail, o, k, th, copies, words in zip(*(batch.column(c).to_pylist() for c in range(7))):
            key = (where, tail, o, k, th)
            if key == last:
                if not tail:
                    held[-1][1] += copies
                continue
            # a new key: the document before is complete
            if last is not None and (size > CHUNK_CHARS or where != last[0]):
                yield from compared(held)
                held = held[-1:] if where == last[0] else []
                size = sum(len(h[2]) for h in held)
            last = key
            held.append([None if o else ~k, copies, words])
            size += len(words)
    if held:
        yield from compared(held)


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text) and of its edited
    text, and their likeness to each other and to the next document's."""
    spark = docs.sparkSession
    ranges = shared.shuffle_partitions(spark)
    words = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").isNull().alias("o"), F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(0))).alias("k"),
                       F.xxhash64(words).alias("th"), words.alias("text"))
    keys = shared.stored(rows.select("o", "k", "th"), "keys")
    firsts = sorted(tuple(r["first"]) for r in
                    keys.repartitionByRange(ranges, "o", "k", "th").groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.min(F.struct("o", "k", "th")).alias("first")).collect())
    if not firsts:
        return spark.createDataFrame([], RESULT)
    placed = rows.mapInArrow(lambda batches: combine(batches, firsts),
                             "range int, tail boolean, o boolean, k long, th long, copies long, text string")
    ordered = (placed.repartitionById(len(firsts), "range")
               .sortWithinPartitions("range", "tail", "o", "k", "th", F.col("text").isNull()))
    found = ordered.mapInArrow(lambda batches: records(walk(batches), FOUND), RESULT + ", copies long")
    return found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document beside its edited text and its next document."""
    return compare(shared.table(spark, sf_dir, "documents").select("doc_id", "text"))
