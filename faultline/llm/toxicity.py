"""Toxic passages by maximum-scoring segments (operator 4).

Words are runs of ASCII letters and digits and of bytes above 127, lower-cased
(A-Z and the Latin-1 letters).  A word's tokens are the word itself and its
beginnings of 3 to 7 bytes, so inflected forms that training has not seen
still count.

1. Tokens get log-odds between toxic and clean documents with an informative
   Dirichlet prior: the token's count over all documents, scaled.  A token
   counts only if so many of the texts that hold it are toxic that chance is
   ruled out among all tokens tried (texts, not occurrences: words come in
   bursts), and from log-odds ``LEAST`` on.  A word scores its best token's
   value less ``DRIFT``.
2. A linear-time scan finds all maximum-scoring segments of each text.
3. Segment scores become E-values, ``K n exp(-lambda S)``: lambda solves the
   extreme-value equation for the word scores of clean training documents, K
   matches the segments found in them.  A document's evidence is the sum over
   its passages of 1 / E; a logistic curve fitted on the training rows turns
   its logarithm into the score.

Labels are learned from a bounded sample, about ``per_class`` labelled rows of
each class less copies and near copies, so what is broadcast and collected (ids, tokens, evidence of the
sample) is bounded by the sample, whatever the corpus.  Token counts cover all
documents.

Defined results: a text without words scores like one without toxic words.
Without labels of both classes every score is 0.  Repeated rows get equal
results; a null doc_id is held out.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm import shared, text

PREFIXES = (3, 4, 5, 6, 7)
PRIOR = 500.0
#: Log-odds that a token needs, and by how much its surprise must exceed the
#: logarithm of the number of tokens.
LEAST = 1.0
SURE = 0.0
DRIFT = 0.25
MIN_DOCS = 3
SIGNIFICANT = 0.01
THRESHOLD = 0.3

_inside = np.zeros(256, bool)
_inside[48:58] = _inside[65:91] = _inside[97:123] = _inside[128:] = True
_WHOLE = np.uint64(0xA24BAED4963EE407)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """[(hash, index of its word)] of the tokens, by kind, and the offsets of each text's words."""
    data = text.LOWER[data]
    capital = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    data[1:][capital] += 0x20
    start, end = text.spans(_inside[data], off)
    which = np.arange(len(start))
    kinds = [(text.span_hashes(data, start, end) ^ _WHOLE, which)]
    for k in PREFIXES:
        long = end - start >= k
        kinds.append((text.span_hashes(data, start[long], start[long] + k), which[long]))
    return kinds, np.searchsorted(start, off)


class Lookup:
    """Index of known token hashes; a bitmap turns most others away."""

    BITS = 22

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[(self.keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``h``, index of the key) of the known ones."""
        some = np.flatnonzero(self.maybe[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, h[some]), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == h[some] if len(self.keys) else np.zeros(len(some), bool)
        return some[hit], at[hit]


def segments(at: np.ndarray, value: np.ndarray, drift: float) -> list[tuple[float, int, int]]:
    """All maximum-scoring segments, (score, first word, last word), of a
    sequence with these positive values at these words and -drift elsewhere."""
    left, right, first, last, back = [], [], [], [], []
    total, before = 0.0, -1
    for p, v in zip(at.tolist(), value.tolist()):
        total -= drift * (p - before - 1)
        l, f = total, p
        total += v
        r = total
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= l:
                j = back[j]
            if j < 0 or right[j] >= r:
                left.append(l), right.append(r), first.append(f), last.append(p), back.append(j)
                break
            l, f = left[j], first[j]
            del left[j:], right[j:], first[j:], last[j:], back[j:]
        before = p
    return [(b - a, x, y) for a, b, x, y in zip(left, right, first, last)]


@dataclass
class Model:
    """Word scores, extreme-value parameters and the logistic curve."""

    lookup: Lookup
    value: np.ndarray
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    slope: float = 0.0
    level: float = -50.0

    def passages(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, list[tuple[float, int, int]]]]:
        """(words, segments) of each text."""
        kinds, word_off = tokens(data, off)
        best = np.zeros(word_off[-1])
        for h, word in kinds:
            at, key = self.lookup.find(h)
            np.maximum.at(best, word[at], self.value[key])
        scored = np.flatnonzero(best > DRIFT)
        cut = np.searchsorted(scored, word_off)
        for r in range(len(off) - 1):
            own = scored[cut[r]:cut[r + 1]]
            yield int(word_off[r + 1] - word_off[r]), \
                segments(own - word_off[r], best[own] - DRIFT, DRIFT) if len(own) else []


def sampled_labels(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic) of about ``per_class`` documents of each class."""
    known = labels.where("toxic in (0, 1) and doc_id is not null") \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, per_class / sizes.get(1, 1))) \
        .otherwise(min(1.0, per_class / sizes.get(0, 1)))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < rate * (1 << 20))


def first_of_copies(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``sample`` without most copies and near copies: of the documents of a
    class whose smallest 5-word shingle hash is the same, one stays.  Else the
    words of one text that is copied often would look like a habit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(s[0].astype(np.int64)) if len(s) else 0 for s in text.shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.int64()), batch.column(2)],
                                             names=["doc_id", "least", "toxic"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (own.join(F.broadcast(sample), "doc_id").mapInArrow(run, "doc_id long, least long, toxic int")
            .groupBy("least", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic"))


def count_tokens(batches: Iterator[pa.RecordBatch], lookup: Lookup) -> Iterator[pa.RecordBatch]:
    """A task's counts of the known tokens, by label: occurrences and texts.
    Token -1 stands for all words, and -2 for all texts."""
    n = len(lookup.keys)
    counts, texts = np.zeros((3, n), np.int64), np.zeros((3, n), np.int64)
    sizes = np.zeros((3, 2), np.int64)
    for batch in batches:
        label = batch.column(1).fill_null(2).to_numpy(zero_copy_only=False)
        for i, j, data, off in text.chunks(batch.column(0)):
            kinds, word_off = tokens(data, off)
            owner = np.repeat(np.arange(j - i), np.diff(word_off))
            own = label[i:j]
            for y in range(3):
                sizes[y] += [(own[owner] == y).sum(), (own == y).sum()]
            for h, word in kinds:
                at, key = lookup.find(h)
                doc = owner[word[at]]
                pair = np.unique(doc * n + key)
                for y in range(3):
                    counts[y] += np.bincount(key[own[doc] == y], minlength=n)
                    texts[y] += np.bincount(pair[own[pair // n] == y] % n, minlength=n)
    for y in range(3):
        some = np.flatnonzero(counts[y])
        yield pa.RecordBatch.from_pydict({
            "token": np.concatenate((some, [-1, -2])), "label": np.full(len(some) + 2, y, np.int32),
            "words": np.concatenate((counts[y][some], [sizes[y][0], 0])),
            "texts": np.concatenate((texts[y][some], [0, sizes[y][1]]))})


def token_counts(rows: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences and texts of each key by label (clean, toxic, unknown), all
    words and all texts by label; ``rows`` is (text, label)."""
    lookup = Lookup(keys)
    got = (rows.mapInArrow(lambda b: count_tokens(b, lookup), "token long, label int, words long, texts long")
           .groupBy("token", "label").agg(F.sum("words").alias("words"), F.sum("texts").alias("texts")).collect())
    words, texts = np.zeros((3, len(keys))), np.zeros((3, len(keys)))
    all_words, all_texts = np.zeros(3), np.zeros(3)
    for r in got:
        if r["token"] == -1:
            all_words[r["label"]] = r["words"]
        elif r["token"] == -2:
            all_texts[r["label"]] = r["texts"]
        else:
            words[r["label"], r["token"]], texts[r["label"], r["token"]] = r["words"], r["texts"]
    return words, texts, all_words, all_texts


def toxic_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, docs): in how many of a task's texts each token is."""
    for batch in batches:
        found = []
        for _, _, data, off in text.chunks(batch.column(0)):
            kinds, word_off = tokens(data, off)
            for h, word in kinds:
                cut = np.searchsorted(word, word_off)
                found += [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:])]
        if found:
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_pydict({"token": h.view(np.int64), "docs": n})


def solve_rate(prob: np.ndarray, value: np.ndarray) -> float:
    """lambda with E[exp(lambda s)] = 1 for scores ``value`` with these
    probabilities and -DRIFT otherwise."""
    rest = 1 - prob.sum()

    def excess(x: float) -> float:
        return rest * math.exp(-DRIFT * x) + float((prob * np.exp(value * x)).sum()) - 1

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(low, 1e-3)


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and level of a logistic curve with smoothed targets."""
    pos, neg = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 0.1, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        w = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((t - p) * x).sum(), (t - p).sum()])
        hess = np.array([[(w * x * x).sum() + 1e-6, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def surprise(k: np.ndarray, n: np.ndarray, p: float) -> np.ndarray:
    """Minus the logarithm of the chance (its Chernoff bound) that ``k`` or
    more of ``n`` texts are toxic when a share ``p`` is; 0 below the mean."""
    q = np.clip(k / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    return np.where(q > p, n * (q * np.log(q / p) + (1 - q) * np.log((1 - q) / (1 - p))), 0.0)


def fit_tokens(docs: DataFrame, sample: DataFrame) -> Model:
    """Token values and lambda; ``sample`` is (doc_id, toxic), bounded."""
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "toxic")
    counted = (marked.where("toxic = 1").select("text").mapInArrow(toxic_tokens, "token long, docs long")
               .groupBy("token").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= MIN_DOCS).select("token"))
    keys = np.sort(np.array([r["token"] for r in counted.collect()], np.int64).view(np.uint64))
    words, texts, all_words, all_texts = token_counts(marked.where("toxic is not null"), keys)
    share = all_texts[1] / max(all_texts[:2].sum(), 1)
    sure = surprise(texts[1], texts[:2].sum(0), min(max(share, 1e-9), 1 - 1e-9)) > math.log(len(keys) + 1) + SURE
    keys, words = keys[sure], words[:, sure]
    total, _, total_words, _ = token_counts(marked, keys)  # over all documents
    prior = PRIOR * (total.sum(0) + 0.5) / max(total_words.sum(), 1)
    clean, toxic = words[0] + prior, words[1] + prior
    value = np.log(toxic / (all_words[1] + PRIOR)) - np.log(clean / (all_words[0] + PRIOR))
    keep = value > LEAST
    model = Model(Lookup(keys[keep]), value[keep])
    # a clean word's chance of each value: its tokens share the word, so the counts bound it from above
    prob = clean[keep] / (all_words[0] + PRIOR) / (1 + len(PREFIXES))
    model.rate = solve_rate(prob / max(1.0, 2 * prob.sum()), model.value - DRIFT)
    return model


def evidence(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, words, first, last, segment): the segments of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, found = [], []
            for _, _, data, off in text.chunks(batch.column(1)):
                for n, got in model.passages(data, off):
                    words.append(n)
                    found.append(got)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()),
                 pa.array([[s[1] for s in x] for x in found], pa.list_(pa.int32())),
                 pa.array([[s[2] for s in x] for x in found], pa.list_(pa.int32())),
                 pa.array([[s[0] for s in x] for x in found], pa.list_(pa.float64()))],
                names=["doc_id", "words", "first", "last", "segment"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, words long, first array<int>, last array<int>, segment array<double>")


def log_evidence(model: Model):
    """The logarithm of the sum of 1 / E over a row's segments; without segments that of one of score 0."""
    most = F.coalesce(F.array_max("segment"), F.lit(0.0))
    rest = F.aggregate("segment", F.lit(1e-300), lambda a, s: a + F.exp(F.lit(model.rate) * (s - most)))
    spread = F.when(F.size("segment") > 0, F.log(rest)).otherwise(0.0)
    return F.lit(model.rate) * most + spread - F.log(F.lit(model.scale) * F.greatest("words", F.lit(1)))


def score(docs: DataFrame, labels: DataFrame, per_class: int = 10_000) -> DataFrame:
    """(doc_id, score, predicted, passages) of every document; ``labels``
    (doc_id, toxic) are the rows to learn from.  A passage is (first word,
    last word, E-value)."""
    sample = shared.stored(sampled_labels(labels, per_class), "toxic-sample")
    sample = shared.stored(first_of_copies(docs, sample).dropDuplicates(["doc_id"]), "toxic-sample")
    classes = {r["toxic"] for r in sample.select("toxic").distinct().collect()}
    if classes == {0, 1}:
        model = fit_tokens(docs, sample)
    else:
        model = Model(Lookup(np.zeros(0, np.uint64)), np.zeros(0))
    found = shared.stored(evidence(docs, model), "segments")
    if classes == {0, 1}:
        own = found.join(F.broadcast(sample), "doc_id")
        clean = own.where("toxic = 0").agg(F.sum(F.size("segment")).alias("n"), F.sum("words").alias("w")).first()
        least = float((model.value - DRIFT).min()) if len(model.value) else 0.0
        model.scale = ((clean["n"] or 0) + 0.5) * math.exp(min(model.rate * least, 50)) / max(clean["w"] or 1, 1)
        rows = own.select(log_evidence(model).alias("x"), "toxic").toPandas()  # bounded by the sample
        if rows["toxic"].nunique() == 2:
            model.slope, model.level = logistic(rows["x"].to_numpy(), rows["toxic"].to_numpy())
    points = F.lit(model.slope) * log_evidence(model) + model.level
    probability = F.when(points < -700, 0.0).otherwise(1 / (1 + F.exp(-points)))
    e_value = lambda s: F.lit(model.scale) * F.col("words") * F.exp(-model.rate * s)
    passages = F.filter(F.zip_with(F.arrays_zip("first", "last"), "segment",
                                   lambda p, s: F.struct(p["first"].alias("first"), p["last"].alias("last"),
                                                         e_value(s).alias("e_value"))),
                        lambda p: p["e_value"] < SIGNIFICANT)
    return (found.select("doc_id", probability.alias("score"), passages.alias("passages"))
            .select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "passages"))


def query(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned outside the held-out fold."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    labels = shared.table(spark, sf_dir, "labels").where(~held)
    return score(docs, labels).select("doc_id", held.alias("held_out"), "score", "predicted", "passages")
