"""Language identification by nearest centroid (operator 9).

Texts become TF-IDF vectors of hashed letter n-grams (pairs and triples of
lower-cased code points; every run of other characters is one word boundary),
square-root term frequency, unit length.  Each language is described by
several centroids, found by spherical k-means.  A text gets the language of
the centroid with the largest cosine.

Rejection is by distance, made fair to short texts: the cosine is divided by
the largest cosine that any text with as many distinct n-grams could reach
with that centroid.  A text is rejected when this relative cosine is below
half of the smallest one in the training sample of its language.

Document frequencies are counted over all training documents.  Only the
centroids are fitted on a sample, of about ``sample_per_lang`` documents a
language (a documented bound on what reaches the driver: one vector of
``DIMS`` floats per sampled document).

Defined results: a null text, an empty one or one without a letter is ``und``
with score 0 and is rejected; so is every text when there is nothing to learn
from.  Ties go to the alphabetically first language.  Repeated rows get equal
results.  A null doc_id counts as held out.  Columns named like the new ones
are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm import shared

DIMS = 4096
CHUNK_CHARS = 1 << 18
CHUNK_TEXTS = 64
NAMES = ("lang_pred", "score", "accepted")

_letter: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters, by the rule of ``str.isalpha``."""
    if not _letter:
        _letter.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letter[0]


def term_counts(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, end, counts[end - first, DIMS]) of runs of texts."""
    is_letter = letters()
    i = 0
    while i < len(texts):
        j, size, parts = i, 0, []
        while j < len(texts) and (j == i or (size < CHUNK_CHARS and j - i < CHUNK_TEXTS)):
            parts.append((" " + (texts[j] or "")).lower())
            size += len(parts[-1])
            j += 1
        raw = np.frombuffer("".join([*parts, " "]).encode("utf-32-le", "replace"), np.uint32)
        owner = np.repeat(np.arange(j - i, dtype=np.int64), [len(p) for p in parts])
        owner = np.concatenate((owner, [j - i - 1]))
        c = np.where(is_letter[raw], raw, np.uint32(0))
        keep = c != 0
        keep[1:] |= c[:-1] != 0
        keep[0] = True
        c, owner = c[keep].astype(np.uint64), owner[keep]
        a, b = c[:-1], c[1:]
        pair = ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F))
                * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(52)
        three = ((a[:-1] * np.uint64(0xA0761D6478BD642F) + b[:-1] * np.uint64(0xE7037ED1A0B428DB)
                  + b[1:] * np.uint64(0x8EBC6AF09C88C6E3)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(52)
        # a pair belongs to the text of its letter, a triple to that of its middle letter
        pair_owner = np.where(b != 0, owner[1:], owner[:-1])
        some = (a != 0) | (b != 0)
        middle = b[:-1] != 0
        at = np.concatenate(((pair_owner * DIMS + pair.astype(np.int64))[some],
                             (owner[1:-1] * DIMS + three.astype(np.int64))[middle]))
        yield i, j, np.bincount(at, minlength=(j - i) * DIMS).reshape(j - i, DIMS)
        i = j


@dataclass
class Model:
    """Languages (sorted), their centroids and rejection levels."""

    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    reach: np.ndarray
    floor: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts, dtype=np.float64) * self.idf
        return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language index (-1: no n-grams) and relative cosine of each row."""
        distinct = (counts > 0).sum(1)
        if not self.langs:
            return np.full(len(counts), -1), np.zeros(len(counts))
        cos = self.vectors(counts) @ self.centroids.T
        best = cos.argmax(1)
        rows = np.arange(len(counts))
        relative = cos[rows, best] / np.maximum(self.reach[best, np.maximum(distinct, 1) - 1], 1e-12)
        return np.where(distinct > 0, self.owner[best], -1), np.where(distinct > 0, np.clip(relative, 0, 1), 0)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of unit rows; starts from the mean and farthest rows."""
    def unit(v):
        return v / max(float(np.linalg.norm(v)), 1e-12)

    centres = [unit(x.mean(0))]
    while len(centres) < min(k, len(x)):
        centres.append(x[(x @ np.array(centres).T).max(1).argmin()])
    c = np.array(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(1)
        c = np.array([unit(x[own == i].mean(0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def held_out_column(folds: int = 5, fold: int = 0):
    """Whether crc32 of the id as text leaves ``fold``; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(True))


def fit(docs: DataFrame, k: int = 3, sample_per_lang: int = 400) -> Model:
    """Learn from ``text`` and ``lang`` of the rows of ``docs``; null langs teach nothing."""
    docs = docs.where("lang is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros(DIMS), *[np.zeros(0)] * 4)
    rate = F.lit(0.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_per_lang / n))).otherwise(rate)
    picked = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < rate * (1 << 20)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIMS, np.int64)
        for batch in batches:
            texts, lang = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            take = batch.column(2).to_pylist()
            for i, j, counts in term_counts(texts):
                df += (counts > 0).sum(0)
                own = [r for r in range(i, j) if take[r]]
                if own:
                    yield pa.RecordBatch.from_pydict({
                        "feature": [None] * len(own), "df": [None] * len(own), "lang": [lang[r] for r in own],
                        "tf": [counts[r - i].astype(np.float32).tobytes() for r in own]}, schema=schema)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"feature": some.astype(np.int32), "df": df[some],
                                          "lang": [None] * len(some), "tf": [None] * len(some)}, schema=schema)

    schema = pa.schema([("feature", pa.int32()), ("df", pa.int64()), ("lang", pa.string()), ("tf", pa.binary())])
    seen = shared.stored(docs.select("text", "lang", picked.alias("picked"))
                         .mapInArrow(gather, "feature int, df long, lang string, tf binary"), "lid")
    df = np.zeros(DIMS)
    for r in seen.where("feature is not null").groupBy("feature").agg(F.sum("df").alias("df")).collect():
        df[r["feature"]] = r["df"]
    total = sum(sizes.values())
    sample: dict[str, list[np.ndarray]] = {lang: [] for lang in sizes}
    for r in seen.where("tf is not null").sort("lang", F.md5("tf")).collect():
        sample[r["lang"]].append(np.frombuffer(r["tf"], np.float32))
    model = Model([], np.log((total + 1) / (df + 0.5)) + 1e-3, np.zeros((0, DIMS)), np.zeros(0, int),
                  np.zeros((0, DIMS)), np.zeros(0))
    parts, owner = [], []
    for lang in sorted(sizes):
        rows = [v for v in sample[lang] if v.any()]
        if rows:
            parts.append(spherical_kmeans(model.vectors(np.array(rows)), k))
            owner += [len(model.langs)] * len(parts[-1])
            model.langs.append(lang)
    if not parts:
        return Model([], model.idf, *[np.zeros(0)] * 4)
    model.centroids, model.owner = np.concatenate(parts), np.array(owner)
    model.reach = np.sqrt(np.cumsum(-np.sort(-model.centroids**2, axis=1), axis=1))
    floor = []
    for i, lang in enumerate(model.langs):
        own, relative = model.predict(np.array([v for v in sample[lang] if v.any()]))
        floor.append(0.5 * relative[own == i].min(initial=1.0))
    model.floor = np.array(floor)
    return model


def classify(docs: DataFrame, model: Model, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """``docs`` with its predicted language, score (relative cosine, 0 to 1)
    and whether the distance-based rejection accepts it."""
    pred, score, accepted = names
    passed = [c for c in docs.columns if c not in names]
    kinds = T.StructType([*[docs.schema[c] for c in passed], T.StructField(pred, T.StringType()),
                          T.StructField(score, T.DoubleType()), T.StructField(accepted, T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, keeps = [], [], []
            for _, _, counts in term_counts(batch.column("text").to_pylist()):
                own, relative = model.predict(counts)
                langs += [model.langs[x] if x >= 0 else "und" for x in own]
                scores.append(relative)
                keeps.append(np.array([x >= 0 and r >= model.floor[x] for x, r in zip(own, relative)], bool))
            n = len(langs)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in passed], pa.array(langs, pa.string()),
                 pa.array(np.concatenate(scores) if n else [], pa.float64()),
                 pa.array(np.concatenate(keeps) if n else [], pa.bool_())], names=[*passed, *names])

    return docs.select(*passed).mapInArrow(run, kinds)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the language model rejects go."""
    shared.prepare(spark)
    model = fit(docs.where(~held_out_column()))
    kept = classify(shared.boxed(docs, "doc_id", "text"), model).where("accepted")
    return shared.unboxed(kept, docs.columns, "doc_id", "text")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document with its predicted language."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out_column()))
    return (classify(docs.select("doc_id", held_out_column().alias("held_out"), "text"), model)
            .select("doc_id", "held_out", "lang_pred", "score", "accepted"))
