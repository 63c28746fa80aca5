"""Phrase collocations by best-first branch-and-bound growth (operator 11).

Phrases are runs of two or three words within a piece of a text (ASCII
lower-cased, cut at ``. , ; : ! ?`` and line ends, words at space and tab),
counted per language.  A phrase of count a >= ``LEAST`` is a candidate.  Its
score is the smallest of floor(1,000,000 a a / (l r)) over its cuts, l and r
being the counts of the parts.

Phrases grow to the right, level by level, and a level is only counted where
its bounds allow: a pair where both words are frequent, and a triple where

* its first pair can still lead to a score that is wanted: as r is a at
  least, floor(1,000,000 f(pair) / f(first word)) bounds the score of every
  triple that begins with the pair; or
* one of its pairs is itself wanted, as a triple of half its count drops it.

"Wanted" is a score of at least T, of each language.  The first T is the score
of the 2 * ``TOP``-th best pair.  When at least ``TOP`` phrases of a language
survive with a score of T or more, nothing outside the frontier can reach
the last of them, ties included, so the language is settled.  Otherwise T falls
to the score of a pair ``WIDER`` times as far down and the frontier grows, until it
holds everything.

Words and counts are exact: the keys are the words themselves.  Hashes serve
only the bitmaps of fixed size that say where to count (``shared.BitFilter``);
what they let through too much is counted exactly as well and joined away.
Counts are combined in the Python worker, in the map task and at last after
the shuffle, so a frequent phrase is one row a task.  Products are decimals of
38 digits: exact for counts below 10**16.

Defined results: a null text counts as empty, a null lang as ``und``; repeated
rows count as often as they occur; a language without candidates gives no rows, nor
does an empty table.  Ties in score go to the larger count, then to the
smaller phrase by its bytes.  A long text is processed whole.  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm import shared, text

LEAST = 10
TOP = 2000
WIDER = 8
MILLION = 1_000_000
#: Bytes of text that a worker counts at once (a longer text is one part).
PART_BYTES = 1 << 22
SPLITS = 64

SEPARATOR = np.zeros(256, bool)
SEPARATOR[list(b".,;:!?\n\x0b\x0c\r")] = True
BLANK = np.zeros(256, bool)
BLANK[list(b" \t")] = True
PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


def spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans of ``data`` as strings; they are all bytes between the gaps."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] = 1
    inside[end] -= 1
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    body = data[np.cumsum(inside[:-1]) > 0]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(body))


class Words:
    """The words of a part of the texts: codes into its own vocabulary, the
    language of each, and which ones follow their predecessor within a piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lang: np.ndarray):
        data = text.LOWER[data]
        cut = SEPARATOR[data]
        start, end = text.spans(~(cut | BLANK[data]), off)
        coded = spelled(data, start, end).dictionary_encode()
        self.vocabulary = coded.dictionary
        self.code = coded.indices.to_numpy().astype(np.int64)
        owner = np.searchsorted(off, start, side="right") - 1
        self.lang = lang[owner]
        cuts = np.concatenate(([0], np.cumsum(cut)))
        follows = np.zeros(len(start), bool)
        follows[1:] = (owner[1:] == owner[:-1]) & (cuts[start[1:]] == cuts[end[:-1]])
        self.follows = follows
        _, at, spell = self.vocabulary.buffers()
        at = np.frombuffer(at, np.int64, len(self.vocabulary) + 1)
        spell = np.frombuffer(spell, np.uint8) if spell is not None else np.zeros(0, np.uint8)
        self.hashes = text.span_hashes(spell, at[:-1], at[1:])

    def runs(self, length: int) -> np.ndarray:
        """Where a run of so many words within a piece begins."""
        n = len(self.code) - length + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for k in range(1, length):
            ok &= self.follows[k:n + k]
        return np.flatnonzero(ok)

    def keys(self, at: np.ndarray, length: int, lang_hash: np.ndarray) -> np.ndarray:
        """A hash of the language and the words of each run, for the filters."""
        h = lang_hash[self.lang[at]]
        for k in range(length):
            h = h + self.hashes[self.code[at + k]] * PLACE[k]
        return text.mix(h).view(np.int64)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, pa.Array, np.ndarray]]:
    """(words, languages, hashes of the languages) of runs of rows (lang, text)."""
    for batch in batches:
        for i, j, data, off in text.chunks(batch.column(1), PART_BYTES):
            coded = batch.column(0).slice(i, j - i).dictionary_encode()
            names = coded.dictionary
            raw = pa.array([n.as_py().encode() for n in names], pa.binary())
            at = np.concatenate(([0], np.cumsum([len(n.as_py()) for n in raw]))).astype(np.int64)
            spell = np.frombuffer(b"".join(raw.to_pylist()), np.uint8)
            yield Words(data, off, coded.indices.to_numpy()), names, text.span_hashes(spell, at[:-1], at[1:])


def counted(batches: Iterator[pa.RecordBatch], length: int, wanted) -> Iterator[pa.RecordBatch]:
    """Runs of ``length`` words, each distinct one of a part with its count and key."""
    names = ["lang", *(f"w{k + 1}" for k in range(length)), "h", "n"]
    for words, langs, lang_hash in parts(batches):
        at = words.runs(length)
        if wanted is not None and len(at):
            at = at[wanted(words, at, lang_hash)]
        if not len(at):
            continue
        # pair up codes step by step, so that no product leaves 64 bits
        code = words.lang[at].astype(np.int64)
        for k in range(length):
            if k:
                _, code = np.unique(code, return_inverse=True)
            code = code * len(words.vocabulary) + words.code[at + k]
        _, first, n = np.unique(code, return_index=True, return_counts=True)
        first = at[first]
        for a in range(0, len(first), 1 << 16):
            some = first[a:a + (1 << 16)]
            columns = [langs.take(pa.array(words.lang[some]))]
            columns += [words.vocabulary.take(pa.array(words.code[some + k])).cast(pa.string()) for k in range(length)]
            columns += [pa.array(words.keys(some, length, lang_hash)), pa.array(n[a:a + (1 << 16)].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def counts(docs: DataFrame, length: int, wanted=None) -> DataFrame:
    """(lang, w1.., h, n) of the runs of ``length`` words of all texts, of those
    that ``wanted(words, starts, language hashes)`` lets through."""
    words = [f"w{k + 1}" for k in range(length)]
    schema = "lang string, " + ", ".join(f"{w} string" for w in words) + ", h long, n long"
    return (docs.mapInArrow(lambda batches: counted(batches, length, wanted), schema)
            .groupBy("lang", *words, "h").agg(F.sum("n").alias("n")))


def score(a: str, left: str, right: str):
    """floor(1,000,000 a a / (left right)), exact."""
    return F.expr(f"(cast({MILLION} as decimal(7,0)) * (cast({a} as decimal(16,0)) * cast({a} as decimal(16,0))))"
                  f" div (cast({left} as decimal(16,0)) * cast({right} as decimal(16,0)))")


def thresholds(pairs: DataFrame, reach: int, langs: DataFrame) -> DataFrame:
    """(lang, t): the score of the ``reach``-th best pair, 0 where there are
    fewer; from the number of pairs of each score, not from their order."""
    above = Window.partitionBy("lang").orderBy(F.desc("score"))
    low = (pairs.groupBy("lang", "score").agg(F.count("*").alias("pairs"))
           .withColumn("upto", F.sum("pairs").over(above)).where(F.col("upto") >= reach)
           .groupBy("lang").agg(F.max("score").alias("t")))
    return langs.join(low, "lang", "left").select("lang", F.coalesce("t", F.lit(0)).cast("long").alias("t"))


def ranked(phrases: DataFrame, top: int) -> DataFrame:
    """Each language's first ``top`` phrases with their rank.  Those of each of
    ``SPLITS`` shares come first, so that no task sorts what all tasks have found."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    share = Window.partitionBy("lang", "share").orderBy(*order)
    first = (phrases.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SPLITS)))
             .withColumn("at", F.row_number().over(share)).where(F.col("at") <= top).drop("share", "at"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def frontier(pairs: DataFrame, docs: DataFrame, levels: DataFrame) -> DataFrame:
    """The surviving phrases of score t or more of the languages of ``levels`` (lang, t)."""
    open_pairs = pairs.join(levels, "lang").where("bound >= t")  # no score is above its bound
    some, grow, keep = (shared.BitFilter(p, "h") for p in
                        (pairs.join(levels, "lang"), open_pairs, open_pairs.where("score >= t")))

    def wanted(words: Words, at: np.ndarray, lang_hash: np.ndarray) -> np.ndarray:
        left, right = words.keys(at, 2, lang_hash), words.keys(at + 1, 2, lang_hash)
        return (grow.has(left) & some.has(right)) | (keep.has(right) & some.has(left))

    triples = counts(docs, 3, wanted).where(F.col("n") >= LEAST).drop("h")
    first = pairs.select("lang", "w1", "w2", F.col("l").alias("f1"), F.col("a").alias("f12"))
    second = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    triples = (triples.withColumnRenamed("n", "a").join(first, ["lang", "w1", "w2"]).join(second, ["lang", "w2", "w3"])
               .withColumn("s1", score("a", "f1", "f23")).withColumn("s2", score("a", "f12", "f3")))
    triples = shared.stored(triples, "triples")
    # a pair is dropped by a triple around it that has at least half its count
    around = (triples.select("lang", "w1", "w2", "a").union(triples.select("lang", F.col("w2"), F.col("w3"), "a"))
              .groupBy("lang", "w1", "w2").agg(F.max("a").alias("most")))
    kept = (open_pairs.where("score >= t").join(around, ["lang", "w1", "w2"], "left")
            .where("most is null or 100 * most < 50 * a")
            .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score"))
    grown = triples.join(levels, "lang").where("least(s1, s2) >= t").select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.expr("if(s1 <= s2, f1, f12)").alias("l"),
        F.expr("if(s1 <= s2, f23, f3)").alias("r"), F.expr("least(s1, s2)").alias("score"))
    return kept.union(grown)


def mine(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases of ``docs`` (lang, text)."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = shared.stored(counts(docs, 1), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = words.where(F.col("n") >= LEAST)
    frequent = shared.BitFilter(words, "h")
    pairs = counts(docs, 2, lambda w, at, lang_hash: frequent.has(w.keys(at, 1, lang_hash)) & frequent.has(w.keys(at + 1, 1, lang_hash)))
    left = words.select("lang", "w1", F.col("n").alias("l"))
    right = words.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r"))
    pairs = (pairs.where(F.col("n") >= LEAST).withColumnRenamed("n", "a").join(left, ["lang", "w1"]).join(right, ["lang", "w2"])
             .withColumn("score", score("a", "l", "r")).withColumn("bound", F.expr(f"cast({MILLION} as decimal(7,0)) * a div l")))
    pairs = shared.stored(pairs, "pairs")
    unsettled, settled, reach = pairs.select("lang").distinct(), [], 2 * top
    while True:
        levels = shared.stored(thresholds(pairs, reach, unsettled), "levels")
        found = shared.stored(ranked(frontier(pairs, docs.join(levels, "lang", "left_semi"), levels), top), "phrases")
        # settled: enough phrases at or above the threshold, or all of them
        full = found.where(F.col("rank") == top).select("lang").union(levels.where("t = 0").select("lang")).distinct()
        settled.append(found.join(full, "lang", "left_semi"))
        unsettled = shared.stored(levels.select("lang").join(full, "lang", "left_anti"), "unsettled")
        if unsettled.isEmpty():
            break
        reach *= WIDER
    out = settled[0]
    for more in settled[1:]:
        out = out.union(more)
    return out.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """The collocations of all documents."""
    return mine(shared.table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs)),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
f1 AS (SELECT lang, w[i] AS w1, count(*) AS f FROM starts GROUP BY ALL),
f2 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS a FROM starts WHERE i < len(w) GROUP BY ALL HAVING a >= {LEAST}),
f3 AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS a FROM starts WHERE i + 1 < len(w)
       GROUP BY ALL HAVING a >= {LEAST}),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
two AS (
  SELECT f2.lang, f2.w1, f2.w2, a, x.f AS l, y.f AS r, CAST({MILLION}::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2),
three AS (
  SELECT f3.lang, f3.w1, f3.w2, f3.w3, f3.a, p.l AS f1, p.a AS f12, q.a AS f23, q.r AS f3,
         CAST({MILLION}::HUGEINT * f3.a * f3.a // (p.l::HUGEINT * q.a) AS BIGINT) AS s1,
         CAST({MILLION}::HUGEINT * f3.a * f3.a // (p.a::HUGEINT * q.r) AS BIGINT) AS s2
  FROM f3 JOIN two p ON p.lang = f3.lang AND p.w1 = f3.w1 AND p.w2 = f3.w2
  JOIN two q ON q.lang = f3.lang AND q.w1 = f3.w2 AND q.w2 = f3.w3),
around AS (
  SELECT lang, w1, w2, max(a) AS most
  FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
kept AS (
  SELECT lang, w1 || ' ' || w2 AS phrase, a, l, r, score FROM two LEFT JOIN around USING (lang, w1, w2)
  WHERE most IS NULL OR 100 * most < 50 * a
  UNION ALL
  SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, CASE WHEN s1 <= s2 THEN f1 ELSE f12 END,
         CASE WHEN s1 <= s2 THEN f23 ELSE f3 END, least(s1, s2) FROM three),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT ranked.lang, rank, phrase, a, l, r, n.n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
