"""Line deduplication by winnowing over line hashes (operator 3).

A document is its sequence of lines that hold a word; a line's hash covers its
words, so case (A-Z) and spacing don't matter.  A window is a shortest run of
lines with at least ``min_words`` words, taken forward from each line and
backward from each line.  Each window selects the position of its smallest line
hash (the last one of equals); the selected hashes are the document's
fingerprints.  Any run of ``min_words`` words that occurs twice holds a whole
window, and two occurrences that don't overlap select two positions of one
fingerprint.  So only fingerprints are shuffled, one row per document and hash
with its number of positions, and those with a single position anywhere are
done.  The others go back to their documents, whose windows around these
positions are joined: each with the earliest equal window (by doc_id, then
place), found by a partial aggregate, so a line that a third of all documents
share gives as many matches as it has windows, not all pairs.  Matches are
extended both ways over the line hashes of the two documents, but for windows
inside a run already found.  All lines of a run of ``min_words`` words or more
that occurs earlier are deleted; blank lines inside the run go with it.

Defined results: an occurrence that overlaps the earliest one in the same
document stays.  Null and empty texts have no lines and stay as they are.
Rows that repeat both doc_id and text are one document with equal results;
rows that repeat a doc_id with another text are two, ordered by a hash of the
text.  A null doc_id comes before all others.  Runs below ``min_words`` words
are never deleted.  A very long text is handled whole, as one row; one line
repeated throughout it costs time in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm import shared, text

MIN_WORDS = 50
BLANK = " \t\n\v\f\r"
KEY = ["_id", "_th"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of a document: its id and a hash of its text."""
    return docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))),
                             "_th": F.xxhash64("text")})


def line_tables(docs: DataFrame) -> DataFrame:
    """(_id, _th, lines, sizes): hashes and word counts of the non-blank lines."""
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("lines", pa.binary()), ("sizes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, sizes = [], []
            for i, j, data, off in text.chunks(batch.column(2)):
                w, start = text.word_starts(data, off)
                line = np.cumsum(data == 10)[start] if len(start) else np.zeros(0, np.int64)
                doc = np.searchsorted(off, start, side="right") - 1
                new = np.ones(len(w), bool)
                new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                ends = np.append(at[1:], len(w)) if len(at) else at
                h, n = text.run_hashes(w, at, ends), (ends - at).astype(np.int32)
                cut = np.searchsorted(doc[at], np.arange(j - i + 1))
                hashes += [h[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                sizes += [n[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hashes, pa.binary()),
                                              pa.array(sizes, pa.binary())], schema=schema)

    return (keyed(docs).select("_id", "_th", F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "_id long, _th long, lines binary, sizes binary")
            .where("length(lines) > 0").dropDuplicates(KEY))


def window_spans(sizes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the windows over lines with these word counts."""
    n = len(sizes)
    upto = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    forward = np.searchsorted(upto, upto[:-1] + min_words)
    backward = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
    i = np.arange(n)
    start = np.concatenate((i[forward <= n], backward[backward >= 0]))
    end = np.concatenate((forward[forward <= n], i[backward >= 0] + 1))
    both = np.unique(start * (n + 1) + end)
    return both // (n + 1), both % (n + 1)


def minima(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position of the smallest of the hashes ``h`` in each window, the last one of equals."""
    ends_at = np.empty(2 * len(start), np.int64)
    ends_at[::2], ends_at[1::2] = start, end
    smallest = np.minimum.reduceat(np.append(h, ~np.uint64(0)), ends_at)[::2]
    values, rank = np.unique(h, return_inverse=True)
    places = np.sort(rank * (len(h) + 1) + np.arange(len(h)))
    wanted = np.searchsorted(values, smallest) * (len(h) + 1) + end
    return places[np.searchsorted(places, wanted) - 1] % (len(h) + 1)


def fingerprints(lines: DataFrame, min_words: int) -> DataFrame:
    """(_id, _th, fingerprint, positions): the distinct minima of a document's
    windows, and how many of its positions they are selected at."""
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("fingerprint", pa.int64()),
                        ("positions", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, marks, counts = [], [], []
            for r, (h, n) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                h = np.frombuffer(h, np.uint64)
                start, end = window_spans(np.frombuffer(n, np.int32), min_words)
                if len(start):
                    own, count = np.unique(h[np.unique(minima(h, start, end))], return_counts=True)
                    marks.append(own)
                    counts.append(count)
                    rows.append(np.full(len(own), r))
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(np.concatenate(marks).view(np.int64)), pa.array(np.concatenate(counts).astype(np.int32))],
                    schema=schema)

    return lines.mapInArrow(run, "_id long, _th long, fingerprint long, positions int")


def windows(chosen: DataFrame, min_words: int) -> DataFrame:
    """(_id, _th, start, end, fingerprint, window) of the windows around the
    given fingerprints, from rows of (_id, _th, lines, sizes, marks)."""
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                        ("fingerprint", pa.int64()), ("window", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, ends, marks, hashes = [], [], [], [], []
            for r in range(batch.num_rows):
                h = np.frombuffer(batch.column(2)[r].as_py(), np.uint64)
                start, end = window_spans(np.frombuffer(batch.column(3)[r].as_py(), np.int32), min_words)
                mark = h[minima(h, start, end)]
                at = np.isin(mark, batch.column(4)[r].values.to_numpy().view(np.uint64))
                starts.append(start[at])
                ends.append(end[at])
                marks.append(mark[at])
                hashes.append(text.run_hashes(h, start[at], end[at]))
                rows.append(np.full(int(at.sum()), r))
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(np.concatenate(starts).astype(np.int32)), pa.array(np.concatenate(ends).astype(np.int32)),
                     pa.array(np.concatenate(marks).view(np.int64)), pa.array(np.concatenate(hashes).view(np.int64))],
                    schema=schema)

    return chosen.mapInArrow(run, "_id long, _th long, start int, end int, fingerprint long, window long")


def repeated_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """The windows whose fingerprint is selected at two positions or more."""
    marks = shared.stored(fingerprints(lines, min_words), "fingerprints")
    repeated = marks.groupBy("fingerprint").agg(F.sum("positions").alias("n")).where("n > 1").select("fingerprint")
    own = marks.join(repeated, "fingerprint").groupBy(*KEY).agg(F.collect_set("fingerprint").alias("marks"))
    return windows(own.join(lines, KEY).select(*KEY, "lines", "sizes", "marks"), min_words)


def extend(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, anchors: list[tuple[int, int, int]], same: bool,
           min_words: int) -> list[tuple[int, int]]:
    """Runs of ``a`` that equal a run of ``b`` around the anchors (start and end
    in a, start in b).  An anchor inside what is found already adds no line."""
    found = []
    covered = (0, 0)
    for i, end, k in sorted(anchors):
        if covered[0] <= i and end <= covered[1]:
            continue
        shift = i - k
        n = min(len(a) - i, len(b) - k)
        if same:
            n = min(n, shift)  # the earlier occurrence ends before this one begins
        differ = np.flatnonzero(a[i:i + n] != b[k:k + n])
        stop = i + (int(differ[0]) if len(differ) else n)
        back = min(i, k)
        if same:
            back = min(back, shift - (stop - i))
        differ = np.flatnonzero(a[i - back:i] != b[k - back:k]) if back > 0 else np.zeros(0, int)
        first = i - back + (int(differ[-1]) + 1 if len(differ) else 0) if back > 0 else i
        if sizes[first:stop].sum() >= min_words:
            found.append((first, stop))
            covered = (min(first, covered[0]), max(stop, covered[1])) if first <= covered[1] else (first, stop)
    return found


def repeated_runs(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _th, runs): the runs of lines to delete, as ranges of non-blank lines."""
    spans = shared.stored(repeated_windows(lines, min_words), "windows")
    first = (spans.groupBy("fingerprint", "window")
             .agg(F.min(F.struct("_id", "_th", "start", "end")).alias("f"), F.count("*").alias("n")).where("n > 1")
             .select("fingerprint", "window", F.col("f._id").alias("_id0"), F.col("f._th").alias("_th0"),
                     F.col("f.start").alias("start0"), F.col("f.end").alias("end0")))
    anchors = (spans.join(first, ["fingerprint", "window"])
               .where("_id != _id0 or _th != _th0 or start >= end0")
               .groupBy(*KEY, "_id0", "_th0").agg(F.collect_set(F.struct("start", "end", "start0")).alias("anchors")))
    source = lines.select(F.col("_id").alias("_id0"), F.col("_th").alias("_th0"), F.col("lines").alias("lines0"))
    pairs = (anchors.join(lines, KEY).join(source, ["_id0", "_th0"])
             .select("_id", "_th", "lines", "sizes", "lines0",
                     F.expr("_id = _id0 and _th = _th0").alias("same"),
                     F.transform("anchors", lambda x: x["start"]).alias("start"),
                     F.transform("anchors", lambda x: x["end"]).alias("end"),
                     F.transform("anchors", lambda x: x["start0"]).alias("start0")))
    schema = pa.schema([("_id", pa.int64()), ("_th", pa.int64()), ("first", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, th, a, n, b, same, s, e, s0 in zip(*(c.to_pylist() for c in batch.columns)):
                runs = extend(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), np.frombuffer(n, np.int32),
                              list(zip(s, e, s0)), same, min_words)
                out += [(i, th, x, y) for x, y in runs]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)],
                                                 schema=schema)

    return (pairs.mapInArrow(run, "_id long, _th long, first int, stop int")
            .groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("first", "stop"))).alias("runs"))
            .select(*KEY, F.transform("runs", lambda x: x["first"]).alias("firsts"),
                    F.transform("runs", lambda x: x["stop"]).alias("stops")))


def without(value: str, firsts: list[int], stops: list[int]) -> tuple[str, int, int]:
    """The text without the runs, the lines it had and the lines that went."""
    lines = value.split("\n")
    full = [k for k, x in enumerate(lines) if x.strip(BLANK)]
    gone = np.zeros(len(lines), bool)
    for a, b in zip(firsts, stops):
        gone[full[a]:full[b - 1] + 1] = True
    return "\n".join(x for x, y in zip(lines, gone) if not y), len(full), int(gone[full].sum())


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text``, and columns
    ``lines_removed`` and ``emptied`` (nothing of the document is left).
    Columns of these names, or beginning with an underscore key, are replaced."""
    lines = shared.stored(line_tables(docs), "lines")
    runs = repeated_runs(lines, min_words)
    passed = [c for c in docs.columns if c not in ("lines_removed", "emptied", *KEY)]
    joined = keyed(docs.select(*passed)).join(runs, KEY, "left").drop(*KEY)
    kinds = T.StructType([*[docs.schema[c] for c in passed], T.StructField("lines_removed", T.LongType()),
                          T.StructField("emptied", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            removed, emptied = np.zeros(n, np.int64), np.zeros(n, bool)
            values = batch.column("text")
            hit = np.flatnonzero(batch.column("firsts").is_valid().to_numpy(zero_copy_only=False))
            if len(hit):
                new = values.to_pylist()
                firsts, stops = (batch.column(c).take(pa.array(hit)).to_pylist() for c in ("firsts", "stops"))
                for r, a, b in zip(hit, firsts, stops):
                    new[r], had, removed[r] = without(new[r], a, b)
                    emptied[r] = removed[r] == had
                values = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[values if c == "text" else batch.column(c) for c in passed], pa.array(removed), pa.array(emptied)],
                names=[*passed, "lines_removed", "emptied"])

    return joined.mapInArrow(run, kinds)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated runs go, and documents of which nothing else is left."""
    shared.prepare(spark)
    needed = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    out = dedup(shared.boxed(docs, *needed)).where("not emptied")
    if "n_chars" in needed:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return shared.unboxed(out, docs.columns, *needed)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document without its repeated runs of lines."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("doc_id", "text", "lines_removed", "emptied")
