"""Benchmark decontamination with SimHash windows (operator 7), built-in functions only.

Texts are lower-cased words between ASCII white space, read as sequences of
5-word shingles (an item of fewer words is one shingle).  For each item, the
windows of as many words as the item has are compared with it:

1. A similar window shares at least ``SIMILARITY`` of the item's shingles.  A
   shared shingle counts for a run of offsets: those whose window holds it and
   not yet as many equal ones as the item has.  The ends of these runs, summed
   in order, give what the window at every offset shares with the item,
   wherever its parts stand, and windows are laid at each offset that has
   enough.
2. Each window and item gets a 64-bit SimHash of its shingles, weighted by
   how often they occur.  The 64 bits are cut into ``RADIUS + 1`` blocks; two
   fingerprints within the radius agree in one block at least, so a join on
   blocks finds all of them.
   Windows overlap, so their sums of bits are differences of running sums.
3. Windows within the radius are verified by the weighted Jaccard similarity
   of their shingle counts, sum of minima over sum of maxima, at least
   ``SIMILARITY``.

Equal texts are compared once, under a hash of the text.  The items' shingles
and the matching texts' hashes are broadcast only below ``BROADCAST_ROWS``
rows, which is checked; beyond it the same joins shuffle.

Defined results: null, empty and blank texts match nothing, neither as
documents nor as items.  Repeated documents get equal results; items of equal
text are all reported.  Windows at a document's ends may be cut short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm import shared

SHINGLE = 5
SIMILARITY = 0.8
#: Radius of the fingerprints.  Similarity 0.8 means about 9.7 differing bits
#: of 64 (standard deviation 2.9).
RADIUS = 20
BROADCAST_ROWS = 2_000_000


def text_hash() -> Column:
    return F.xxhash64("text")


def with_shingles(df: DataFrame, k: int) -> DataFrame:
    """``df`` (with ``text``) and its number of words and k-word shingle hashes, in order."""
    words = F.array_remove(F.split(F.lower("text"), r"[ \t\n\x0B\f\r]+"), "")
    return (df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
            .withColumn("n", F.size("_w")).where(F.col("n") >= k)
            .withColumn("shingles", F.transform(F.sequence(F.lit(0), F.col("n") - k),
                                                lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(k)])))
            .drop("_w"))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash over ``h`` of each group; equal shingles count as often as they occur."""
    bits = [F.sum(F.shiftright("h", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]
    got = rows.groupBy(*keys).agg(F.count("*").alias("size"), *bits)
    print_ = F.lit(0).cast("long")
    for b in range(64):
        print_ = print_.bitwiseOR(F.shiftleft((2 * F.col(f"b{b}") > F.col("size")).cast("long"), b))
    return got.select(*keys, "size", print_.alias("print"))


def blocks(df: DataFrame, radius: int) -> DataFrame:
    """One row per block of the fingerprint."""
    cuts = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    parts = [F.struct(F.lit(i).alias("block"), F.shiftright("print", a).bitwiseAND(F.lit((1 << (b - a)) - 1))
                      .alias("value")) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]
    return df.select("*", F.explode(F.array(*parts)).alias("x")).select(*df.columns, "x.block", "x.value")


def laid(hits: DataFrame, k: int, similarity: float) -> DataFrame:
    """(th, item, s, a, b, size, similarity): the windows at all offsets ``s``
    that are similar, over the shingles from ``a`` to before ``b``."""
    # an occurrence counts unless the window holds the c-th one before it, too
    at = F.transform("at", lambda p, i: F.struct(p.alias("p"), F.get("at", i - F.col("c").cast("int")).alias("old")))
    first = F.greatest(F.col("x.p") - F.col("m") + k, F.col("x.old") + 1)
    steps = F.array(F.struct(first.alias("s"), F.lit(1).alias("d")), F.struct((F.col("x.p") + 1).alias("s"), F.lit(-1).alias("d")))
    rows = (hits.groupBy("th", "n", "item", "m", "c", "h").agg(F.sort_array(F.collect_list("p")).alias("at"))
            .select("th", "n", "item", "m", F.explode(at).alias("x"))
            .select("th", "n", "item", "m", F.explode(steps).alias("e"))
            .groupBy("th", "n", "item", "m", F.col("e.s").alias("s")).agg(F.sum("e.d").alias("d")))
    order = Window.partitionBy("th", "item").orderBy("s")
    item_size = F.col("m") - k + 1
    size = F.col("b") - F.col("a")
    sim = F.col("same") / (size + item_size - F.col("same"))
    return (rows.withColumn("same", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("end", F.lead("s").over(order))
            .where(F.col("end").isNotNull() & (F.col("same") > 0) & (F.col("same") + 1e-9 >= similarity * item_size))
            .select("th", "n", "item", "m", "same", F.explode(F.sequence("s", F.col("end") - 1)).alias("s"))
            .withColumn("a", F.greatest("s", F.lit(0)))
            .withColumn("b", F.least(F.col("s") + F.col("m"), F.col("n")) - k + 1).where("b > a")
            .select("th", "item", "s", "a", "b", size.alias("size"), sim.alias("similarity"))
            .where(F.col("similarity") >= similarity))


def window_prints(windows: DataFrame, grams: DataFrame) -> DataFrame:
    """``windows`` with the SimHash of their shingles in ``grams`` (th, p, h),
    from running sums read at both ends of each window."""
    ends = F.array(F.struct(F.col("a").alias("p"), F.lit(-1).alias("sign")), F.struct(F.col("b").alias("p"), F.lit(1).alias("sign")))
    keys = ["th", "item", "s", "size", "similarity"]
    ends = windows.select(*keys, F.explode(ends).alias("e")).select(*keys, "e.p", "e.sign", F.lit(0).cast("long").alias("h"))
    rows = ends.unionByName(grams.withColumn("sign", F.lit(0)), allowMissingColumns=True)
    # an end comes before the shingle at its place; a sum holds the bits j and j + 32, 32 bits apart
    order = Window.partitionBy("th").orderBy("p", F.abs("sign").desc()).rowsBetween(Window.unboundedPreceding, 0)
    two = F.lit((1 << 32) + 1)
    sums = [F.sum(F.shiftright("h", j).bitwiseAND(two)).over(order).alias(f"b{j}") for j in range(32)]
    got = (rows.select(*keys, "sign", *sums).where("sign != 0")
           .groupBy(*keys).agg(*[F.sum(F.col("sign") * F.col(f"b{j}")).alias(f"b{j}") for j in range(32)]))
    print_ = F.lit(0).cast("long")
    for b in range(64):
        n = F.shiftright(f"b{b - 32}", 32) if b >= 32 else F.col(f"b{b}").bitwiseAND(F.lit((1 << 32) - 1))
        print_ = print_.bitwiseOR(F.shiftleft((2 * n > F.col("size")).cast("long"), b))
    return got.select(*keys, print_.alias("print"))


def matches(docs: DataFrame, items: DataFrame, k: int, similarity: float, radius: int) -> DataFrame:
    """(text_hash, item, similarity): similar windows among texts and the items of shingle length ``k``."""
    # item: hash of its text, m words; c: how often it has the shingle h
    item_rows = shared.stored(items.select("item", F.col("n").alias("m"), F.explode("shingles").alias("h")), "items")
    places = item_rows.groupBy("item", "m", "h").agg(F.count("*").alias("c"))

    texts = docs.select(text_hash().alias("th"), "text").where("text is not null")
    # the outer form: for the inner one Spark would compute the array once more, to filter empty ones
    hits = (with_shingles(texts, k).select("th", "n", F.posexplode_outer("shingles").alias("p", "h"))
            .join(bounded(places), "h").select("th", "n", "item", "m", "c", "h", "p").distinct())
    hits = shared.stored(hits, "hits")
    windows = shared.stored(laid(hits, k, similarity), "windows")

    found = bounded(windows.groupBy("th").agg(F.min("a").alias("a"), F.max("b").alias("b")))
    bodies = (with_shingles(texts.join(found, "th", "left_semi"), k).select("th", "shingles").dropDuplicates(["th"])
              .join(found, "th").select("th", "a", F.slice("shingles", F.col("a") + 1, F.col("b") - F.col("a")).alias("g")))
    grams = bodies.select("th", "a", F.posexplode("g").alias("i", "h")).select("th", (F.col("a") + F.col("i")).alias("p"), "h")
    prints = shared.stored(window_prints(windows, grams), "prints")

    near = (blocks(prints, radius)
            .join(blocks(fingerprints(item_rows, ["item"]), radius)
                  .select("item", "block", "value", F.col("print").alias("item_print")), ["item", "block", "value"])
            .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius))
    return near.groupBy("th", "item").agg(F.max("similarity").alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(th, item_ids, similarity): hashes of the texts that hold a benchmark item,
    the items (sorted) and the largest similarity."""
    named = benchmark.select(F.col("item_id"), text_hash().alias("item"), "text").where("text is not null")
    items = named.select("item", "text").dropDuplicates(["item"])
    sized = with_shingles(items, 1).groupBy(F.least("n", F.lit(SHINGLE)).alias("k")).count()
    out = None
    for k in sorted(r["k"] for r in sized.collect()):  # at most SHINGLE values
        own = with_shingles(items, k)
        own = own.where(F.col("n") == k) if k < SHINGLE else own
        part = matches(docs, own, k, similarity, radius)
        out = part if out is None else out.union(part)
    if out is None:
        out = named.limit(0).select(F.col("item").alias("th"), "item", F.lit(0.0).alias("similarity"))
    return (out.join(named.select("item", "item_id"), "item").groupBy("th")
            .agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity")))


def flag(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, leaked, item_ids, similarity) of every document."""
    found = shared.stored(leaks(docs, benchmark), "leaks")
    return (docs.select("doc_id", text_hash().alias("th")).join(bounded(found), "th", "left")
            .select("doc_id", F.col("item_ids").isNotNull().alias("leaked"),
                    F.coalesce("item_ids", F.array().cast(found.schema["item_ids"].dataType)).alias("item_ids"),
                    F.coalesce("similarity", F.lit(0.0)).alias("similarity")))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go."""
    found = shared.stored(leaks(docs, shared.table(spark, sf_dir, "benchmark")).select("th"), "leaks")
    out = (shared.boxed(docs, "text").withColumn("th", text_hash()).join(bounded(found), "th", "left_anti"))
    return shared.unboxed(out, docs.columns, "text")


def query(spark, sf_dir: str) -> DataFrame:
    """Every document and the benchmark items that it holds."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    return flag(docs, shared.table(spark, sf_dir, "benchmark"))
