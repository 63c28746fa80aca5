"""Merkle fixity audit of WARC replicas (operator 8).

Pages become WARC records.  A record's place is its page id and 12 bits of its
URL's MD5, so a damaged body doesn't move it.  Below a place, 16 bits of the
record's digest choose its leaf, so a page that a third of all rows share is
spread over 65,536 leaves.  Equal records are one row with a number of copies,
from partial aggregates.  Records are ordered by place and digest; ``1024`` page
ids make a file, and each node covers a byte range of it.  A node hashes the
ids and hashes of its up to 256 children; a leaf's hash doesn't depend on the
order of its records and needs no gathering.

An audit compares two replicas' trees from the root and reads, level by level,
only the children of nodes that differ, down to the leaves, and then only the
records of those.  A record whose number of copies differs is damage.  Of one page id
and URL, lost and new records are paired in the order of their digests:
``changed``; a lost one that stays alone is ``missing``, a new one ``extra``.
Every level of a tree is a table in the shared folder.

Defined results: null fields count as empty, a null page_id as -1.  Repeated
rows are copies of one record: ``copies`` says how many are lost,
``replica_copies`` how many are new.  Several records under one page id and URL are told
apart by their digests; which of them became which isn't known, only paired
as above.  A very long text is one record, hashed whole.  Page ids from 2^35
on share places with others; their records are found all the same.  Empty
replicas have no nodes; two of them agree.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm import shared

URL_BITS = 12
NODE_BITS = 8
SLOT_BITS = 16
PLACE_LEVEL = SLOT_BITS // NODE_BITS  # the level of a tree whose nodes are places
FILE_BITS = URL_BITS + 10


def records(pages: DataFrame) -> DataFrame:
    """(id, digest, page_id, target, bytes, copies) of the pages' distinct
    WARC records; ``id`` is their leaf, ``bytes`` the length of one copy."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    key = F.coalesce(F.col("page_id").cast("long"), F.lit(-1))
    record = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), key.cast("string"),
                      F.lit(">\r\nWARC-Target-URI: "), text("url"),
                      F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                      F.octet_length(text("html")).cast("string"), F.lit("\r\n\r\n"), text("html"), F.lit("\r\n\r\n"))
    bits = lambda c, n: F.conv(F.substring(c, 1, n // 4), 16, 10).cast("long")
    place = F.shiftleft(key, URL_BITS).bitwiseOR(bits(F.md5(text("url")), URL_BITS))
    return (pages.select(key.alias("page_id"), F.xxhash64(text("url")).alias("target"), place.alias("place"), record.alias("record"))
            .select("page_id", "target", "place", F.octet_length("record").cast("long").alias("bytes"),
                    F.sha2("record", 256).alias("digest"))
            .groupBy(F.shiftleft("place", SLOT_BITS).bitwiseOR(bits(F.col("digest"), SLOT_BITS)).alias("id"), "digest")
            .agg(F.min("page_id").alias("page_id"), F.min("target").alias("target"), F.min("bytes").alias("bytes"),
                 F.count("*").alias("copies")))


def leaves(found: DataFrame) -> DataFrame:
    """Level 0: (id, hash, records, bytes) of the leaves of ``records``."""
    return (found.groupBy("id")
            .agg(F.sum("copies").alias("records"), F.sum(F.col("copies") * F.col("bytes")).alias("bytes"),
                 F.sum(F.xxhash64("digest", "copies").cast("decimal(38,0)")).alias("total"),
                 F.sum(F.xxhash64("copies", "digest", F.lit(1)).cast("decimal(38,0)")).alias("again"),
                 F.bit_xor(F.xxhash64("digest", "copies", F.lit(2))).alias("mixed"))
            .select("id", F.sha2(F.concat_ws("|", "records", "bytes", "total", "again", "mixed"), 256).alias("hash"),
                    "records", "bytes"))


def parents(nodes: DataFrame) -> DataFrame:
    """The level above: each node hashes its at most 2**NODE_BITS children in order."""
    return (nodes.groupBy(F.shiftright("id", NODE_BITS).alias("up"))
            .agg(F.sort_array(F.collect_list(F.struct("id", "hash"))).alias("c"),
                 F.sum("records").alias("records"), F.sum("bytes").alias("bytes"))
            .select(F.col("up").alias("id"),
                    F.sha2(F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["id"], x["hash"])), ","), 256)
                    .alias("hash"), "records", "bytes"))


def tree(found: DataFrame, name: str) -> list[DataFrame]:
    """The levels of the tree of a replica's ``records``, leaves first, up to a
    level of at most two nodes (one each for negative and other ids)."""
    levels = [shared.stored(leaves(found), f"{name}-0")]
    while len(levels) <= PLACE_LEVEL or levels[-1].limit(3).count() > 2:
        levels.append(shared.stored(parents(levels[-1]), f"{name}-{len(levels)}"))
    return levels


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, hash_a, hash_b) of the nodes that are not the same on both sides."""
    return (a.select("id", F.col("hash").alias("hash_a")).join(b.select("id", F.col("hash").alias("hash_b")), "id", "full")
            .where(~F.col("hash_a").eqNullSafe(F.col("hash_b"))))


def branches(a: list[DataFrame], b: list[DataFrame]) -> DataFrame:
    """(id) of the leaves that differ, from the root down."""
    found = differing(a[-1], b[-1])
    for level in range(len(a) - 2, -1, -1):
        found = shared.stored(found.select("id"), f"branches-{level + 1}").withColumnRenamed("id", "up")
        inside = [t[level].withColumn("up", F.shiftright("id", NODE_BITS)).join(found, "up", "left_semi") for t in (a, b)]
        found = differing(*inside)
    return shared.stored(found.select("id"), "branches-0")


def ranked(damage: DataFrame) -> DataFrame:
    """``damage`` with its ``rank`` among the damage of its page id, URL and
    side in digest order: inside a slot, after the counts of the slots before."""
    group = ["page_id", "target", "lost"]
    slots = damage.groupBy(*group, "id").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*group).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.select(*group, "id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*group, "id").orderBy("digest"))
    return damage.withColumn("rank", inside).join(slots, [*group, "id"]).withColumn("rank", F.col("rank") + F.col("before"))


def starts(found: DataFrame, levels: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """(id, digest, start) of all records of the ``wanted`` leaves: their byte
    offsets in their files, as offsets of the place in the file, of the leaf in
    the place and of the record in the leaf."""
    def offsets(nodes, group, order, size, name):
        before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return nodes.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long"))

    wanted = wanted.select("id").distinct()
    place = F.shiftright("id", SLOT_BITS).alias("place")
    file = F.shiftright("place", FILE_BITS).alias("file")
    places = wanted.select(place).distinct()
    files = places.select(file).distinct()
    in_file = offsets(levels[PLACE_LEVEL].withColumnRenamed("id", "place").withColumn("file", file)
                      .join(files, "file", "left_semi"), "file", "place", "bytes", "of_place")
    in_place = offsets(levels[0].withColumn("place", place).join(places, "place", "left_semi"),
                       "place", "id", "bytes", "of_leaf")
    in_leaf = offsets(found.join(wanted, "id", "left_semi"), "id", "digest", F.col("bytes") * F.col("copies"), "of_record")
    return (in_leaf.select("id", "digest", "of_record").join(in_place.select("id", "place", "of_leaf"), "id")
            .join(in_file.select("place", "of_place"), "place")
            .select("id", "digest", (F.col("of_place") + F.col("of_leaf") + F.col("of_record")).alias("start")))


def audit(pages: DataFrame, replica: DataFrame) -> DataFrame:
    """(page_id, state, file, start, bytes, digest, replica_digest, copies,
    replica_copies) of the damaged records; ``start`` is the byte offset in the
    first replica's file."""
    rows = [shared.stored(records(x), f"records-{n}") for x, n in ((pages, "a"), (replica, "b"))]
    a, b = (tree(r, f"tree-{n}") for r, n in zip(rows, "ab"))
    for t, name in ((a, "tree-a"), (b, "tree-b")):
        while len(t) < max(len(a), len(b)):
            t.append(shared.stored(parents(t[-1]), f"{name}-{len(t)}"))
    leaf = branches(a, b)

    # the records of those leaves whose copies differ
    sides = rows[0].join(leaf, "id", "left_semi").withColumn("more", F.col("copies")).unionByName(
        rows[1].join(leaf, "id", "left_semi").withColumn("more", -F.col("copies")))
    damage = (sides.groupBy("id", "digest")
              .agg(*[F.min(c).alias(c) for c in ("page_id", "target", "bytes")], F.sum("more").alias("more"))
              .where(F.col("more") != 0).withColumn("lost", F.col("more") > 0))
    damage = shared.stored(ranked(shared.stored(damage, "damage")), "damage-ranked")

    pair = ["page_id", "target", "rank"]
    lost = damage.where("lost").select(*pair, "id", "bytes", "digest", F.col("more").alias("copies"))
    lost = lost.join(starts(rows[0], a, lost), ["id", "digest"])
    new = damage.where("NOT lost").select(*pair, F.col("id").alias("other"), F.col("digest").alias("replica_digest"),
                                          (-F.col("more")).alias("replica_copies"))
    state = F.when(F.col("other").isNull(), "missing").when(F.col("id").isNull(), "extra").otherwise("changed")
    return lost.join(new, pair, "full").select(
        "page_id", state.alias("state"), F.shiftright(F.coalesce("id", "other"), SLOT_BITS + FILE_BITS).alias("file"),
        "start", "bytes", "digest", "replica_digest", F.coalesce("copies", F.lit(0)).alias("copies"),
        F.coalesce("replica_copies", F.lit(0)).alias("replica_copies"))


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica in which some records are damaged and some are lost, chosen by the MD5 of the page id."""
    mark = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 2)
    return (pages.where(mark != "01")
            .withColumn("html", F.when(mark == "00", F.concat(F.lit("\x00"), F.substring("html", 2, 1 << 30)))
                        .otherwise(F.col("html"))))


def query(spark, sf_dir: str) -> DataFrame:
    """Where a damaged copy of the pages differs from them."""
    pages = shared.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return audit(pages, damaged_copy(pages))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(page_id, -1) AS page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 2) AS mark
  FROM pages
), both_sides AS (
  SELECT page_id, url, html, 'a' AS side FROM p
  UNION ALL
  SELECT page_id, url, CASE WHEN mark = '00' THEN chr(0) || substr(html, 2) ELSE html END, 'b' FROM p WHERE mark <> '01'
), r AS (
  SELECT side, page_id, url, page_id * 4096 + CAST('0x' || substr(md5(url), 1, 3) AS BIGINT) AS place,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
         || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)
         || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM both_sides
), c AS (
  SELECT side, place, page_id, url, strlen(record) AS bytes, sha256(record) AS digest, count(*) AS copies
  FROM r GROUP BY ALL
), a AS (
  SELECT *, CAST(coalesce(sum(bytes * copies) OVER (PARTITION BY CAST(floor(place / 4194304.0) AS BIGINT)
    ORDER BY place, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM c WHERE side = 'a'
), d AS (
  SELECT coalesce(a.page_id, b.page_id) AS page_id, coalesce(a.url, b.url) AS url, coalesce(a.place, b.place) AS place,
         coalesce(a.digest, b.digest) AS digest, a.start, a.bytes, coalesce(a.copies, 0) - coalesce(b.copies, 0) AS more
  FROM a FULL JOIN (SELECT * FROM c WHERE side = 'b') b ON a.place = b.place AND a.digest = b.digest
  WHERE a.copies IS DISTINCT FROM b.copies
), k AS (SELECT *, row_number() OVER (PARTITION BY page_id, url, more > 0 ORDER BY digest) AS rank FROM d)
SELECT coalesce(l.page_id, n.page_id) AS page_id,
       CASE WHEN n.page_id IS NULL THEN 'missing' WHEN l.page_id IS NULL THEN 'extra' ELSE 'changed' END AS state,
       CAST(floor(coalesce(l.place, n.place) / 4194304.0) AS BIGINT) AS file, l.start AS start,
       CAST(l.bytes AS BIGINT) AS bytes, l.digest AS digest, n.digest AS replica_digest,
       CAST(coalesce(l.more, 0) AS BIGINT) AS copies, CAST(coalesce(-n.more, 0) AS BIGINT) AS replica_copies
FROM (SELECT * FROM k WHERE more > 0) l
FULL JOIN (SELECT * FROM k WHERE more < 0) n ON l.page_id = n.page_id AND l.url = n.url AND l.rank = n.rank
"""
