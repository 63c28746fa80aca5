import hashlib

from corpus import SF

from faultline.llm import fixity, shared

PAGES = "page_id long, url string, html string, id long, hash string"


def states(df):
    return sorted(((r.page_id, r.state) for r in df.collect()), key=str)


def test_locates_damage_among_odd_rows(spark):
    shared.prepare(spark)
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (1 + i % 5), 0, "") for i in range(3000)]
    rows += [(None, None, None, 0, ""), (-5, "u", "", 1, ""), (7, "http://h/7", "another body", 0, ""), (2999, None, "x", 0, ""),
             *[(10, "http://h/10", "<p>10</p>", 0, "")] * 5]
    a = spark.createDataFrame(rows, PAGES)
    assert fixity.audit(a, a).collect() == []
    other = [r for r in rows if r[0] not in (100, 2500)]
    other = [(i, u, h + "!" if i in (3, 1024, 2047) else h, x, y) for i, u, h, x, y in other]
    other.remove((10, "http://h/10", "<p>10</p>", 0, ""))
    other += [(5000, "http://h/5000", "new", 0, ""), (None, "late", "", 0, "")]
    got = fixity.audit(a, spark.createDataFrame(other, PAGES))
    assert states(got) == sorted([(3, "changed"), (1024, "changed"), (2047, "changed"), (10, "missing"), (100, "missing"),
                                  (2500, "missing"), (5000, "extra"), (-1, "extra")], key=str)
    # byte offsets: everything before it in the file of 1024 page ids
    size = lambda i: len(f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Target-URI: http://h/{i}\r\n"  # noqa: E731
                         f"Content-Type: text/html\r\nContent-Length: {len(rows[i][2])}\r\n\r\n{rows[i][2]}\r\n\r\n")
    found = {r.page_id: r for r in got.collect()}
    assert found[10].copies == 1 and found[10].replica_copies == 0  # one of six copies
    assert found[2500].start == sum(size(i) for i in range(2048, 2500)) and found[2500].bytes == size(2500)
    assert found[3].start == sum(size(i) for i in range(3)) and found[3].digest != found[3].replica_digest


def test_empty_replicas(spark):
    shared.prepare(spark)
    a = spark.createDataFrame([(1, "u", "h", 0, "")], PAGES)
    assert fixity.audit(a.limit(0), a.limit(0)).collect() == []
    assert states(fixity.audit(a, a.limit(0))) == [(1, "missing")]
    assert states(fixity.audit(a.limit(0), a)) == [(1, "extra")]


def test_descends_only_where_branches_differ(spark):
    pages = shared.table(spark, SF, "pages")
    levels = fixity.tree(fixity.records(pages), "t")
    assert levels[-1].count() <= 2
    total = sum(r.records for r in levels[0].collect())
    assert all(sum(r.records for r in level.collect()) == total == pages.count() for level in levels)


def test_locates_records_of_one_place(spark):
    shared.prepare(spark)
    bodies = [f"<p>{i}</p>" * (1 + i % 7) for i in range(50)]
    a = spark.createDataFrame([(7, "http://h/7", h, 0, "") for h in bodies], PAGES)
    hurt = [h + "!" if i in (11, 31) else h for i, h in enumerate(bodies)]
    got = fixity.audit(a, spark.createDataFrame([(7, "http://h/7", h, 0, "") for h in hurt], PAGES)).collect()
    record = lambda h: (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:7>\r\nWARC-Target-URI: http://h/7\r\n"  # noqa: E731
                        f"Content-Type: text/html\r\nContent-Length: {len(h)}\r\n\r\n{h}\r\n\r\n").encode()
    digest = lambda h: hashlib.sha256(record(h)).hexdigest()
    order = sorted((digest(h), len(record(h))) for h in bodies)
    starts = {d: sum(n for _, n in order[:k]) for k, (d, _) in enumerate(order)}
    assert sorted((r.state, r.digest, r.start, r.bytes, r.copies, r.replica_copies) for r in got) == sorted(
        ("changed", digest(bodies[i]), starts[digest(bodies[i])], len(record(bodies[i])), 1, 1) for i in (11, 31))
    assert {r.replica_digest for r in got} == {digest(bodies[i] + "!") for i in (11, 31)}


def test_odd_page_ids_and_unequal_numbers(spark):
    """Ids that share places after shifting, more lost than new records, a long text."""
    shared.prepare(spark)
    big = "x" * 3_000_000
    a = [(i, "u", h, 0, "") for i in (1 << 60, -(1 << 62), 0) for h in ("one", "two", big)]
    b = [r for r in a if not (r[0] == 0 and r[2] != "one")] + [(0, "u", "new", 0, "")]
    got = fixity.audit(spark.createDataFrame(a, PAGES), spark.createDataFrame(b, PAGES))
    assert states(got) == [(0, "changed"), (0, "missing")]
