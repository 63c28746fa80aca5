import hashlib
from collections import Counter

import numpy as np
from corpus import SF, empty_documents, odd_documents, prose, shingles
from pyspark.sql import functions as F

from faultline.llm import fingerprints as fp
from faultline.llm import shared


def jaccard(a, b):
    """Generalised Jaccard similarity of the weighted shingles of two texts."""
    a, b = Counter(shingles(a)), Counter(shingles(b))
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def brute(rows):
    """(doc_id, n_chars, sha256, edited text, next text) of each row."""
    order = {}
    for i, t in rows:
        order.setdefault(i, set()).add(t or "")
    ids = sorted((i for i in order if i is not None), reverse=True) + [None] * (None in order)
    assert all(len(order[i]) == 1 for i in ids), "the order of different texts under one id is that of their hashes"
    text = {i: next(iter(order[i])) for i in ids}
    after = dict(zip(ids, [*ids[1:], ids[0]]))
    out = []
    for i, t in rows:
        t, n = t or "", text[after[i]]
        e = t[:len(t) - len(t) // 3] + n[:len(t) // 3]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, n))
    return out


def check(df, rows):
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r) for r in df.collect()), key=lambda x: str(x[:3]))
    want = sorted(brute(rows), key=lambda x: str(x[:3]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    by_text = {}
    for (*_, r), (*_, t, e, n) in zip(got, want):
        assert abs(r.near_edited - jaccard(t, e)) < 0.25 and abs(r.near_next - jaccard(t, n)) < 0.25
        assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        assert by_text.setdefault(e, r.edited_fingerprint) == r.edited_fingerprint
    return got


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in shared.table(spark, SF, "documents").collect()]
    got = check(fp.query(spark, SF), rows)
    errors = [r.near_edited - jaccard(t, e) for (*_, r), (*_, t, e, _) in zip(got, sorted(brute(rows), key=lambda x: str(x[:3])))]
    assert abs(np.mean(errors)) < 0.01


def test_collision_rate_is_generalised_jaccard():
    """Weighted terms with many different weights, over several thousand samples."""
    rng = np.random.default_rng(5)
    terms = np.sort(rng.integers(1, 2**63, 300, dtype=np.uint64))
    a, b = rng.integers(0, 40, 300), rng.integers(0, 40, 300)
    a[:80] = b[:80]
    hits = []
    for k in range(40):
        fresh = np.sort(fp.text.mix(terms + np.uint64(k)))
        hits.append(fp.alike(*fp.signatures((fresh[a > 0], a[a > 0]), (fresh[b > 0], b[b > 0]))))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(np.mean(hits) - want) < 4 * (want * (1 - want) / (40 * fp.SAMPLES)) ** 0.5


def test_signature_is_the_same_beside_any_text():
    one = next(fp.weighted_terms([prose(1, 900) + " " + prose(2, 30) * 3]))
    alone = fp.signature(fp.least(*one))
    for n in range(4):
        other = next(fp.weighted_terms([prose(1, 300 * n) + " " + prose(3, 50)]))
        assert (fp.signatures(one, other)[0] == alone).all() and (fp.signatures(other, one)[1] == alone).all()


def test_draws_follow_their_distributions():
    r, log_c, rest = fp.draws(fp.text.mix(np.arange(1, 5000, dtype=np.uint64)))
    assert abs(r.mean() - 2) < 0.02 and abs(r.var() - 2) < 0.05 and abs(np.exp(log_c).mean() - 2) < 0.02
    assert abs(rest.mean() - 0.5) < 0.005 and rest.min() > 0 and rest.max() <= 1
    # ln a is that of an exponential variate with rate S, which makes the collision rate the similarity
    a = np.exp(log_c - r * rest)
    assert abs(a.mean() - 1) < 0.01 and abs(a.var() - 1) < 0.04
    assert abs((a < 0.001).mean() / 0.001 - 1) < 0.15


def test_odd_rows(spark):
    """Nulls, empty texts, repeated rows and clashing names; under one id any order of the texts."""
    df = odd_documents(spark)
    got = fp.compare(df).collect()
    assert len(got) == df.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].fingerprint == by_id[2][0].fingerprint == by_id[3][0].fingerprint == "" and by_id[2][0].near_next == 1.0
    assert by_id[4][0].near_next == 0.0 and by_id[5][0] == by_id[5][1]
    assert fp.compare(empty_documents(spark)).count() == 0


def test_one_document_is_its_own_next(spark):
    t = prose(4, 90)
    one = spark.createDataFrame([(1, t), (1, t)], "doc_id long, text string")
    rows = fp.compare(one).collect()
    assert len(rows) == 2 and rows[0].near_next == 1.0
    assert rows[0].edited_sha256 == hashlib.sha256((t[:len(t) - len(t) // 3] + t[:len(t) // 3]).encode()).hexdigest()


def test_many_copies_long_texts_and_ranges(spark, monkeypatch):
    """A third of all rows is one row; a very long text; astral characters; the smallest and largest ids."""
    monkeypatch.setattr(fp, "COPIES", 7)
    monkeypatch.setattr(fp, "SEEN", 5)
    rows = [(i, prose(i, 20 + i % 50)) for i in range(200)] + [(77, prose(77, 47))] * 100
    rows += [(1000, prose(9, 60_000)), (1001, "\U0001F600 é " * 40), (2**63 - 1, prose(10, 40)), (-2**63, prose(11, 40)), (None, prose(12, 40))]
    check(fp.compare(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)), rows)


def test_likeness_of_columns(spark):
    docs = spark.createDataFrame([(1, prose(1, 200)), (2, prose(1, 180) + " " + prose(2, 20)), (3, ""), (4, None)], "doc_id long, text string")
    marks = fp.fingerprints(docs)
    got = {(r.a, r.b): r.v for r in marks.alias("x").crossJoin(marks.alias("y")).select(
        F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"),
        fp.likeness(F.col("x.fingerprint"), F.col("y.fingerprint")).alias("v")).collect()}
    assert got[1, 1] == got[3, 4] == 1.0 and got[1, 3] == 0.0 and 0.6 < got[1, 2] == got[2, 1] < 1
