import math

import numpy as np
from corpus import odd_documents, prose
from pyspark.sql import functions as F

from faultline.llm import shared, toxicity


def brute_segments(scores):
    """All maximal segments: the best one, then the rest to its left and right."""
    if not scores or max(scores) <= 0:
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    best = max(((total[j] - total[i], -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    i, j = best[3], best[4]
    return [(s, a, b) for s, a, b in brute_segments(scores[:i])] + [(best[0], i, j - 1)] + \
        [(s, a + j, b + j) for s, a, b in brute_segments(scores[j:])]


def test_segments_equal_brute_force():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = int(r.integers(1, 25))
        hit = r.random(n) < 0.35
        value = np.round(r.exponential(1.0, n), 3) + 0.017 * np.arange(n)
        scores = np.where(hit, value, -0.31)
        at = np.flatnonzero(hit)
        got = toxicity.segments(at, value[at], 0.31)
        want = brute_segments(scores.tolist())
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert np.allclose([s for s, _, _ in got], [s for s, _, _ in want])


def test_rate_solves_the_equation():
    prob, value = np.array([0.01, 0.002]), np.array([1.0, 3.0])
    x = toxicity.solve_rate(prob, value)
    assert math.isclose((1 - prob.sum()) * math.exp(-toxicity.DRIFT * x) + (prob * np.exp(value * x)).sum(), 1, abs_tol=1e-6)


def corpus(spark):
    bad = ["grumbach", "fizzlor", "wombrat", "snorkle"]
    rows, labels = [], []
    for i in range(600):
        w = prose(1000 + i, 40 + i % 90).split()
        toxic = i % 5 == 0
        if toxic:
            for k in range(3 + i % 4):
                w.insert((7 * k) % len(w), bad[(i + k) % 4] + ["", "en", "ai", ","][k % 4])
        rows.append((i, " ".join(w)))
        if i % 2 == 0 or i % 5 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_learns_from_its_sample_only(spark):
    shared.prepare(spark)
    rows, labels = corpus(spark)
    docs = odd_documents(spark, [(i + 100, t) for i, t in rows] + [(5000, prose(9, 30) + " fizzlors wombratto " + prose(8, 30))])
    known = spark.createDataFrame([(i + 100, y, 1) for i, y in labels if i < 400], "doc_id long, toxic int, score int")
    got = {}
    for r in toxicity.score(docs, known).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        got.setdefault(r.doc_id, r)
    wrong = [i for i, _ in rows if got[i + 100].predicted != int(i % 5 == 0)]
    assert len(wrong) <= 3
    assert got[5000].predicted == 1  # forms that were not in training
    assert all(got[i].predicted == 0 for i in (1, 2, 3, 4, 5, 6, None, 9, 10))
    assert got[100].passages and not got[101].passages


def test_without_labels_and_empty(spark):
    shared.prepare(spark)
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    out = toxicity.score(docs, labels)
    assert out.count() == docs.count()
    assert out.where("predicted = 1 or score is null or score > 0.01").count() == 0
    assert toxicity.score(docs.limit(0), labels).collect() == []


def test_query_uses_no_held_out_label(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.query(spark, sf)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    assert got.count() == 1000 and got.where(F.col("held_out") != held).count() == 0
    truth = shared.table(spark, sf, "labels")
    j = got.join(truth, "doc_id").where("held_out")
    tp, fp, pos = j.agg(F.sum((F.col("predicted") * F.col("toxic"))), F.sum(F.col("predicted") * (1 - F.col("toxic"))),
                        F.sum("toxic")).first()
    assert fp <= 2 and tp >= 0.5 * pos  # few labels at this size
