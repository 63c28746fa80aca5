import math

import numpy as np
from corpus import SF, groups

from faultline.llm import near_vectors, shared


def brute(rows, least=0.9):
    unit = {}
    for k, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            x /= np.abs(x).max()
            unit[k] = x / np.linalg.norm(x)
    links, edges = {k: 0 for k in range(len(rows))}, []
    for a in unit:
        for b in unit:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    part = groups(range(len(rows)), edges)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        smallest[part[k]] = min(smallest.get(part[k], i), i)
    return sorted((i, links[k], smallest[part[k]], i == smallest[part[k]]) for k, (i, _) in enumerate(rows))


def result(df):
    return sorted(tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect())


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in shared.table(spark, SF, "embeddings").collect()]
    assert result(near_vectors.query(spark, SF)) == brute(rows)


def test_clusters_copies_and_a_hot_bucket(spark, monkeypatch):
    """More rows in a bucket than a block holds, copies, and pairs around the threshold."""
    monkeypatch.setattr(near_vectors, "BLOCK", 32)
    r = np.random.default_rng(0)
    rows, centre = [], r.normal(size=32)
    for k in range(150):
        rows.append((k, (centre + r.normal(size=32) * 0.12).tolist()))
    for k in range(150, 250):
        rows.append((k, (r.normal(size=32) * (1 + k % 7)).tolist()))
    rows += [(250 + k, rows[3][1]) for k in range(70)] + [(400 + k, (np.array(rows[200 + k][1]) * 3).tolist()) for k in range(20)]
    shared.prepare(spark)
    got = result(near_vectors.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    want = brute(rows)
    assert sum(x[1] for x in got) >= 0.99 * sum(x[1] for x in want)
    # a link may be missed with a probability of at most MISS, never invented
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert [g[2] for g in got] == [w[2] for w in want]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1e-300, 1e-300]),
            (8, [1e300, 1e300]), (9, [1.0, 1.0, 0.0]), (10, [1.0, 1.0]), (10, [1.0, 1.0]), (11, [-1.0, -1.0]), (12, [3.0]),
            (13, [5.0]), (14, [-2.0])]
    shared.prepare(spark)
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, cls long, links string")
    assert result(near_vectors.link(df)) == brute(rows)
    assert near_vectors.link(df.limit(0)).collect() == []


def test_tables_reach_the_recall(spark):
    k, tables = near_vectors.design(50_000, 64, 0.9)
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = r.normal(size=x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.9 * x + math.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
    h = near_vectors.Hashes(64, k, tables)
    assert near_vectors.meet(h.buckets(x), h.buckets(y)).any(1).mean() > 0.99
