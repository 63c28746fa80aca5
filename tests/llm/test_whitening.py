import math

import numpy as np
import pytest
from corpus import SF

from faultline.llm import shared, whitening


def brute(rows, most=16):
    """{vec_id: [(n, deviation, |whitened| by component, explained)]} with Python integers."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dims = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(dims)]
    d = np.array([[n * x[k] - s[k] for k in range(dims)] for x in fit], dtype=object)
    v = ((d.T @ d) / (n ** 3)).astype(float)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    out = []
    for i, x in kept:
        dev = [n * x[k] - s[k] for k in range(dims)]
        w = np.array(dev, float) / n @ u / np.sqrt(e)
        for c in range(len(e)):
            out.append((i, c + 1, n, sum(a * a for a in dev), abs(w[c]), e[c] / np.trace(v)))
    return sorted(out)


def check(df, rows):
    got = sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained, r.identity_error) for r in df.collect())
    want = brute(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-6, atol=1e-7)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert len({g[6] for g in got}) == 1 and got[0][6] < 1e-9


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in shared.table(spark, SF, "embeddings").collect()]
    check(whitening.query(spark, SF), rows)


@pytest.mark.parametrize("size", [1, 63, 64, 65, 200])
@pytest.mark.parametrize("reach", [1, 100, 1 << 20, 1 << 39])
def test_block_sums_are_exact(size, reach):
    v = np.random.default_rng(size).integers(-reach, reach + 1, (size, 5))
    sums, cross = whitening.block_sums(v)
    big = v.astype(object)
    assert [int(x) for x in sums] == list(big.sum(0))
    assert (np.triu(big.T @ big) == cross).all()


def test_odd_rows_copies_and_blocks(spark, monkeypatch):
    """Nulls, non-finite and empty vectors, another length, clashing names, copies in many blocks."""
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(0, 0.3, 6)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(5, rows[5][1])]
    odd = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [math.nan] * 6), (904, [math.inf] + [0.0] * 5),
           (905, [1e300] + [0.0] * 5), (906, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + odd], "vec_id long, embedding array<double>, n long, v int")
    check(whitening.whiten(df), rows)


def test_large_entries(spark):
    """Wide entries; deviations that no long can hold are null."""
    rows = [(i, [float(i * 10_000), float(i % 3), float(-i * i)]) for i in range(40)]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)
    huge = [(i, [float((i % 5) << 30), float(i % 3)]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    # the narrow direction is zero to rounding beside the wide one
    assert len(got) == 40 and any(r.deviation is None for r in got) and got[0].identity_error < 1e-4


def test_nothing_to_fit(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)).count() == 0
    # a direction without variance is no component
    flat = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], schema)
    assert {r.component for r in whitening.whiten(flat).collect()} == {1}
