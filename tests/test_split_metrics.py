"""Split positions, label statistics and metric edge cases."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators import split as sp


def test_temporal_split_past_before_future(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"machine_id": rng.integers(1, 13, 500),
                        "ms": rng.integers(0, 5_000_000, 500)})
    df = spark.createDataFrame(pdf).withColumn("event_timestamp", F.timestamp_millis("ms"))
    out = sp.temporal_split(df).toPandas()
    assert sorted(out.position) == list(range(1, 501))
    assert out.is_train.sum() == int(500 * 0.8)
    tr, te = out[out.is_train], out[~out.is_train]
    assert (tr.ms.max(), ) <= (te.ms.min(), )
    exp = pdf.sort_values(["ms", "machine_id"], kind="stable").reset_index(drop=True)
    got = out.sort_values("position")
    assert list(got.ms) == list(exp.ms)


def test_running_position_per_key(spark):
    pdf = pd.DataFrame({"k": [1, 1, 1, 2, 2], "t": [5, 1, 9_000_000, 3, 3], "e": [0, 1, 2, 3, 4]})
    got = sp.running_position(spark.createDataFrame(pdf), ["k"], "t", ["e"], bucket_ms=1000).toPandas()
    assert dict(zip(got.e, got.position)) == {1: 1, 0: 2, 2: 3, 3: 1, 4: 2}


def test_no_positive_predictions_gives_zeros(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "y int, p double")
    r = M.confusion(df, "y", "p", 0.3).first()
    assert (r.precision_fault, r.recall_fault, r.f1_fault) == (0.0, 0.0, 0.0)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, p double")
    assert M.roc_auc(df, "y", "p").first().roc_auc is None


def test_auc_matches_rank_formula_with_ties(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 2000)
    p = np.round(rng.random(2000) * 0.5 + y * 0.2, 2)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = M.roc_auc(df, "y", "p", bins=16).first().roc_auc
    ranks = pd.Series(p).rank(method="average").to_numpy()
    npos, nneg = y.sum(), (1 - y).sum()
    exp = (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * nneg)
    assert abs(got - exp) < 1e-12


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "faulty int")
    w = {r.faulty: r.weight for r in sp.class_weights(df).collect()}
    assert w == {0: 10 / 18, 1: 5.0}


def _expanding_folds(n, k):
    """Brute force: (train index list, test index list) per fold of an
    expanding-window split with equal test sizes ``n // (k + 1)``."""
    size = n // (k + 1)
    out = []
    for f in range(k):
        start = n - (k - f) * size
        out.append((list(range(start)), list(range(start, start + size))))
    return out


def test_time_series_folds_match_brute_force(spark):
    rng = np.random.default_rng(3)
    for n, k in ((103, 3), (10, 4), (57, 5)):
        pdf = pd.DataFrame({"machine_id": rng.integers(1, 13, n),
                            "ms": rng.integers(0, 5_000_000, n)})
        df = spark.createDataFrame(pdf).withColumn("event_timestamp", F.timestamp_millis("ms"))
        got = sp.time_series_folds(df, k).toPandas().sort_values("position")
        idx = (got.position - 1).to_numpy()
        for f, (train, test) in enumerate(_expanding_folds(n, k)):
            tr = idx[(got.first_train_fold.notna() & (got.first_train_fold <= f)).to_numpy()]
            te = idx[(got.test_fold == f).to_numpy()]
            assert sorted(tr) == train and sorted(te) == test, (n, k, f)
            # Past before future in the total order (time, machine).
            past = got[got.position - 1 < len(train)][["ms", "machine_id"]].max()
            assert tuple(past) <= tuple(got[(got.test_fold == f).to_numpy()][["ms", "machine_id"]].min())


def test_grid_search_cv_shape(spark):
    from faultline.operators import model as ml
    from faultline.plans.queries_model import training
    t = training(spark, "/root/testdata/sf0.001")
    res = ml.grid_search_cv(t, [{"n_trees": 3, "max_depth": 2}, {"n_trees": 3, "max_depth": 3}],
                            n_splits=2, parallelism=4).toPandas()
    assert len(res) == 4 and set(res.fold) == {0, 1}
    assert (res.n_test == t.count() // 3).all()
    assert set(res["rank"]) <= {1, 2}
    for c in ("precision_fault", "recall_fault", "f1_fault"):
        assert res[c].between(0, 1).all()


def test_positions_hot_time_duplicates_and_nulls(spark):
    # A third of the rows share one time value, some are exact duplicates,
    # one tie value is null: positions stay a permutation in the order.
    rows = [(7, 1000) for _ in range(40)] + [(m % 5, 1000) for m in range(60)] \
        + [(None, 1000), (None, 2000)] + [(m, 10 + m) for m in range(98)]
    df = spark.createDataFrame(rows, "machine_id int, ms long").withColumn(
        "event_timestamp", F.timestamp_millis("ms"))
    got = sp.global_position(df, ["event_timestamp", "machine_id"], F.col("ms")).toPandas()
    assert sorted(got.position) == list(range(1, len(rows) + 1))
    key = got.assign(m=got.machine_id.fillna(-1)).sort_values("position")[["ms", "m"]]
    assert list(map(tuple, key.to_numpy())) == sorted(map(tuple, key.to_numpy()))
    per = sp.running_position(df, ["machine_id"], "ms", []).toPandas()
    for _, g in per.groupby(per.machine_id.fillna(-1)):
        assert sorted(g.position) == list(range(1, len(g) + 1))
        assert list(g.sort_values("position").ms) == sorted(g.ms)


def test_auc_exact_with_scores_crowded_near_zero(spark):
    # Most scores in a tiny range (a rare class): equal-count bins still
    # give the exact rank-formula value.
    rng = np.random.default_rng(9)
    n = 4000
    y = (rng.random(n) < 0.05).astype(int)
    p = np.where(rng.random(n) < 0.95, rng.random(n) * 1e-3, rng.random(n))
    p = np.round(p + y * 1e-4, 7)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = M.roc_auc(df, "y", "p", bins=32).first().roc_auc
    ranks = pd.Series(p).rank(method="average").to_numpy()
    npos, nneg = y.sum(), (1 - y).sum()
    exp = (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * nneg)
    assert abs(got - exp) < 1e-12
