"""The forest as a node table, against Spark ML; split gains, against brute force."""

import math
import random
import tempfile
import time

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from faultline.operators import forest
from faultline.operators import model as ml
from faultline.plans.queries_model import training


def test_walk_equals_the_model(spark):
    t = training(spark, "/root/testdata/sf0.001")
    model = ml.build_pipeline(20, 8, weight_col=None).fit(t)
    path = tempfile.mkdtemp(prefix="faultline-test-forest-") + "/m"
    model.save(path)
    nodes = forest.saved_nodes(spark, path)
    labels = forest.class_labels(model)
    odd = t.limit(5)
    rows = (t.unionByName(odd.withColumn("machine_type", F.lit("Z")))
            .unionByName(odd.withColumn("machine_type", F.lit(None).cast("string")))
            .unionByName(odd.withColumn("temperature_C", F.lit(float("nan"))))
            .unionByName(odd.withColumn("avg_pressure_kPa_1h", F.lit(None).cast("double"))))
    both = forest.walk(ml.fault_probability(model, rows, "model_p"), nodes, forest.inputs(labels), out="walked")
    start = time.time()
    got = both.agg(F.max(F.abs(F.col("walked") - F.col("model_p"))).alias("off"), F.count("walked").alias("n"),
                   F.count_distinct("walked").alias("values")).first()
    print("seconds", time.time() - start)
    assert got.off < 1e-12 and got.n == t.count() + 20 and got.values > 10
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan


def test_walk_on_edge_tables(spark):
    t = training(spark, "/root/testdata/sf0.001").limit(3)
    x = forest.inputs(["A"])
    none = spark.createDataFrame([], forest.NODE_SCHEMA)
    assert [r.p for r in forest.walk(t, none, x, out="p").collect()] == [None] * 3
    chain = spark.createDataFrame([(0, 0, 1, 1e9, None, 1, 2, None), (0, 1, 1, 1e9, None, 3, 4, None)]
                                  + [(0, n, -1, None, None, -1, -1, n / 8) for n in (2, 3, 4)], forest.NODE_SCHEMA)
    assert forest.walk(t.limit(0), chain, x, out="p").collect() == []
    assert [r.p for r in forest.walk(t, chain, x, 2, "p").collect()] == [0.375] * 3
    with pytest.raises(Exception, match="deeper than 1"):
        forest.walk(t, chain, x, 1, "p").collect()


def brute_gain(rows, feature, cut, w):
    def gini(part):
        total = sum(w[r["y"]] for r in part)
        shares = [sum(w[c] for r in part if r["y"] == c) / total for c in (0, 1)]
        return 1 - sum(s * s for s in shares), total
    left = [r for r in rows if r[feature] is not None and not math.isnan(r[feature]) and r[feature] <= cut]
    right = [r for r in rows if r not in left]
    if not left or not right:
        return len(left), len(right), 0.0
    (g, n), (gl, nl), (gr, nr) = gini(rows), gini(left), gini(right)
    return len(left), len(right), g - nl / n * gl - nr / n * gr


def test_gains_equal_brute_force(spark):
    rng = random.Random(3)
    w = {0: 0.6, 1: 2.5}
    rows = [{"i": i, "k": rng.randrange(3), "y": int(rng.random() < 0.3), "a": rng.choice([None, float("nan"), 1.0, 2.0, 3.0, -1.0]),
             "b": float(rng.randrange(10))} for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k int, y int, a double, b double").withColumn(
        "w", F.when(F.col("y") == 1, w[1]).otherwise(w[0]))
    cuts = {"a": [2.0, 0.0, 2.0, 99.0], "b": [4.5, 7.0]}
    got = {(r.node, r.feature, r.threshold): r for r in forest.split_gains(df, "y", cuts, "w", F.col("k")).collect()}
    assert len(got) == 3 * 5
    for (k, f, c), r in got.items():
        left, right, gain = brute_gain([x for x in rows if x["k"] == k], f, c, w)
        assert (r.rows_left, r.rows_right) == (left, right) and abs(r.gain - gain) < 1e-12
    assert forest.split_gains(df.limit(0), "y", cuts, "w").collect() == []
    one = forest.split_gains(df.where("y = 1"), "y", cuts).collect()  # a pure node gains nothing
    assert all(r.gain == 0 for r in one)


def test_a_tree_takes_a_best_split(spark):
    rng = random.Random(5)
    rows = [(float(rng.randrange(6)), float(rng.randrange(8)), float(rng.randrange(4))) for _ in range(400)]
    df = spark.createDataFrame([(*r, int(r[1] + 2 * rng.random() > 5)) for r in rows], "a double, b double, c double, y int")
    names = ["a", "b", "c"]
    tree = RandomForestClassifier(featuresCol="v", labelCol="y", numTrees=1, maxDepth=1, bootstrap=False,
                                  featureSubsetStrategy="all", minInstancesPerNode=1, seed=1)
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="v"), tree]).fit(df)
    path = tempfile.mkdtemp(prefix="faultline-test-forest-") + "/m"
    model.save(path)
    root = forest.saved_nodes(spark, path).where("node = 0").first()
    cuts = {n: [k + 0.5 for k in range(m)] for n, m in zip(names, (5, 7, 3))}
    gains = {(r.feature, r.threshold): r.gain for r in forest.split_gains(df, "y", cuts).collect()}
    assert abs(gains[names[root.feature], root.threshold] - max(gains.values())) < 1e-12
