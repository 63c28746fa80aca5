"""A fitted forest as a table of nodes: scoring by an array fold (ML-5, ML-6)
and the gains of the splits that a node could take (ML-3).

Node table: ``(tree, node, feature, threshold, left_values, left, right, p)``,
one row per node, node ids 0.. per tree with the root at 0.  A leaf has
``feature`` -1 and the share ``p`` of class 1.  An inner node sends a row left
when its feature is at most ``threshold``, or, where that is null, when it is
one of ``left_values``; NaN goes right.  The table's size is bounded by the model
(trees x 2^(depth + 1) nodes), not by the data.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.schemas import CATEGORICAL_FEATURES, MAX_DEPTH, ORDERED_NUMERIC_FEATURES

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left_values array<double>, "
               "left int, right int, p double")


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The node table of the forest in a saved pipeline's folder."""
    n = F.col("nodeData")
    leaf = n["split"]["featureIndex"] < 0
    numeric = n["split"]["numCategories"] < 0
    values = n["split"]["leftCategoriesOrThreshold"]
    total = F.aggregate(n["impurityStats"], F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path.rstrip('/')}/stages/*RandomForestClassifier*/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("node"),
        F.when(leaf, -1).otherwise(n["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf & numeric, values[0]).alias("threshold"),
        F.when(~leaf & ~numeric, values).alias("left_values"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        F.try_divide(n["impurityStats"][1], total).alias("p"))


def class_labels(model: PipelineModel) -> list[str]:
    """The machine classes in the order of their one-hot places."""
    return list(model.stages[0].labels)


def inputs(labels: list[str]) -> Column:
    """The model's input vector as an array: the class one-hot (an unknown or
    null class is all zeros), then the numbers in order, null as NaN."""
    one_hot = [F.when(F.col(CATEGORICAL_FEATURES[0]) == c, 1.0).otherwise(0.0) for c in labels]
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in ORDERED_NUMERIC_FEATURES]
    return F.array(*one_hot, *numbers)


def walk(df: DataFrame, nodes: DataFrame, x: Column, depth: int = MAX_DEPTH,
         out: str = "faulty_proba_raw") -> DataFrame:
    """``df`` with the mean of the leaves' ``p`` that its rows reach, over all
    trees.  The trees are one scalar subquery, so the rows are neither shuffled
    nor copied; each tree is a fold of ``depth`` steps.  A tree deeper than
    that raises; without trees the result is null."""
    rows = F.struct("node", "feature", "threshold", "left_values", "left", "right", "p")
    trees = (nodes.groupBy("tree").agg(F.sort_array(F.collect_list(rows)).alias("nodes"))
             .agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees")).scalar())

    def leaf_share(tree, vector):
        def step(node, _):
            value = vector[node["feature"]]
            left = F.when(node["threshold"].isNull(), F.array_contains(node["left_values"], value)) \
                .otherwise(value <= node["threshold"])
            return F.when(node["feature"] < 0, node).otherwise(
                tree["nodes"][F.when(left, node["left"]).otherwise(node["right"])])
        end = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), tree["nodes"][0], step)
        return F.transform(F.array(end), lambda e: F.when(e["feature"] < 0, e["p"]).otherwise(
            F.raise_error(F.lit(f"a tree is deeper than {depth}")).cast("double")))[0]

    # a one-element array binds the vector and the trees once per row; a subquery
    # can't stand inside a fold, so it becomes a column first
    bound = F.transform(F.array(F.struct("__x", "__trees")), lambda b: F.try_divide(
        F.aggregate(b["__trees"], F.lit(0.0), lambda a, t: a + leaf_share(t, b["__x"])), F.size(b["__trees"])))
    return (df.withColumn("__x", x).withColumn("__trees", trees)
            .withColumn(out, bound[0]).drop("__x", "__trees"))


def split_gains(df: DataFrame, label: str, thresholds: dict[str, list[float]], weight: str | None = None,
                node: Column | None = None) -> DataFrame:
    """Weighted Gini gain of every split ``feature <= threshold`` of every node:
    (node, feature, threshold, rows_left, rows_right, gain).

    ``node`` names a row's node (one node for all by default); ``weight`` is a
    column that holds one value per class, as class weights do.  Rows are
    counted per (node, feature, bin, class) in one aggregate, partial before
    the shuffle, so a heavy node costs no more than its bins; the rest works on
    those counts, which are exact.  NaN and null are above every threshold.
    A split with an empty side has gain 0."""
    def bin_of(feature, cuts):
        above = F.filter(F.array(*[F.lit(t) for t in cuts]), lambda t: ~(F.col(feature) <= t))
        return F.struct(F.lit(feature).alias("feature"), F.array_size(above).alias("bin"))

    grids = {f: sorted({float(t) for t in c}) for f, c in thresholds.items() if c}
    bins = [bin_of(f, c) for f, c in grids.items()]
    numbers = [F.coalesce(F.col(f).cast("double"), F.lit(float("nan"))).alias(f) for f in grids]
    rows = df.select((F.lit(0) if node is None else node).alias("node"), (F.col(label) == 1).alias("positive"),
                     (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"), *numbers)
    counts = (rows.select("node", "positive", "w", F.explode(F.array(*bins)).alias("b"))
              .groupBy("node", F.col("b.feature").alias("feature"), F.col("b.bin").alias("bin"), "positive", "w")
              .agg(F.count(F.lit(1)).alias("n")))
    part = lambda positive: F.coalesce(F.sum(F.when(F.col("positive") == positive, F.col("n"))), F.lit(0))
    heavy = lambda positive: F.max(F.when(F.col("positive") == positive, F.col("w")))
    cuts = df.sparkSession.createDataFrame(
        [(f, i, t) for f, c in grids.items() for i, t in enumerate(c)],
        "feature string, bin int, threshold double")
    per_bin = counts.groupBy("node", "feature", "bin").agg(
        part(True).alias("pos"), part(False).alias("neg"), heavy(True).alias("wp"), heavy(False).alias("wn"))
    of_node = Window.partitionBy("node", "feature")
    whole = per_bin.groupBy("node", "feature").agg(
        F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"),
        F.coalesce(F.max("wp"), F.lit(0.0)).alias("wp"), F.coalesce(F.max("wn"), F.lit(0.0)).alias("wn"))
    # every threshold, also those whose bin has no row
    grid = (whole.join(F.broadcast(cuts), "feature")
            .join(per_bin.select("node", "feature", "bin", "pos", "neg"), ["node", "feature", "bin"], "left"))
    upto = of_node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = grid.select("node", "feature", "threshold", "all_pos", "all_neg", "wp", "wn",
                       *[F.sum(F.coalesce(F.col(c), F.lit(0))).over(upto).alias(f"left_{c}") for c in ("pos", "neg")])

    lp, ln, ap, an = (F.col(c) for c in ("left_pos", "left_neg", "all_pos", "all_neg"))
    rp, rn = ap - lp, an - ln
    size = lambda p, n: p * F.col("wp") + n * F.col("wn")

    def gini(p, n):
        t = size(p, n)
        a, b = p * F.col("wp") / t, n * F.col("wn") / t
        return F.lit(1.0) - a * a - b * b

    gain = gini(ap, an) - size(lp, ln) / size(ap, an) * gini(lp, ln) - size(rp, rn) / size(ap, an) * gini(rp, rn)
    one_sided = (lp + ln == 0) | (rp + rn == 0)
    return sums.select("node", "feature", "threshold", (lp + ln).alias("rows_left"), (rp + rn).alias("rows_right"),
                       F.when(one_sided, 0.0).otherwise(gain).alias("gain"))
