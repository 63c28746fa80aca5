"""Classification metrics as aggregations (AGG-6..9, PRJ-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str, proba: str | None, threshold: float | None = None,
              prediction: str | None = None) -> DataFrame:
    """Counts and class-1 precision / recall / F1 (zero division -> 0).

    Predicted positive is ``proba >= threshold`` (serving) or a given
    ``prediction`` column (argmax, as in training).
    """
    pred = F.col(prediction) == 1 if prediction else F.col(proba) >= F.lit(threshold)
    y = F.col(label) == 1
    agg = df.agg(
        F.sum(F.when(pred & y, 1).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(pred & ~y, 1).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(~pred & y, 1).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when(~pred & ~y, 1).otherwise(0)).cast("bigint").alias("tn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return agg.select("tp", "fp", "fn", "tn",
                      _ratio(tp, tp + fp).alias("precision_fault"),
                      _ratio(tp, tp + fn).alias("recall_fault"),
                      _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_fault"))


def roc_auc(df: DataFrame, label: str, score: str, bins: int = 1024) -> DataFrame:
    """AGG-9: exact ROC-AUC with ties counted half (Mann-Whitney form):
    ``sum over scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N)``.

    Negatives below each distinct score come from a two-level prefix sum:
    per score bin (a ``bins``-row table), then per distinct score inside its
    bin.  Bins hold about equal numbers of distinct scores: their edges are
    approximate quantiles of the distinct scores (``bins - 1`` values, read
    once), so scores crowded near 0 or 1 (the usual case for a rare class)
    do not all fall into one window task.  Bins only group scores, so the
    result is exact.  Null when only one class is present.
    """
    from pyspark.ml.feature import Bucketizer

    s = F.col(score).cast("double")
    per = (df.select(s.alias("s"), (F.col(label) == 1).alias("pos"))
             .where(F.col("s").isNotNull())
             .groupBy("s").agg(F.sum(F.col("pos").cast("bigint")).alias("np"),
                               F.sum((~F.col("pos")).cast("bigint")).alias("nn")))
    cuts = per.agg(F.percentile_approx("s", [i / bins for i in range(1, bins)], 10 * bins)).first()[0]
    edges = sorted({float(c) for c in (cuts or []) if c == c})
    splits = [float("-inf"), *edges, float("inf")]
    binned = Bucketizer(splits=splits, inputCol="s", outputCol="b",
                        handleInvalid="keep").transform(per)
    per_bin = binned.groupBy("b").agg(F.sum("nn").alias("nn_b"))
    bin_off = per_bin.select("b", F.coalesce(F.sum("nn_b").over(
        Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off_b"))
    within = binned.select("s", "np", "nn", "b", F.coalesce(F.sum("nn").over(
        Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("off_s"))
    terms = within.join(bin_off, "b").select(
        "np", "nn", (F.col("np") * (F.col("off_b") + F.col("off_s") + F.col("nn") / 2.0)).alias("t"))
    tot = terms.agg(F.sum("np").alias("n_pos"), F.sum("nn").alias("n_neg"),
                    F.sum("t").alias("u"))
    return tot.select(
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("u") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("roc_auc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("bigint").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("bigint").alias("n_neg"))
