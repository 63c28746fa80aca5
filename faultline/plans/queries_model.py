"""Split, class-weight and metric queries; model training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import metrics as M
from faultline.operators import ordered
from faultline.operators import split as sp
from faultline.plans import oracle_sql as O
from faultline.plans.queries_batch import _training_query, _training_sql
from faultline.plans.registry import events, register, sensor_scaled, unscale
from faultline.schemas import MODEL_NAME, ORDERED_NUMERIC_FEATURES, SENSORS, WINDOW_FAMILIES
from faultline.session import scratch_path, stored
from faultline.sources import fixtures as fx

# The training-table SQL is "WITH <fixture views>\nSELECT ..."; expose it as view ``tt``.
_head, _, _body = _training_sql(WINDOW_FAMILIES).partition("\nSELECT")
TT_VIEWS = _head + ",\ntt AS (SELECT" + _body + ")\n"
SC = O.with_views(O.SCORES)


def training(spark, sf_dir):
    return _training_query(WINDOW_FAMILIES)(spark, sf_dir)


@register("label_stats", TT_VIEWS + """SELECT count(*) AS n_rows, CAST(sum(faulty) AS BIGINT) AS n_positive,
  avg(CAST(faulty AS DOUBLE)) AS prevalence FROM tt""")
def q_label_stats(spark, sf_dir):
    return sp.label_stats(training(spark, sf_dir))


@register("class_weights", TT_VIEWS + """SELECT faulty, count(*) AS n_c,
  CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
FROM tt GROUP BY faulty""")
def q_class_weights(spark, sf_dir):
    return sp.class_weights(training(spark, sf_dir))


SPLIT_SQL = TT_VIEWS + """SELECT machine_id, event_timestamp, faulty,
  row_number() OVER (ORDER BY event_timestamp, machine_id) AS position,
  row_number() OVER (ORDER BY event_timestamp, machine_id) <= floor(count(*) OVER () * 0.8) AS is_train
FROM tt"""


@register("temporal_split", SPLIT_SQL)
def q_temporal_split(spark, sf_dir):
    t = training(spark, sf_dir).select("machine_id", "event_timestamp", "faulty")
    return sp.temporal_split(t)


@register("temporal_split_ordered", SPLIT_SQL)
def q_temporal_split_ordered(spark, sf_dir):
    """SRT-1/2 through a table in global order."""
    t = training(spark, sf_dir).select("machine_id", "event_timestamp", "faulty")
    return ordered.temporal_split(t, scratch_path(spark, "ordered"))


def _confusion_sql(thr):
    return f"""SELECT CAST({thr} AS DOUBLE) AS threshold, tp, fp, fn, tn,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision_fault,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall_fault,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_fault
FROM (SELECT CAST(sum(CASE WHEN p >= {thr} AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN p >= {thr} AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN p < {thr} AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN p < {thr} AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM scores) c"""


THRESHOLDS = [0.3, 0.5, 2.0]   # serving, argmax-equivalent, and none predicted


@register("confusion_metrics", SC + "\nUNION ALL\n".join(_confusion_sql(t) for t in THRESHOLDS))
def q_confusion(spark, sf_dir):
    s = fx.scores(events(spark, sf_dir))
    out = None
    for t in THRESHOLDS:
        c = M.confusion(s, "y", "p", t).select(F.lit(t).alias("threshold"), "*")
        out = c if out is None else out.unionByName(c)
    return out


@register("roc_auc", SC + """, d AS (SELECT p, sum(y) AS np, sum(1 - y) AS nn FROM scores GROUP BY p),
r AS (SELECT np, nn, coalesce(sum(nn) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d)
SELECT CASE WHEN sum(np) > 0 AND sum(nn) > 0 THEN sum(np * (below + nn / 2.0)) / (CAST(sum(np) AS DOUBLE) * sum(nn)) END AS roc_auc,
  CAST(sum(np) AS BIGINT) AS n_pos, CAST(sum(nn) AS BIGINT) AS n_neg FROM r""")
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(fx.scores(events(spark, sf_dir)), "y", "p")


@register("roc_auc_single_class", SC + """
SELECT CAST(NULL AS DOUBLE) AS roc_auc, CAST(0 AS BIGINT) AS n_pos, CAST(count(*) AS BIGINT) AS n_neg
FROM scores WHERE y = 0""")
def q_roc_auc_single(spark, sf_dir):
    return M.roc_auc(fx.scores(events(spark, sf_dir)).where(F.col("y") == 0), "y", "p")


@register("undersample", TT_VIEWS + """, r AS (
SELECT *, CAST('0x' || substr(md5(machine_id || '|' || epoch_ms(CAST(event_timestamp AS TIMESTAMP))), 1, 8) AS BIGINT) AS h
FROM tt)
SELECT * EXCLUDE (h, rk, nc, n) FROM (
  SELECT *, row_number() OVER (PARTITION BY faulty ORDER BY h) AS rk, count(*) OVER (PARTITION BY faulty) AS nc,
    count(*) OVER () AS n FROM r) t
WHERE rk <= round_even(nc * least(1.0, CAST(2000 AS DOUBLE) / n), 0)""")
def q_undersample(spark, sf_dir):
    """DOR-2: an exact share of each class, by a hash that both engines have."""
    t = training(spark, sf_dir)
    key = F.concat_ws("|", F.col("machine_id").cast("string"), F.unix_millis("event_timestamp").cast("string"))
    order = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return sp.undersample(t, target_rows=2_000, order=order)


# ---- model: train, register, score (rows-only checks) -----------------------

def _train(spark, sf_dir):
    from faultline.operators import model as ml
    return ml.train(training(spark, sf_dir))


@register("rf_test_scores")
def q_rf_test_scores(spark, sf_dir):
    """ML-1..5 + PRJ-7/8: fit on the past 80 %, score the future 20 %."""
    _, scored = _train(spark, sf_dir)
    return scored.select(
        "machine_id", F.unix_millis("event_timestamp").alias("timestamp_ms"), "faulty",
        F.col("prediction").cast("int").alias("prediction"),
        F.round("faulty_proba_raw", 3).alias("faulty_proba"),
        (F.col("faulty_proba_raw") >= F.lit(0.3)).alias("flagged"))


@register("rf_test_facts", TT_VIEWS + """SELECT machine_id, epoch_ms(CAST(event_timestamp AS TIMESTAMP)) AS timestamp_ms, faulty,
  true AS probability_ok, true AS prediction_ok FROM (
  SELECT *, row_number() OVER (ORDER BY event_timestamp, machine_id) AS position, count(*) OVER () AS n FROM tt) t
WHERE position > floor(n * 0.8)""")
def q_rf_test_facts(spark, sf_dir):
    """What must hold whatever the trees: the test rows, probabilities from 0
    to 1, and the more probable class as the prediction."""
    _, scored = _train(spark, sf_dir)
    p = F.col("faulty_proba_raw")
    return scored.select("machine_id", F.unix_millis("event_timestamp").alias("timestamp_ms"), "faulty",
                         p.between(0, 1).alias("probability_ok"),
                         (F.col("prediction") == (p > 0.5).cast("int")).alias("prediction_ok"))


@register("model_run_facts", """SELECT 'faultline_forest' AS name, 1 AS version, 'Production' AS stage,
  true AS auc_ok, true AS loaded_ok""")
def q_model_run_facts(spark, sf_dir):
    """A registered run: its AUC is Spark's own, its last stage the promoted
    one, and the loaded model scores like the fitted one."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from faultline.operators import model as ml
    base = scratch_path(spark, "models")
    model, scored = _train(spark, sf_dir)
    log = f"{base}/model_runs"
    ml.register_run(spark, model, ml.evaluate(scored), f"{base}/artifacts", log)
    ml.transition_stage(spark, log, MODEL_NAME, 1, "Production")
    loaded = ml.load_model(spark, log)
    auc = BinaryClassificationEvaluator(rawPredictionCol="faulty_proba_raw", labelCol="faulty", numBins=0).evaluate(scored)
    again = ml.fault_probability(loaded, scored.drop("faulty_proba_raw", "prediction"))
    keys = ["machine_id", "event_timestamp"]
    off = (scored.select(*keys, F.col("faulty_proba_raw").alias("p"))
           .join(again.select(*keys, F.col("faulty_proba_raw").alias("q")), keys)
           .agg(F.max(F.abs(F.col("p") - F.col("q"))).alias("off"), F.count("*").alias("n")))
    runs = spark.read.parquet(log).groupBy("name", "version").agg(
        F.max_by("stage", "created_at").alias("stage"), F.max("roc_auc").alias("auc"))
    return runs.crossJoin(off).select("name", "version", "stage", (F.abs(F.col("auc") - F.lit(auc)) < 1e-9).alias("auc_ok"),
                                      ((F.col("off") < 1e-12) & (F.col("n") > 0)).alias("loaded_ok"))


@register("model_runs")
def q_model_runs(spark, sf_dir):
    """SNK-5/6 + ML-7/8: register a version, promote it, load it back."""
    from faultline.operators import model as ml
    base = scratch_path(spark, "models")
    table = stored(training(spark, sf_dir), f"{base}/training")  # read twice
    model, scored = ml.train(table)
    example = ml.input_example(table)
    ml.register_run(spark, model, ml.evaluate(scored), f"{base}/artifacts", f"{base}/model_runs",
                    example=example)
    ml.transition_stage(spark, f"{base}/model_runs", MODEL_NAME, 1, "Production")
    ml.load_model(spark, f"{base}/model_runs", stage="Production")
    return spark.read.parquet(f"{base}/model_runs")


@register("fault_predictions")
def q_fault_predictions(spark, sf_dir):
    """ML-6 over history: point-in-time feature vectors of every reading
    (store = periodic batch runs + streaming writes), scored and thresholded."""
    from faultline.operators import model as ml
    from faultline.operators.scoring import feature_vectors, prediction_records
    from faultline.plans.queries_store import _stream_writes, q_periodic_materialize
    model, _ = _train(spark, sf_dir)
    r = sensor_scaled(spark, sf_dir)
    store = stored(q_periodic_materialize(spark, sf_dir).unionByName(_stream_writes(r)), scratch_path(spark, "writes"))
    ev = unscale(r.select("machine_id", "timestamp_ms", "machine_type", *SENSORS), SENSORS)
    vec = feature_vectors(ev, store)
    return prediction_records(ml.fault_probability(model, vec))


# ---- time-series cross-validation (DOR-3) -----------------------------------

CV_SPLITS = 3


@register("cv_folds", TT_VIEWS + f""", p AS (
  SELECT machine_id, event_timestamp, faulty,
    row_number() OVER (ORDER BY event_timestamp, machine_id) - 1 AS idx,
    count(*) OVER () AS n FROM tt),
q AS (SELECT *, n // {CV_SPLITS + 1} AS size, n - {CV_SPLITS} * (n // {CV_SPLITS + 1}) AS first_test FROM p)
SELECT machine_id, event_timestamp, faulty, idx + 1 AS position,
  CAST(CASE WHEN size > 0 AND idx >= first_test THEN (idx - first_test) // size END AS BIGINT) AS test_fold,
  CAST(CASE WHEN idx < first_test THEN 0
            WHEN (idx - first_test) // size < {CV_SPLITS - 1} THEN (idx - first_test) // size + 1 END AS BIGINT)
    AS first_train_fold
FROM q""")
def q_cv_folds(spark, sf_dir):
    """DOR-3: expanding-window fold of every training row."""
    t = training(spark, sf_dir).select("machine_id", "event_timestamp", "faulty")
    return sp.time_series_folds(t, CV_SPLITS)


CV_GRID = [{"n_trees": 20, "max_depth": 4}, {"n_trees": 20, "max_depth": 8}]


@register("cv_search")
def q_cv_search(spark, sf_dir):
    """DOR-3: grid search over time-series folds (rows-only check)."""
    from faultline.operators import model as ml
    return ml.grid_search_cv(training(spark, sf_dir), CV_GRID, n_splits=CV_SPLITS,
                             parallelism=len(CV_GRID) * CV_SPLITS)


# ---- a forest as a node table ------------------------------------------------

# Four hand-made trees over the model's inputs (three classes, then the numbers in order).
_AT = {c: i + 3 for i, c in enumerate(ORDERED_NUMERIC_FEATURES)}
FOREST = [
    (0, 0, _AT["temperature_C"], 48.0, None, 1, 2, None), (0, 1, _AT["avg_temperature_C_1h"], 48.5, None, 3, 4, None),
    (0, 2, -1, None, None, -1, -1, 0.75), (0, 3, -1, None, None, -1, -1, 0.125), (0, 4, -1, None, None, -1, -1, 0.5),
    (1, 0, 1, None, [0.0], 1, 2, None), (1, 1, _AT["max_vibration_mm_per_s_1min"], 3.25, None, 3, 4, None),
    (1, 2, _AT["rotor_speed_rpm"], 1500.0, None, 5, 6, None), (1, 3, -1, None, None, -1, -1, 0.0625),
    (1, 4, -1, None, None, -1, -1, 0.375), (1, 5, -1, None, None, -1, -1, 0.875), (1, 6, -1, None, None, -1, -1, 0.25),
    (2, 0, _AT["avg_pressure_kPa_5min"], 101.75, None, 1, 2, None), (2, 1, -1, None, None, -1, -1, 0.25),
    (2, 2, _AT["pressure_kPa"], 102.5, None, 3, 4, None), (2, 3, -1, None, None, -1, -1, 0.5), (2, 4, -1, None, None, -1, -1, 1.0),
    (3, 0, -1, None, None, -1, -1, 0.3125),
]
FOREST_DEPTH = 2


def _forest_sql():
    def value(v):
        return "NULL" if v is None else f"[{', '.join(map(str, v))}]::DOUBLE[]" if isinstance(v, list) else str(v)
    rows = ",\n  ".join("(" + ", ".join(map(value, r)) + ")" for r in FOREST)
    head, _, rest = TT_VIEWS.partition("WITH ")
    x = ", ".join([f"CASE WHEN machine_type = '{c}' THEN 1.0 ELSE 0.0 END" for c in "ABC"]
                  + [f"CAST({c} AS DOUBLE)" for c in ORDERED_NUMERIC_FEATURES])
    return f"""{head}WITH RECURSIVE {rest}, nodes(tree, node, feature, threshold, left_values, lft, rgt, p) AS (VALUES
  {rows}),
x AS (SELECT machine_id, event_timestamp, CAST([{x}] AS DOUBLE[]) AS v FROM tt),
walk AS (
  SELECT machine_id, event_timestamp, v, tree, 0 AS node FROM x, (SELECT DISTINCT tree FROM nodes) t
  UNION ALL
  SELECT machine_id, event_timestamp, v, w.tree,
    CASE WHEN CASE WHEN threshold IS NULL THEN list_contains(left_values, v[feature + 1]) ELSE v[feature + 1] <= threshold END
         THEN lft ELSE rgt END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE feature >= 0)
SELECT machine_id, epoch_ms(CAST(event_timestamp AS TIMESTAMP)) AS timestamp_ms, CAST(sum(p) AS DOUBLE) / 4 AS proba
FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE feature < 0
GROUP BY ALL"""


@register("forest_walk", _forest_sql())
def q_forest_walk(spark, sf_dir):
    """ML-5 without an ML transform: every training row walked through a forest's node table."""
    from faultline.operators import forest
    t = training(spark, sf_dir)
    nodes = spark.createDataFrame(FOREST, forest.NODE_SCHEMA)
    return forest.walk(t, nodes, forest.inputs(["A", "B", "C"]), FOREST_DEPTH, "proba").select(
        "machine_id", F.unix_millis("event_timestamp").alias("timestamp_ms"), "proba")


SPLIT_CUTS = {"temperature_C": [46.0, 47.0, 48.0, 49.0, 50.0], "vibration_mm_per_s": [2.25, 2.5, 3.0, 3.5],
              "pressure_kPa": [100.5, 101.5, 102.5], "rotor_speed_rpm": [1480.0, 1495.0, 1510.0, 1525.0]}
_CUT_ROWS = ", ".join(f"('{f}', {t})" for f, c in SPLIT_CUTS.items() for t in c)


def _gini(p, n):
    t = f"({p} * wp + {n} * wn)"
    return f"(CAST(1.0 AS DOUBLE) - ({p} * wp / {t}) * ({p} * wp / {t}) - ({n} * wn / {t}) * ({n} * wn / {t}))"


@register("root_split_gain", TT_VIEWS + f""", cw AS (
  SELECT max(CASE WHEN faulty = 1 THEN w END) AS wp, max(CASE WHEN faulty = 0 THEN w END) AS wn FROM (
    SELECT faulty, CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS w FROM tt GROUP BY faulty) c),
cuts(feature, threshold) AS (SELECT col0, CAST(col1 AS DOUBLE) FROM (VALUES {_CUT_ROWS})),
long AS (UNPIVOT (SELECT faulty, {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in SPLIT_CUTS)} FROM tt)
         ON {", ".join(SPLIT_CUTS)} INTO NAME feature VALUE v),
s AS (SELECT feature, threshold, count(*) FILTER (v <= threshold AND faulty = 1) AS lp,
    count(*) FILTER (v <= threshold AND faulty = 0) AS ln, count(*) FILTER (faulty = 1) AS ap, count(*) FILTER (faulty = 0) AS an
  FROM long JOIN cuts USING (feature) GROUP BY ALL),
g AS (SELECT *, ap - lp AS rp, an - ln AS rn FROM s, cw)
SELECT 0 AS node, feature, threshold, CAST(lp + ln AS BIGINT) AS rows_left, CAST(rp + rn AS BIGINT) AS rows_right,
  round(CASE WHEN lp + ln = 0 OR rp + rn = 0 THEN 0.0 ELSE {_gini("ap", "an")}
    - (lp * wp + ln * wn) / (ap * wp + an * wn) * {_gini("lp", "ln")}
    - (rp * wp + rn * wn) / (ap * wp + an * wn) * {_gini("rp", "rn")} END, 9) AS gain
FROM g""")
def q_root_split_gain(spark, sf_dir):
    """ML-3: gains of a root's candidate splits under the class weights, to 9 places."""
    from faultline.operators import forest
    t = training(spark, sf_dir).select("faulty", *SPLIT_CUTS)
    gains = forest.split_gains(sp.with_class_weight(t), "faulty", SPLIT_CUTS, "weight")
    return gains.withColumn("gain", F.round("gain", 9))
