"""Batch jobs matching the modelled entry points: training table (C1),
latest-hour materialisation (C2) and training with registration (C4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultline.operators import features as feat
from faultline.operators import model as ml
from faultline.operators import store as st
from faultline.operators.feature_store import FeatureStore
from faultline.sources import hourly
from faultline.sources.tables import load_readings, load_training_table, save_table


def training_table_job(spark: SparkSession, readings_path: str, output_path: str) -> dict:
    """C1: readings -> training table -> Parquet in one job (the modelled
    job recomputed the plan for each of its counts and its preview).  The
    counts are observed while the rows are written; nothing is read again."""
    table = feat.training_table(load_readings(spark, readings_path))
    seen = Observation("training_table")
    save_table(table.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("faulty"), F.lit(0)).alias("positives")),
               output_path)
    return {"rows": seen.get["rows"], "positives": seen.get["positives"]}


def materialize_job(spark: SparkSession, readings_path: str, store: str | FeatureStore,
                    as_of_ms: int | None = None, by_hour: bool = False) -> None:
    """C2: latest-hour averages appended to the feature table (a folder or a
    ``FeatureStore``).  The write is named after the end of its hour, which is the
    latest reading's time when ``as_of_ms`` is absent, so a re-run over the same
    readings replaces its earlier write.  ``by_hour``: the readings lie in hour
    folders, of which only the last hour's are read."""
    readings = hourly.recent(spark, readings_path, as_of_ms=as_of_ms) if by_hour else load_readings(spark, readings_path)
    end = as_of_ms if as_of_ms is not None else readings.agg(F.max("timestamp_ms")).first()[0]
    if end is None:
        return
    rows = st.materialize_latest(readings, as_of_ms=end)
    if isinstance(store, FeatureStore):
        store.append(rows, f"batch-{end}")
    else:
        st.append(rows, store, f"batch-{end}")


def training_job(spark: SparkSession, table_path: str, model_root: str, run_log: str,
                 stage: str = "Staging") -> DataFrame:
    """C4: fit on the past, evaluate on the future, save and log the run."""
    table = load_training_table(spark, table_path)
    model, _, metrics = ml.train_and_evaluate(table)
    example = ml.input_example(table)
    return ml.register_run(spark, model, metrics, model_root, run_log, stage=stage,
                           example=example)
