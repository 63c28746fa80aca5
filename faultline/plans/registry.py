"""Named queries over the provided tables, with their DuckDB oracles.

Every query reads the given tables (or fixtures Spark derives from them), so
its work grows with the input.  Window and group averages are checked on the
x100 integer fixture: sums are then exact in both engines, so averages agree
bit for bit; the sensor and feature columns are divided by 100 at the end in
both engines (raw double averages differ in the last bits between engines
because they sum in different orders, and rounding hits exact ties).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.plans import oracle_sql as O
from faultline.session import bound_tasks, ensure_utc
from faultline.sources import fixtures as fx
from faultline.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    bound_tasks(spark)
    return read_table(spark, sf_dir, "events")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.sensor(events(spark, sf_dir))


def sensor_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.sensor_scaled(events(spark, sf_dir))


def unscale(df: DataFrame, cols, factor: float = 100.0) -> DataFrame:
    """Divide x100-scaled columns back to units (same op in the oracle)."""
    cols = set(cols)
    return df.select(*[(F.col(c).cast("double") / F.lit(factor)).alias(c) if c in cols
                       else F.col(c) for c in df.columns])


# Import the query modules so that they register themselves.
from faultline.plans import (queries_batch, queries_model, queries_scalar,  # noqa: E402,F401,I001
                             queries_store, queries_stream)
