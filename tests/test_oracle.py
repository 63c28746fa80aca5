"""Every registered query with an oracle equals its DuckDB SQL (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, rows_of
from conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(df.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "avg_temperature_C_1h" in df.columns


def test_every_query_has_a_callable():
    assert set(ORACLES) <= set(E.queries())
