"""Driver contract, and every registered query against its DuckDB oracle on
the smallest fixture."""

import importlib

import duckdb
import pytest

from conftest import SF_SMALL

E = importlib.import_module("__spark_entry__")


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and set(rows[0].asDict()) == {"rmse", "mae", "bias", "rmsle"}


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    from checks.run_oracle import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    from checks.run_oracle import frame_hash
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = duck.execute(E.oracle_sql()[name]).df()
    assert len(s) == len(d)
    assert sorted(s.columns) == sorted(d.columns)
    assert frame_hash(s) == frame_hash(d)
