"""Every registered query against its DuckDB oracle (row count, column names, values)
at sf0.001; keys without an oracle must run and return rows."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import TABLES, canon, type_mismatches

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= 60


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(ORACLES[name])
    o_cols, o_rows = canon(rel.columns, rel.fetchall())
    assert s_cols == o_cols
    assert type_mismatches(df.schema, rel.columns, rel.types) == []
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 480
    assert "terminal_id_risk_7day_window" in df.columns
