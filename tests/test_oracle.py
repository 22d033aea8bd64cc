"""Every oracle-checked query against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from stratiform.sources.tables import TABLES

from conftest import SMALL

SQLS = E.oracle_sql()


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item") and not isinstance(v, str):
        v = v.item()
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)):
        return None if (isinstance(v, float) and math.isnan(v)) else round(float(v), 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SMALL).toPandas()
    want = con.sql(SQLS[name]).df()
    c1, r1 = _rows(got)
    c2, r2 = _rows(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    assert set(df.columns) == {"outcome", "outcome_code", "n", "share", "n_hospitals"}
