"""The correctness gate: every registered query against its DuckDB oracle on sf0.001 (the driver runs the
same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from raw_rows import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _canon(df.columns, srows) == _canon(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month", "avg_pm25"]
    assert df.count() == 24
