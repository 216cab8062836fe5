"""Every registered query against its DuckDB oracle (order-insensitive, names sorted)."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from pasture.sources.tables import TABLES

from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and v != v:
        return ("nan",)
    if isinstance(v, decimal.Decimal):
        return ("D", str(v))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    exp = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, exp)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() >= 0 and len(df.columns) > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_energy_kwh" in df.columns
