"""Driver contract: entry() smoke run, and every registered query against its
DuckDB SQL on the smallest data set (the same comparison the driver makes)."""

import decimal
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as se
from lakestrata.sources.tables import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "transaction_count" in df.columns


def test_registry_consistent():
    q, s = se.queries(), se.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 40


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_oracle_parity(spark, duck, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(se.oracle_sql()[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(rel.columns, orows)
