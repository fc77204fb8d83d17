"""Driver contract and brute-force parity: every registered query against its SQL oracle
on the smallest driver tables."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from meridian.plans import suite
from meridian.sources.tables import TABLES
from tests.conftest import SMALL


def test_contract_keys():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 40


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = {r.test_name: r.failures for r in df.collect()}
    assert df.columns == ["test_name", "failures"] and len(rows) == 6


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(suite.ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want = _bag([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert got == want
