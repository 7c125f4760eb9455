"""The driver contract, and every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quizloom.plans import queries as bank

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "hash" in df.columns


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_the_separable_part(monkeypatch):
    """Where a package that it needs is missing, all other queries stay."""

    def fails(name):
        raise ImportError(name)

    monkeypatch.setattr(entry.importlib, "import_module", fails)
    assert set(entry.queries()) == set(bank.QUERIES) and entry.oracle_sql() == bank.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(bank.ORACLE_SQL))
def test_against_sql(spark, sql, name):
    df = bank.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted(tuple(repr(r[c]) for c in names) for r in df.collect())
    result = sql.execute(bank.ORACLE_SQL[name])
    have = [c[0] for c in result.description]
    assert sorted(have) == names
    want = sorted(tuple(repr(r[have.index(c)]) for c in names) for r in result.fetchall())
    assert got == want


def test_all_have_sql():
    assert set(bank.QUERIES) == set(bank.ORACLE_SQL)
