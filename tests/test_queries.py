"""Every query with SQL against DuckDB on the smallest tables."""

import math

import pytest

import __spark_entry__

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = {k: v for k, v in __spark_entry__.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}


def test_every_query_has_sql():
    assert set(SQL) == {k for k in __spark_entry__.queries() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, db, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(columns).collect()), key=str)
    found = db.execute(SQL[name])
    have = [d[0] for d in found.description]
    assert sorted(have) == columns
    want = sorted((tuple(plain(r[have.index(c)]) for c in columns) for r in found.fetchall()), key=str)
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
