"""The driver's contract, and SQL oracles on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lexloom import queries as base

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda x: None if x is None or x != x else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted([str([plain(v[i]) for i in order]) for v in values])


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(base.ORACLE_SQL))
def test_oracle(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
