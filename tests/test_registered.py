"""Every registered query against its DuckDB statement on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from beaconry.plans import oracle
from beaconry.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(oracle.statements()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    want = Counter(tuple(plain(v) for v in r) for r in cur.fetchall())
    assert Counter(tuple(plain(r[c]) for c in names) for r in df.collect()) == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "normalized_query" in df.columns
