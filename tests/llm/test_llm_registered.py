"""The registered queries on the smallest tables: their SQL, or what their contract says of every row."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from beaconry.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) and len(QUERIES) == 14


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in names) for r in df.collect()) == Counter(cur.fetchall())


def test_quality_columns(spark, duck):
    rows = QUERIES["op1_quality"](spark, FOLDER).toPandas()
    assert len(rows) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.3)).all() and rows.score.between(0, 1).all()


def test_neighbours(spark, duck):
    ids, vectors = zip(*duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall(), strict=True)
    x = np.array(vectors, dtype=float)
    rows = QUERIES["op5_vantage_trees"](spark, FOLDER).toPandas()
    found = 0
    for q, answer in rows.groupby("query_id"):
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(axis=1))
        d[ids.index(q)] = np.inf
        found += len(set(answer.vec_id) & {ids[i] for i in np.argsort(d, kind="stable")[:10]})
        assert answer.sort_values("rank").score.is_monotonic_increasing and len(answer) == 10
    assert found >= 0.9 * len(rows)
