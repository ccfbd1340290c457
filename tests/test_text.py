"""Statement fingerprints, URLs, clocks and delivery delays on literal cases."""

import pytest
from pyspark.sql import functions as F

from beaconry.functions import clock, sqltext, text, url
from beaconry.operators.database import build_db_rows, fingerprint_sql, query_fingerprint_stats, rows_affected
from beaconry.operators.routes import route_stats
from beaconry.schemas import raw

CASES = [
    ("select price from goods where sku = 'k-9' and stock > 17 -- low", "select price from goods where sku = ? and stock > ?", "SELECT"),
    ('SELECT "Lot" FROM "depot"."Shelf"', 'SELECT "Lot" FROM "depot"."Shelf"', "SELECT"),
    ("select 8, 9", "select ?, ?", "SELECT"),
    ("with top as (select a from b) select a from top", "with top as (select a from b) select a from top", "OTHER"),
    ("INSERT INTO crates VALUES (31)", "INSERT INTO crates VALUES (?)", "INSERT"),
    ("DELETE FROM t", "DELETE FROM t", "DELETE"),
    ("COMMIT;", "COMMIT;", "OTHER"),
    ("/* a\nb */ update t set a='it''s', b=$$x'y$$, c=1.5", "update t set a=?, b=?, c=?", "OTHER"),
    ("é42 t1 42é x_3 7", "é? t1 ?é x_3 ?", "OTHER"),
    ("a $1 1e5 0xFF", "a $? 1e5 0xFF", "OTHER"),
    ("'--x' y", "'", "OTHER"),
    ("'a''b''", "?'", "OTHER"),
    (" select  2", "select ?", "SELECT"),
    ("", "", "OTHER"),
]


def test_fingerprints(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, sql string")
    rows = fingerprint_sql(df).orderBy("i").collect()
    assert [(r.normalized_query, r.query_type) for r in rows] == [c[1:] for c in CASES]


def _model_hash(s: str) -> str:
    h = 0
    data = s.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i : i + 2], "big")) & 0xFFFFFFFF
    h = abs(h - 2**32 if h >= 2**31 else h)
    out = ""
    while h:
        h, d = divmod(h, 36)
        out = "0123456789abcdefghijklmnopqrstuvwxyz"[d] + out
    return out or "0"


def test_hash(spark):
    known = {"update bins set lot = ?": "b6gnua", "delete from q where z in (?, ?)": "rya8fz", "select kind from bins where lot = ? order by w": "cf9qge", "é😀x": "10urcc"}
    texts = [*known, "", "x" * 5000, "漢字 " * 40, "a😀" * 33]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.h for r in df.select("t", sqltext.text_hash(F.col("t")).alias("h")).collect()}
    assert all(got[k] == v for k, v in known.items())
    assert got == {t: _model_hash(t) for t in texts}


def test_utf16_prefix(spark):
    df = spark.createDataFrame([("a😀b",), ("abc",), ("",)], "t string")
    got = [tuple(r) for r in df.select(*[text.utf16_prefix(F.col("t"), n) for n in (1, 2, 3, 4)]).collect()]
    assert got == [("a", "a", "a😀", "a😀b"), ("a", "ab", "abc", "abc"), ("", "", "", "")]


@pytest.mark.parametrize("header, want", [
    ("2", 2000), ("Tue, 14 Nov 2023 22:13:25 GMT", 5000), (None, 0), ("   ", 0), ("soon", 0), ("12.5", 0), ("-3", 0),
    ("300", 300000), ("301", 300000), ("400", 300000), ("9" * 30, 300000), ("Tue, 14 Nov 2023 22:23:20 GMT", 300000),
    ("Tue, 14 Nov 2022 22:23:20 GMT", 0), ("Tue, 14 Nov 2023 25:13:25 GMT", 0), ("2023-11-14T22:13:21.500Z", 1500),
])
def test_retry_after(spark, header, want):
    df = spark.createDataFrame([(header,)], "h string")
    assert df.select(clock.retry_after_ms(F.col("h"), F.lit(1_700_000_000_000)).alias("r")).first().r == want


def test_iso_is_zone_free(spark):
    row = spark.range(1).select(clock.iso_millis(F.lit(1_700_000_000_123)), clock.iso_millis(F.lit(-1))).first()
    assert tuple(row) == ("2023-11-14T22:13:20.123Z", "1969-12-31T23:59:59.999Z")


@pytest.mark.parametrize("origin, host, port", [
    ("http://svc.internal:8080", "svc.internal", "8080"), ("https://api.example.com", "api.example.com", ""),
    ("http://1.2.3.4:9000", "1.2.3.4", "9000"), (None, "", ""), ("", "", ""), ("https://A.b:443/x?q", "a.b", ""),
    ("svc.internal/path", "svc.internal", ""), ("1.2.3.4:80/x", "1.2.3.4", "80"), ("localhost:8080", "", ""),
    ("http://[::1]:81/", "[::1]", "81"), ("http://u:p@h:81/y", "h", "81"), ("redis://Cache:6379/0", "Cache", "6379"),
    ("http://h:080", "h", ""), ("ws://h:443", "h", "443"),
])
def test_origins(spark, origin, host, port):
    df = spark.createDataFrame([(origin,)], "o string").select(url.parse_origin(F.col("o")).alias("p"))
    assert tuple(df.first().p) == (host, port)


@pytest.mark.parametrize("given, want", [("/v1/users?id=7", "/v1/users"), (None, "/"), ("", "/"), ("?x", ""), ("/a", "/a")])
def test_paths(spark, given, want):
    df = spark.createDataFrame([(given,)], "u string")
    assert df.select(url.inbound_path(F.col("u")).alias("p")).first().p == want


def test_db_rows(spark):
    rows = [
        ("select 1", 10, 30, "success", None, "d", "postgresql", 3, False, "t", "s"),
        ("select 2", 10, 30, "error", "e" * 600, None, "mysql", None, None, None, None),
        ("select 3", 10, 30, "success", None, "d", "sqlite", 3, True, "t", "s"),
    ]
    df = spark.createDataFrame(rows, raw("raw_queries"))
    got = build_db_rows(df).orderBy("status").collect()
    assert [(r.status, r.database_name, r.rows_affected, r.duration_ms, len(r.error_message or "")) for r in got] == [
        ("error", "", -1, 20, 500), ("success", "d", 3, 20, 0)
    ]
    exempt = df.withColumn("ignores_orm", F.lit(True))
    assert build_db_rows(exempt).count() == 3


def test_rows_affected(spark):
    df = spark.createDataFrame([(5, 6, 7), (None, None, 7), (None, None, None)], "row_count int, affected int, length int")
    got = df.select(*[rows_affected(d).alias(d) for d in ("postgresql", "mysql", "sqlite")]).collect()
    assert [tuple(r) for r in got] == [(5, 6, 6), (-1, 7, 7), (-1, -1, -1)]


def test_approximate_percentiles(spark):
    """Ranks are within n / accuracy; every other column is that of the exact form."""
    took = [(i * 7919) % 1000 + 1 for i in range(1000)]
    rows = [("q", "SELECT", "pg", ms, "error" if ms % 10 == 0 else "ok", 1, ms) for ms in took]
    db = spark.createDataFrame(rows, "normalized_query string, query_type string, database_type string, duration_ms bigint, status string, rows_affected bigint, timestamp_millis bigint")
    exact, near = query_fingerprint_stats(db).first().asDict(), query_fingerprint_stats(db, 100).first().asDict()
    assert abs(near.pop("p50_ms") - 500) <= 10 and abs(near.pop("p95_ms") - 950) <= 10
    assert (exact.pop("p50_ms"), exact.pop("p95_ms")) == (500.5, 950.05) and near == exact
    http = spark.createDataFrame([("s", "GET", "/a/1", ms, 500 if ms > 900 else 200) for ms in took], "service string, method string, path string, duration_ms bigint, status_code int")
    exact, near = route_stats(http, True).first().asDict(), route_stats(http, True, 100).first().asDict()
    for name, rank in (("p50_ms", 500), ("p95_ms", 950), ("p99_ms", 990)):
        assert abs(near.pop(name) - rank) <= 10 and abs(exact.pop(name) - rank) <= 1
    assert near == exact and near["errors"] == 100
