"""The spread-out path of the ordered helpers gives what a plain model gives."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from beaconry.operators import batching, errors, outbound
from beaconry.operators.skew import lookup, match_one, newest, newest_within, numbered, running_total, with_next, with_previous


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    # One key holds most of the rows; NULL is a key too.
    return [(rng.choice(["hot"] * 6 + ["a", "b", None]), i, rng.randint(0, 9)) for i in rng.sample(range(5000), 900)]


def _groups(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: r[1]):
        out[r[0]].append(r)
    return out


@pytest.mark.parametrize("width", [7, 10**9])
def test_running_total_and_number(spark, rows, width):
    df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(5)
    total = running_total(df, ["k"], ["seq"], F.col("v"), "t", width)
    place = numbered(df, ["k"], ["seq"], "n", width)
    want_total, want_place = {}, {}
    for group in _groups(rows).values():
        run = 0
        for i, r in enumerate(group):
            run += r[2]
            want_total[r[1]], want_place[r[1]] = run, i + 1
    assert {r.seq: r.t for r in total.collect()} == want_total
    assert {r.seq: r.n for r in place.collect()} == want_place
    assert set(total.columns) == {"k", "seq", "v", "t"}


@pytest.mark.parametrize("width", [7, 10**9])
def test_previous(spark, rows, width):
    df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(5)
    got = with_previous(df, ["k"], ["seq"], F.struct("seq", "v"), "p", width)
    want = {}
    for group in _groups(rows).values():
        for before, r in zip([None, *group], group):
            want[r[1]] = before and (before[1], before[2])
    assert {r.seq: r.p and tuple(r.p) for r in got.collect()} == want
    following = {b[0]: s for s, b in want.items() if b}
    ahead = with_next(df, ["k"], ["seq"], F.col("seq"), "p", width)
    assert {r.seq: r.p for r in ahead.collect()} == {r[1]: following.get(r[1]) for r in rows}


@pytest.mark.parametrize("n", [1, 7, 2000])
def test_newest(spark, rows, n):
    df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(5)
    got = {r.seq for r in newest(df, ["k"], ["seq"], n).collect()}
    assert got == {r[1] for g in _groups(rows).values() for r in g[-n:]}


@pytest.mark.parametrize("limit", [0, 20, 333, 10**6])
def test_newest_within(spark, rows, limit):
    df = spark.createDataFrame(rows, "k string, seq int, v int").repartition(5)
    got = {r.seq for r in newest_within(df, ["k"], ["seq"], F.col("v"), limit, salts=8).collect()}
    want = set()
    for group in _groups(rows).values():
        total = 0
        for r in reversed(group):
            total += r[2]
            if total > limit:
                break
            want.add(r[1])
    assert got == want


def test_large_row_ends_the_run(spark):
    df = spark.createDataFrame([("s", i, 100 if i == 50 else 1) for i in range(100)], "k string, seq int, v int")
    got = {r.seq for r in newest_within(df, ["k"], ["seq"], F.col("v"), 99, salts=16).collect()}
    assert got == set(range(51, 100))


def test_lookup_keeps_every_left_row(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), ("z", 4), (None, 5), ("", 6)], "k string, i int")
    right = spark.createDataFrame([("a", "A"), (None, "N"), ("b", "B")], "k string, v string")
    assert {(r.i, r.v) for r in lookup(left, right, ["k"]).collect()} == {(1, None), (2, "A"), (3, "A"), (4, None), (5, None), (6, None)}


@pytest.mark.parametrize("salts", [1, 5])
def test_match_one(spark, rows, salts):
    left = spark.createDataFrame(rows, "k string, seq int, v int")
    right = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, w int")
    assert match_one(left, right, ["k"], ["seq"], salts).count() == sum(r[0] in ("hot", "a") for r in rows)


@pytest.mark.parametrize("width", [5, 10**9])
def test_breadcrumbs(spark, width):
    rng = random.Random(11)
    events = [(rng.choice(["hot", "hot", "x"]), i, rng.random() < 0.15) for i in range(700)]
    crumbs = spark.createDataFrame([(k, i, f"m{i}") for k, i, e in events if not e], "scope_key string, seq bigint, message string")
    errs = spark.createDataFrame([(k, i, i) for k, i, e in events if e], "scope_key string, seq bigint, error_id bigint")
    got = errors.attach_breadcrumbs(errs, crumbs, n=7, width=width)
    want = {}
    for k, i, e in events:
        if e:
            want[i] = [f"m{j}" for kk, j, ee in events if kk == k and not ee and j < i][-7:] or None
    assert {r.error_id: r.breadcrumbs and [c.message for c in r.breadcrumbs] for r in got.collect()} == want


@pytest.mark.parametrize("width", [5, 10**9])
def test_batches(spark, width):
    rows = [("q", "/ingest/v1/db", i, '{"queries":[{"n":%d}]}' % i) for i in range(120)]
    rows += [("q", "/ingest/v1/db", 500 + i, '{"queries":[]}') for i in range(50)]
    rows += [("q", "/ingest/v1/spans", i, '{"nothing":1}') for i in range(60)]
    rows += [("q", "/ingest/v1/logs", i, '{"m":%d}' % i) for i in range(3)]
    df = spark.createDataFrame(rows, "queue_key string, path string, seq int, payload string")
    got = {(r.path, r.batch): r for r in batching.pack_batches(df, width=width).collect()}
    assert got["/ingest/v1/db", 0].payload == '{"queries":[' + ",".join('{"n":%d}' % i for i in range(50)) + "]}"
    assert got["/ingest/v1/db", 2].rows == 20 and ("/ingest/v1/db", 3) not in got
    assert [got["/ingest/v1/spans", b].payload for b in (0, 1)] == ['{"spans":[]}'] * 2
    assert [got["/ingest/v1/logs", b].payload for b in range(3)] == ['{"m":0}', '{"m":1}', '{"m":2}']


CALL = "call_key string, seq bigint, kind string, origin string, path string, method string, status_code int, at_ms bigint, trace_id string, parent_span_id string, request_id string, sampled boolean"


def _call(key, seq, kind, code=None, origin="http://downstream.svc:8080", at=None, sampled=True, trace="t"):
    ids = (trace, "p" if trace else None, "r" if trace else None, sampled)
    return (key, seq, kind, origin, "/api/widgets?q=1", "post", code, seq if at is None else at, *ids)


@pytest.mark.parametrize("width", [1, 10**9])
def test_calls(spark, width):
    rows = [
        _call("ok", 1, "create"), _call("ok", 6, "headers", 201),
        _call("bad", 1, "create"), _call("bad", 2, "headers", 503),
        _call("lost", 1, "create"), _call("lost", 2, "error"),
        _call("open", 1, "create"), _call("stray", 1, "headers", 200),
        _call("self", 1, "create", origin="https://INGEST.example.com"), _call("self", 2, "headers", 200, origin="https://INGEST.example.com"),
        _call("unsampled", 1, "create", sampled=False), _call("unsampled", 2, "headers", 200, sampled=False),
        _call("orphan", 1, "create", trace=None, sampled=None), _call("orphan", 2, "headers", None, trace=None, sampled=None),
        # A key used again: the second creation replaces the open one, the second completion finds nothing.
        _call("again", 1, "create"), _call("again", 3, "create"), _call("again", 4, "headers", 200), _call("again", 5, "headers", 500),
    ]
    paired = outbound.pair_outbound_calls(spark.createDataFrame(rows, CALL), "ingest.example.com", width=width)
    got = {r.call_key: r for r in paired.collect()}
    assert {k: (r.status_code, r.status) for k, r in got.items()} == {
        "ok": (201, "ok"), "bad": (503, "error"), "lost": (0, "error"), "orphan": (0, "ok"), "again": (200, "ok")
    }
    assert got["again"].started_ms == 3 and got["orphan"].parent_span_id == "" and got["orphan"].request_id == got["orphan"].trace_id
    row = outbound.build_outbound_rows(paired).where("call_key = 'ok'").first()
    assert (row.method, row.host, row.path, row.duration_ms) == ("POST", "downstream.svc", "/api/widgets", 5)
    span = outbound.build_client_spans(paired).where("tags['statusCode'] = '201'").first()
    assert span.description == "POST downstream.svc/api/widgets" and span.data == '{"host":"downstream.svc","port":"8080","path":"/api/widgets"}'


def test_breadcrumbs_of_errors_that_share_an_id(spark):
    errs = spark.createDataFrame([("s", 5, "e"), ("s", 2, "e"), ("s", 5, None), (None, 1, "e")], "scope_key string, seq bigint, error_id string")
    crumbs = spark.createDataFrame([("s", 1, "a"), ("s", 4, "b"), ("s", 6, "c"), (None, 0, "d")], "scope_key string, seq bigint, message string")
    rows = errors.attach_breadcrumbs(errs, crumbs).collect()
    got = sorted((str(r.scope_key), r.seq, str(r.error_id), [c.message for c in r.breadcrumbs or []]) for r in rows)
    assert got == [("None", 1, "e", []), ("s", 2, "e", ["a"]), ("s", 5, "None", ["a", "b"]), ("s", 5, "e", ["a", "b"])]
