"""Daily sketches merged over any range of days, against plain statistics of the rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from beaconry.operators import daily

DAY = 86_400_000


def test_statements(spark):
    rng = random.Random(1)
    rows = [(q, "select", "pg", rng.choice(["ok", "error"]), rng.choice([-1, 0, 3]), day * DAY + rng.randrange(DAY), None if rng.random() < 0.01 else int(rng.expovariate(0.01)))
            for day in range(6) for q in ("a", "b") for _ in range(2000 if q == "a" else 3)]
    rows.append(("c", "select", None, "ok", 1, 5, None))
    df = spark.createDataFrame(rows, "normalized_query string, query_type string, database_type string, status string, rows_affected bigint, timestamp_millis bigint, duration_ms bigint")
    stored = daily.daily_statements(df)
    assert stored.count() == 13
    for first, last in ((0, 5), (2, 3)):
        chosen = [r for r in rows if first <= r[5] // DAY <= last]
        days = stored.where(F.col("day").between(*(F.date_from_unix_date(F.lit(d)) for d in (first, last))))
        got = {r.normalized_query: r for r in daily.merge_statements(days).collect()}
        for q in {r[0] for r in chosen}:
            mine = [r for r in chosen if r[0] == q]
            took = np.sort([r[6] for r in mine if r[6] is not None])
            r = got[q]
            assert (r.calls, r.errors, r.first_seen, r.last_seen) == (len(mine), sum(x[3] == "error" for x in mine), min(x[5] for x in mine), max(x[5] for x in mine))
            assert r.rows_affected == sum(max(x[4], 0) for x in mine) and r.max_ms == (took[-1] if len(took) else None)
            for share, p in ((0.5, r.p50_ms), (0.95, r.p95_ms)):
                if not len(took):
                    assert p is None
                    continue
                low, high = np.searchsorted(took, p, "left") / len(took), np.searchsorted(took, p, "right") / len(took)
                assert low - 0.034 <= share + 1 / len(took) and share - 1 / len(took) <= high + 0.034


def test_routes_and_sessions(spark):
    http = spark.createDataFrame([("s", "GET", "/a", 200 + 300 * (i % 2), i, 1000 * i) for i in range(100)], "service string, method string, path string, status_code int, duration_ms bigint, at bigint")
    r = daily.merge_routes(daily.daily_routes(http.withColumn("timestamp", F.timestamp_millis("at")))).first()
    assert (r.requests, r.errors, r.error_rate, r.max_ms) == (100, 50, 0.5, 99) and abs(r.p99_ms - 98) <= 4

    rows = [(f"v{i % 2}", "prod", day * DAY, f"u{i}", "crashed" if i % 5 == 0 else "ok", i % 7 != 0) for day in range(3) for i in range(500)]
    rows.append(("v0", "prod", 0, None, "ok", True))
    sessions = spark.createDataFrame(rows, "release string, environment string, started_ms bigint, user_id string, status string, ended boolean")
    got = {r.release: r for r in daily.merge_sessions(daily.daily_sessions(sessions)).collect()}
    for release in ("v0", "v1"):
        mine = [r for r in rows if r[0] == release]
        crashed = [r for r in mine if r[4] == "crashed" and r[5]]
        r = got[release]
        assert (r.sessions, r.crashed_sessions) == (len(mine), len(crashed))
        assert abs(r.users - 250) <= 16 and abs(r.crashed_users - len({x[3] for x in crashed})) <= 4
    assert daily.merge_sessions(daily.daily_sessions(sessions.limit(0))).collect() == []
