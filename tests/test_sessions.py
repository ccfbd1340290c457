"""Session folding against a step-by-step model, in batch, compacted and streaming form."""

import random
import time

import pytest

from beaconry.operators.sessions import (
    build_session_rows, compact_session_events, crash_free_rates, fold_sessions, reconcile_sessions,
)
from beaconry.schemas import raw
from beaconry.streaming.closing import close_sessions
from beaconry.streaming.stateful import stream_sessions


def event(session, seq, kind, final=None, at=None, release="v1", user="u"):
    return (session, seq, kind, final, seq * 10 if at is None else at, release, "prod", user, "node")


def frame(spark, rows):
    return spark.createDataFrame(rows, raw("session_events"))


def model(events):
    status, begin, end, final = "ok", None, None, None
    for e in sorted(events, key=lambda e: e[1]):
        kind = e[2]
        if end:
            break
        if kind == "start" and begin is None:
            begin, status = e, "ok"
        elif kind == "error" and status == "ok":
            status = "errored"
        elif kind == "crash":
            status = "crashed"
        elif kind == "abnormal" and status in ("ok", "errored"):
            status = "abnormal"
        elif kind == "end" and begin:
            end, final = e, e[3]
    if begin is None:
        return None
    return (final or status, None if end is None else max(0, end[4] - begin[4]))


@pytest.fixture(scope="module")
def histories():
    rng = random.Random(5)
    kinds = ["start", "error", "crash", "abnormal", "end", "error", "start"]
    out = {}
    for s in range(150):
        out[f"s{s}"] = [event(f"s{s}", i, rng.choice(kinds), rng.choice([None, None, "ok"]), rng.randint(0, 99)) for i in range(rng.randint(1, 9))]
    return out


def outcome(df):
    return {r.session_id: (r.status, r.duration_ms) for r in df.collect()}


def want(histories):
    return {s: model(e) for s, e in histories.items() if model(e)}


def test_transitions(spark):
    rows = [
        event("crashed", 1, "start", at=1000), event("crashed", 2, "error"), event("crashed", 3, "crash"), event("crashed", 4, "end", at=1500),
        event("errored", 1, "start"), event("errored", 2, "error"), event("errored", 3, "end"),
        event("early", 1, "error"), event("early", 2, "start"), event("early", 3, "end"),
        event("worse", 1, "start"), event("worse", 2, "abnormal"), event("worse", 3, "crash"), event("worse", 4, "error"), event("worse", 5, "end"),
        event("never", 1, "end"), event("twice", 1, "start"), event("twice", 2, "end"), event("twice", 3, "crash"), event("twice", 4, "end"),
    ]
    got = outcome(fold_sessions(frame(spark, rows)))
    assert got == {"crashed": ("crashed", 500), "errored": ("errored", 20), "early": ("ok", 10), "worse": ("crashed", 40), "twice": ("ok", 10)}


def test_random_histories(spark, histories):
    rows = [e for h in histories.values() for e in h]
    random.Random(1).shuffle(rows)
    assert outcome(fold_sessions(frame(spark, rows).repartition(5))) == want(histories)


def test_compacted_parts_fold_alike(spark, histories):
    parts = None
    for low, high in ((0, 3), (3, 5), (5, 99)):
        rows = [e for h in histories.values() for e in h if low <= e[1] < high]
        one = compact_session_events(frame(spark, rows))
        parts = one if parts is None else parts.unionByName(one)
    assert outcome(fold_sessions(parts)) == want(histories)


def test_stream(spark, histories, tmp_path):
    source = str(tmp_path / "in")
    for low, high in ((0, 2), (2, 4), (4, 99)):
        rows = [e for h in histories.values() for e in h if low <= e[1] < high]
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(raw("session_events")).option("maxFilesPerTrigger", 1).parquet(source)
    seen = {}

    def keep(batch, batch_id):
        seen.update(outcome(batch))

    q = stream_sessions(stream).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
    q.trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    assert seen == want(histories)


def test_rows_and_rates(spark):
    rows = []
    for i, (release, user, crash) in enumerate([("v1", "a", True), ("v1", "a", False), ("v1", "b", False), ("v2", "a", False), ("v2", None, True), ("", "z", True)]):
        s = f"s{i}"
        rows += [event(s, 1, "start", release=release, user=user), *([event(s, 2, "crash")] if crash else []), event(s, 3, "end")]
    rows.append(event("open", 1, "start", release="v2", user="c"))
    starts, ends = build_session_rows(frame(spark, rows))
    assert starts.count() == 6 and ends.count() == 5
    got = {(r.release, r.environment): (r.sessions, r.crashed_sessions, r.users, r.crashed_users) for r in crash_free_rates(ends, starts, totals=True).collect()}
    assert got == {("v1", "prod"): (3, 1, 2, 1), ("v2", "prod"): (3, 1, 2, 0), ("v1", None): (3, 1, 2, 1), ("v2", None): (3, 1, 2, 0), (None, None): (6, 2, 3, 1)}


def test_reconcile(spark):
    ends = spark.createDataFrame([("a", 1, "ok"), ("b", 1, "crashed"), ("c", 1, "errored"), ("d", 1, "ok")], "session_id string, duration_ms bigint, status string")
    errs = spark.createDataFrame([("a", "error"), ("b", "error"), ("c", "fatal"), (None, "fatal")], "session_id string, level string")
    assert {r.session_id: r.status for r in reconcile_sessions(ends, errs).collect()} == {"a": "errored", "b": "crashed", "c": "crashed", "d": "ok"}


def test_sessions_close_and_leave_the_state(spark, tmp_path):
    """Events in any order and over micro-batches; a row comes out once, and the state ends with the sessions."""
    rng = random.Random(4)
    hour = 3_600_000
    kinds = ["start", "error", "crash", "abnormal", "end", "other"]
    rows = []
    for s in range(40):
        for i in range(rng.randint(1, 12)):
            rows.append((f"s{s}", i, rng.choice(kinds), rng.choice([None, None, "ok"]), s * 60_000 + i * 1000, f"v{i}", "prod", None, "p"))
    rng.shuffle(rows)
    schema = raw("session_events")
    parts = [rows[i::5] for i in range(5)]
    # Sessions of the first micro-batches are over before the last ones arrive.
    parts += [[("late", 1, "start", None, 50 * hour, "v", "prod", "u", "p")], [(None, None, None, None, 100 * hour, None, None, None, None)]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = close_sessions(stream, "1 hour", 600_000).writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    q = q.format("parquet").option("path", str(tmp_path / "out")).start()
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = fold_sessions(spark.createDataFrame([r for p in parts for r in p if r[0]], schema))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20
    held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(held) > 40 and held[-1] == 0


def test_buckets_hold_many_sessions(spark, tmp_path):
    """Sessions of the same bucket do not touch each other, those without an id or an end time included; a bucket is one state row."""
    rng = random.Random(9)
    kinds = ["start", "error", "crash", "abnormal", "end", "other"]
    rows = []
    for s in range(60):
        for i in range(rng.randint(1, 9)):
            at = None if rng.random() < 0.1 else s * 1000 + i
            rows.append((f"s{s}" if s else None, 100 * s + i, rng.choice(kinds), rng.choice([None, "ok"]), at, f"v{i}", "prod", None, "p"))
    schema = raw("session_events")
    path, timed = str(tmp_path / "in"), [r for r in rows if r[0] and r[4] is not None]
    for low, high in ((0, 3), (3, 6), (6, 99)):
        part = [r for r in rows if low <= r[1] % 100 < high]
        spark.createDataFrame(part[::-1], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    seen = {}

    def keep(batch, batch_id):
        seen.update({r.session_id: tuple(r) for r in batch.collect()})

    q = stream_sessions(stream, buckets=3).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
    q = q.trigger(availableNow=True).foreachBatch(keep).start()
    q.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators) <= 3
    names = ["session_id", "release", "environment", "user_id", "started_ms", "ended_ms", "duration_ms", "status", "ended"]
    folded = fold_sessions(spark.createDataFrame([r for r in rows if r[0]], schema)).select(*names)
    assert {k: v for k, v in seen.items() if k} == {r.session_id: tuple(r) for r in folded.collect()} and len(seen) > 20

    spark.createDataFrame([(None, None, None, None, 99 * 3_600_000, None, None, None, None)], schema).coalesce(1).write.mode("append").parquet(path)
    q = close_sessions(stream, "1 hour", 600_000, buckets=3).writeStream.option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True)
    q = q.format("parquet").option("path", str(tmp_path / "out")).start()
    q.awaitTermination()
    got, want = spark.read.parquet(str(tmp_path / "out")), fold_sessions(spark.createDataFrame(timed, schema))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20
    held = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert max(held) <= 3 * 6 and held[-1] == 0
