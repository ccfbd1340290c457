"""Envelope files, caps, retries, settlement, replay and the stream sinks."""

import json
import os
import pickle

import pandas as pd
from pyspark.sql import functions as F

from beaconry import schemas
from beaconry.operators import delivery, outbound, releases, retention, sampling
from beaconry.plans import derive
from beaconry.settings import Settings
from beaconry.sources import envelopes as env, spool as files
from beaconry.streaming import buckets, sinks, stateful

ERR, START = "/ingest/v1/errors", "/ingest/v1/sessions/start"


def spool(tmp_path, files):
    folder = tmp_path / "spool"
    folder.mkdir()
    for name, body in files.items():
        (folder / name).write_text(body if isinstance(body, str) else json.dumps(body))
    return str(folder)


def test_read(spark, tmp_path):
    folder = spool(tmp_path, {
        "100-a.json": {"path": ERR, "payload": {"b": 1.50, "a": [1, {"x": "é"}]}, "ts": 5}, "101-B2.json": {"path": ERR, "payload": {}, "ts": 6.5},
        "99-z.json": "{ not json", "102-c.json": {"path": 5, "payload": {}, "ts": 1}, "103-d.json": {"path": ERR, "payload": {}, "ts": "1"},
        "104-e.json": "null", "notes.json": {"path": ERR, "payload": {}, "ts": 1}, "105-f.json.tmp": "x", "106-g!.json": "{}",
    })
    good, bad = env.read_envelopes(spark, folder)
    rows = good.orderBy("file_name").collect()
    assert [(r.file_name, r.ts) for r in rows] == [("100-a.json", 5), ("101-B2.json", 6)]
    assert json.loads(rows[0].payload) == {"b": 1.5, "a": [1, {"x": "é"}]} and rows[0].size > 10
    assert sorted(r.file_name for r in bad.collect()) == ["102-c.json", "103-d.json", "104-e.json", "99-z.json"]


def test_rows_of_one_name(spark, tmp_path):
    """In one task, which writes them at the same time, and in several."""
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "notes-x.txt").otherwise(F.concat(F.lit("7-"), (F.col("id") % 5).cast("string"), F.lit(".json"))).alias("file_name"), F.lit("x" * 4000).alias("value"))
    for parts in (1, 4):
        folder = str(tmp_path / f"in{parts}")
        files.write_files(rows.repartition(parts), folder)
        assert sorted(os.listdir(folder)) == [*(f"7-{i}.json" for i in range(5)), "notes-x.txt"]
        assert {r.value for r in files.files(spark, folder).collect()} == {"x" * 4000}


def test_write_redacts(spark, tmp_path):
    df = spark.createDataFrame([(ERR, '{"password":"x","n":{"token":1}}', 1), (START, '{"k":"é"}', 2)], "path string, payload string, ts bigint")
    env.write_envelopes(df, str(tmp_path / "out"))
    got = {r.path: (r.payload, r.ts) for r in env.read_spool(spark, str(tmp_path / "out")).collect()}
    assert got == {ERR: ('{"password":"[REDACTED]","n":{"token":"[REDACTED]"}}', 1), START: ('{"k":"é"}', 2)}


def sized(spark, n, size):
    return spark.createDataFrame([("s", f"{1000 + i}-a.json", size, i * 1000) for i in range(n)], "spool string, file_name string, size bigint, ts bigint")


def names(df):
    return sorted(int(r.file_name.split("-")[0]) - 1000 for r in df.collect())


def test_caps(spark):
    assert names(retention.cap_entries(sized(spark, 6, 1), ["spool"], 3)) == [3, 4, 5]
    assert names(retention.cap_bytes(sized(spark, 8, 60), ["spool"], 220)) == [5, 6, 7]
    assert names(sampling.drop_expired(sized(spark, 3, 1), 2000, 1000)) == [1, 2]
    assert names(retention.compact_spool(sized(spark, 10, 60), ["spool"], 9000, 8000, 5, 130)) == [8, 9]


ATTEMPT = "envelope_id string, path string, attempt int, http_status int, retry_after string, at_ms bigint"


def test_retries(spark):
    rows = [("a", ERR, 0, 500, None, 0), ("a", ERR, 1, 503, "2", 0), ("a", ERR, 2, 500, "2", 0), ("a", ERR, 3, 500, None, 0), ("b", ERR, 0, 400, None, 0), ("c", ERR, 0, None, None, 0), ("d", ERR, 0, 200, None, 0), ("e", ERR, 0, 408, "9", 0)]
    got = {(r.envelope_id, r.attempt): r.wait_ms for r in delivery.plan_retries(spark.createDataFrame(rows, ATTEMPT)).collect()}
    assert 500 <= got["a", 0] < 625 and got["a", 1] == 2000 and 2000 <= got["a", 2] < 2500 and got["a", 3] is None
    assert got["b", 0] is None and 500 <= got["c", 0] < 625 and got["d", 0] is None and 500 <= got["e", 0] < 625
    late = spark.createDataFrame([("x", ERR, 9, 500, None, 0)], ATTEMPT)
    assert 8000 <= delivery.plan_retries(late, max_retries=20).first().wait_ms < 10000


def test_settlement(spark):
    rows = [("ok", ERR, 0, 500), ("ok", ERR, 1, 200), ("gone", ERR, 0, 503), ("bad", ERR, 0, 400), ("net", ERR, 0, None), ("sess", START, 0, 503)]
    att = spark.createDataFrame([(*r, None, 0) for r in rows], ATTEMPT)
    assert {r.envelope_id: r.outcome for r in delivery.settle(att).collect()} == {"ok": "delivered", "gone": "spooled", "bad": "dropped", "net": "spooled", "sess": "dropped"}
    assert {k: v.count() for k, v in delivery.settled_tables(att, spooling=False).items()} == {"delivered": 1, "spooled": 0, "dropped": 4}
    kept = spark.createDataFrame([("ok",), ("gone",), ("bad",), ("net",), ("new",)], "envelope_id string")
    assert {r.envelope_id for r in delivery.replay_remaining(kept, att).collect()} == {"gone", "net", "new"}
    full = att.withColumn("saturated", F.col("envelope_id").isin("ok", "sess"))
    drops = spark.createDataFrame([(5, 2), (1, 0)], "queued bigint, dropped bigint")
    assert tuple(delivery.delivery_stats(delivery.settle(full), drops).first()) == (3, 6, 3)


def test_drain(spark, tmp_path):
    files = {f"{100 + i}-a.json": {"path": p, "payload": {"i": i}, "ts": i} for i, p in enumerate([ERR, ERR, ERR, START])}
    folder = spool(tmp_path, files)

    def deliver(batch):
        code = F.when(F.col("file_name") == "100-a.json", 200).when(F.col("file_name") == "101-a.json", 400).otherwise(503)
        return batch.select("envelope_id", "path", F.lit(0).alias("attempt"), code.alias("http_status"), F.lit(0).alias("at_ms"))

    q = sinks.drain_stream(spark, folder, deliver, str(tmp_path / "left"), str(tmp_path / "cp"), available_now=True)
    q.awaitTermination()
    left = spark.read.schema("payload string, ts bigint, path string").json(f"{tmp_path}/left/batch=0")
    assert [(r.payload, r.ts) for r in left.collect()] == [('{"i":2}', 2)]


def deliver_some(status):
    def deliver(batch):
        return batch.select("envelope_id", "path", F.lit(0).alias("attempt"), status.alias("http_status"), F.lit(0).alias("at_ms"))

    return deliver


def test_drain_goes_by_name_and_settles(spark, tmp_path):
    """File times and names disagree, a file comes late, and a restart replays nothing that is settled."""
    folder = spool(tmp_path, {f"{100 + i}-a.json": {"path": ERR, "payload": {"i": i}, "ts": i} for i in range(6)})
    for i in range(6):
        os.utime(f"{folder}/{100 + i}-a.json", (2_000_000 - i, 2_000_000 - i))
    seen = []

    def deliver(batch):
        seen.append(sorted(r.file_name for r in batch.collect()))
        return deliver_some(F.lit(503))(batch)

    def drain(**options):
        q = sinks.drain_stream(spark, folder, deliver, str(tmp_path / "left"), str(tmp_path / "cp"), **options)
        q.processAllAvailable() if "every" in options else q.awaitTermination()
        q.stop()

    drain(every="0 seconds", max_files="2")
    assert seen == [["100-a.json", "101-a.json"], ["102-a.json", "103-a.json"], ["104-a.json", "105-a.json"]]
    (tmp_path / "spool" / "099-late.json").write_text(json.dumps({"path": ERR, "payload": {}, "ts": 0}))
    (tmp_path / "spool" / "106-a.json").write_text(json.dumps({"path": ERR, "payload": {}, "ts": 6}))
    drain(available_now=True)
    drain(available_now=True)
    assert seen[3:] == [["099-late.json", "106-a.json"]]
    # The last micro-batch settles when the next one is planned.
    assert sorted(f for f in os.listdir(folder) if f.endswith(".json")) == ["099-late.json", "106-a.json"]
    assert len([f for f in os.listdir(f"{folder}/_settled") if f.endswith(".json")]) == 6
    assert env.read_spool(spark, f"{tmp_path}/left").count() == 8


def test_an_unfinished_batch_comes_again(spark, tmp_path):
    folder = spool(tmp_path, {f"{100 + i}-a.json": {"path": ERR, "payload": {"i": i}, "ts": i} for i in range(3)})
    seen = []

    def deliver(batch):
        seen.append(sorted(r.file_name for r in batch.collect()))
        if len(seen) == 1:
            (tmp_path / "spool" / "103-a.json").write_text(json.dumps({"path": ERR, "payload": {}, "ts": 3}))
            raise OSError("no answer")
        return deliver_some(F.lit(200))(batch)

    for _ in range(3):
        q = sinks.drain_stream(spark, folder, deliver, str(tmp_path / "left"), str(tmp_path / "cp"), available_now=True, settled="delete")
        try:
            q.awaitTermination()
        except Exception as error:
            assert "no answer" in str(error)
    first = ["100-a.json", "101-a.json", "102-a.json"]
    assert seen == [first, first, ["103-a.json"]]
    assert [f for f in os.listdir(folder) if f.endswith(".json")] == ["103-a.json"] and not os.path.exists(f"{folder}/_settled")


def test_envelope_source(spark, tmp_path, capsys):
    folder = spool(tmp_path, {f"{1000 + i}-a.json": {"path": ERR, "payload": {"i": i}, "ts": i} for i in range(100)} | {"2000-x.json": "{", "notes.txt": "n"})
    (tmp_path / "spool" / "2001-y.json").write_bytes(b"\xff\xfe")
    rows = env.envelope_rows(files.files(spark, folder, partition_bytes=str(40 * (64 << 10))))
    assert rows.rdd.getNumPartitions() == 3
    got = {r.file_name: (r.ts, r.reason) for r in rows.collect()}
    assert len(got) == 102 and got["2000-x.json"] == (None, "json") and got["2001-y.json"] == (None, "unreadable") and got["1005-a.json"] == (5, None)
    good, bad = env.read_envelopes(spark, folder)
    late = good.where((F.col("file_name") > "1090-a.json") & F.col("file_name").startswith("10") & (F.col("ts") > 0))
    assert late.count() == 9 and bad.count() == 2
    late.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(file_name,1090-a.json)" in plan and "StringStartsWith(file_name,10)" in plan
    files.write_files(spark.createDataFrame([("7-a.json", "é"), ("7-a.json", "é"), ("8-b.json", None)], "file_name string, value string"), str(tmp_path / "new"))
    assert sorted(os.listdir(tmp_path / "new")) == ["7-a.json", "8-b.json"] and (tmp_path / "new" / "7-a.json").read_text() == "é"
    os.mkdir(tmp_path / "empty")
    assert files.files(spark, str(tmp_path / "empty")).count() == 0


def test_names_stay_out_of_the_driver(tmp_path, monkeypatch):
    """What a read and a stream hand to the driver does not grow with the names; lists are in order over many sorted runs."""
    monkeypatch.setattr(files, "RUN", 7, raising=False)
    names = [f"{(37 * i) % 400 + 1000}-a.json" for i in range(400)]
    folder = spool(tmp_path, dict.fromkeys([*names, "notes.txt"], "{}"))
    read = lambda source, parts: [n for p in parts for b in source.read(p) for n in b.column(0).to_pylist()]

    def few(parts):
        assert len(parts) > 1 and max(len(pickle.dumps(p)) for p in parts) < 1_000
        return parts

    size = str(150 * (64 << 10))
    for options in ({"lists": str(tmp_path / "lists")}, {}):
        reader = files.EnvelopeFiles({"path": folder, "partition_bytes": size, **options}).reader(None)
        assert read(reader, few(reader.partitions()) if options else reader.partitions()) == sorted(names)
    stream = files.EnvelopeFiles({"path": folder, "partition_bytes": size, "max_files": "300"}).streamReader(None)
    zero, one, two = stream.initialOffset(), stream.latestOffset(), stream.latestOffset()
    assert read(stream, few(stream.partitions(zero, one))) == sorted(names)[:300]
    assert read(stream, stream.partitions(one, two)) == sorted(names)[300:] and stream.latestOffset() == two
    # A manifest as it was written before: all names in one line without an end.
    (tmp_path / "spool" / "_progress" / "3").write_text(json.dumps([["999-a.json", 2], ["1005-a.json", 2]]))
    (tmp_path / "spool" / "998-a.json").write_text("{}")
    assert read(stream, stream.partitions(two, {"manifest": 3})) == ["999-a.json", "1005-a.json"]
    assert stream.latestOffset() == {"manifest": 4}
    stream.commit({"manifest": 4})
    assert len(os.listdir(f"{folder}/_settled")) == 401 and sorted(os.listdir(folder)) == ["_progress", "_settled", "notes.txt"]


def test_tables(spark, tmp_path):
    rows = [(ERR, '{"message":"m"}', 1), ("/ingest/v1/spans", '{"spans":[{"traceId":"a"},{"traceId":"b"}]}', 2), ("/x", "{}", 3), (ERR, "{ cut", 4), ("/ingest/v1/spans", "{}", None), (ERR, None, 5), (None, "[1]", 6)]
    spark.createDataFrame(rows, "path string, payload string, ts bigint").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("path string, payload string, ts bigint").parquet(str(tmp_path / "in"))
    sinks.write_tables(stream, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert {r.trace_id for r in spark.read.parquet(str(tmp_path / "out/spans")).collect()} == {"a", "b"}
    assert spark.read.parquet(str(tmp_path / "out/errors")).first().message == "m"
    assert env.route_envelopes(spark.read.parquet(str(tmp_path / "in")))["unknown"].count() == 2
    rejected = spark.read.parquet(str(tmp_path / "out/rejected")).collect()
    assert sorted((r.reason, str(r.path)) for r in rejected) == [("path", "/x"), ("path", "None"), ("payload", ERR), ("payload", ERR), ("rows", "/ingest/v1/spans")]
    assert spark.read.parquet(str(tmp_path / "out/errors")).count() == 1


def test_what_finds_no_partner(spark, tmp_path):
    hour = 3_600_000
    call = lambda key, kind, at: (key, kind, "http://h:80", "/p", "get", 200, at, "t", "p", "r", True)
    rows = [call("done", "create", hour), call("done", "headers", hour + 5), call("open", "create", hour), call("late", "create", hour), call("late", "headers", 3 * hour)]
    rows += [call("end", "create", 90 * hour), call("end", "headers", 90 * hour)]
    spark.createDataFrame(rows, schemas.raw("call_events")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.raw("call_events")).parquet(str(tmp_path / "in"))
    still = run(stateful.stream_open_calls(stream, "", "10 minutes", "1 hour"), tmp_path, "open")
    assert {r.call_key for r in still.collect()} == {"open", "late"}
    wide = run(stateful.stream_paired_calls(stream, "", "10 minutes", "1 day"), tmp_path, "wide")
    assert {r.call_key for r in wide.collect()} == {"done", "late", "end"}


def run(stream, tmp_path, name):
    out = str(tmp_path / f"{name}-out")
    stream.writeStream.option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_streams_equal_batch(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    lines = derive.raw(spark, folder, "call_lines")
    # One creation per key, as the stream form asks for.
    once = lines.groupBy("call_key").agg(F.count_if(F.col("kind") == "create").alias("n")).where("n = 1").select("call_key")
    calls = lines.join(once, "call_key")
    calls.write.parquet(str(tmp_path / "calls"))
    stream = spark.readStream.schema(calls.schema).parquet(str(tmp_path / "calls"))
    got = run(stateful.stream_paired_calls(stream, "ingest.example.com", "1 hour"), tmp_path, "calls")
    cols = ["call_key", "status_code", "status", "host", "path", "trace_id", "ended_ms"]
    want = outbound.pair_outbound_calls(calls, "ingest.example.com")
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))

    regs = derive.raw(spark, folder, "registrations").withColumn("at", F.timestamp_millis(F.lit(1_700_000_000_000)))
    regs.write.parquet(str(tmp_path / "regs"))
    live = spark.readStream.schema(regs.schema).parquet(str(tmp_path / "regs")).withWatermark("at", "1 hour")
    got = run(releases.register_releases(live), tmp_path, "regs")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, releases.register_releases(regs).collect()))


def test_reused_calls(spark, tmp_path):
    """Arrival in any order and over several micro-batches; what the watermark has passed is what the batch form says."""
    hour = 3_600_000
    call = lambda key, kind, at, code=None, sampled=None: (key, kind, "http://h:80", "/p", "get", code, at, None, None, None, sampled, at)
    rows = [
        call("a", "create", hour), call("a", "headers", hour + 5, 200), call("a", "create", hour + 9), call("a", "error", hour + 11), call("a", "headers", hour + 12, 503),
        call("b", "create", hour), call("b", "create", hour + 3), call("b", "headers", hour + 4, 404), call("b", "create", hour + 6, None, False), call("b", "headers", hour + 7),
        call("c", "create", hour), call("c", "headers", 9 * hour), call("d", "headers", hour), call(None, "create", hour), call(None, "headers", hour + 1, 200),
        call("e", "create", 2 * hour), call("e", "headers", 2 * hour + 1),
    ]
    schema = f"{schemas.raw('call_events').simpleString()[7:-1]}, seq bigint".replace(":", " ")
    spark.createDataFrame(rows[::-2], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame(rows[-2::-2], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([call("z", "create", 99 * hour)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = run(stateful.stream_reused_calls(stream, "", "10 hours", hour), tmp_path, "reused")
    want = outbound.pair_outbound_calls(spark.createDataFrame(rows, schema)).where(f"ended_ms - started_ms <= {hour}")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 5


def test_reused_calls_in_buckets(spark, tmp_path):
    """Call keys of the same bucket do not pair with each other, also over micro-batches."""
    call = lambda key, kind, at, seq: (key, kind, "http://h:80", "/p", "get", 200 if kind == "headers" else None, at, None, None, None, None, seq)
    rows = [call(f"k{k}", "create" if (k + i) % 3 else "headers", 3_600_000 + (7 * k + 31 * i) % 50, None if k == 5 and i == 0 else i) for k in range(50) for i in range(6)]
    schema = f"{schemas.raw('call_events').simpleString()[7:-1]}, seq bigint".replace(":", " ")
    for part in (rows[::2], rows[1::2], [call("z", "create", 99 * 3_600_000, 0)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = run(stateful.stream_reused_calls(stream, "", "10 hours", 3_600_000, buckets=2), tmp_path, "bucketed")
    want = outbound.pair_outbound_calls(spark.createDataFrame(rows, schema))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 20


def test_paired_calls_in_buckets(spark, tmp_path):
    """Keys of one bucket stay apart over micro-batches, the state has a row for a bucket, and what has passed leaves it."""
    hour, schema = 3_600_000, schemas.raw("call_events")
    call = lambda key, kind, at, code=None: (key, kind, "http://h:80", "/p", "get", code, hour + at, None, None, None, None)
    first = [call(f"k{k}", "create", k) for k in range(40)] + [call("early", "error", 9), call("early", "headers", 7, 200), call(None, "create", 1)]
    # One key has two completions in a micro-batch and another later, one a completion ahead of its creation.
    then = [call(f"k{k}", "headers", k + 5, 200) for k in range(0, 40, 2)] + [call("k0", "error", 2), call("early", "create", 3), call("k1", "headers", 0, 200), call(None, "headers", 2)]
    last = [call("k0", "headers", 6, 503), call("k3", "headers", 2 * hour, 200), call("z", "create", 99 * hour), call("z", "headers", 99 * hour)]
    for i, part in enumerate((first, then, last, [call("z", "error", 99 * hour + 1)], [call("k5", "headers", 8, 200)])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for file in (tmp_path / "in").glob("*.parquet"):
            os.utime(file, (1_000_000_000 + 100 * i,) * 2) if file.stat().st_mtime > 1_100_000_000 else None
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def drained(calls, name):
        writer = calls.writeStream.option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True)
        query = writer.format("parquet").option("path", str(tmp_path / name)).start()
        query.awaitTermination()
        states = [p["stateOperators"] for p in query.recentProgress]
        assert all(len(s) == 1 and s[0]["numRowsTotal"] <= 2 for s in states)
        return spark.read.schema(calls.schema).parquet(str(tmp_path / name)).collect()

    got = drained(stateful.stream_paired_calls(stream, "", "1 hour", buckets=2), "paired")
    want = {(f"k{k}", hour + k + 5, 200) for k in range(2, 40, 2)} | {("k0", hour + 2, 0), ("z", 100 * hour, 0)}
    early = [(r.ended_ms, r.status) for r in got if r.call_key == "early"]
    assert {(r.call_key, r.ended_ms, r.status_code) for r in got if r.call_key != "early"} == want and len(got) == len(want) + 1
    assert early in ([(hour + 9, "error")], [(hour + 7, "ok")])
    got = drained(stateful.stream_open_calls(stream, "", "1 hour", buckets=2), "open")
    assert sorted(str(r.call_key) for r in got) == sorted([f"k{k}" for k in range(1, 40, 2)] + ["None"])


class Bucket:
    """A bucket's state and timers without a stream."""

    def __init__(self):
        self.rows, self.timers = {}, set()
        self.getMapState = lambda *_: self
        self.containsKey, self.getValue, self.removeKey = self.rows.__contains__, self.rows.get, self.rows.pop
        self.updateValue, self.registerTimer, self.deleteTimer = self.rows.__setitem__, self.timers.add, self.timers.remove


def test_a_large_bucket_goes_by_parts(monkeypatch):
    """No more rows than a part has are one table, all of them are paired, and the state is in rows of parts."""
    n, within = 3_000, 3_600_000
    keys = [None if k == 7 else f"k{k}" for k in range(n)]
    schema, pair = stateful._pair_calls(within, 1)
    names = schema.names
    event = lambda key, kind, at: dict.fromkeys(names) | {"call_key": key, "rank0": at, "at_ms": at, "kind": kind, "status_code": 200}
    come = [event(k, kind, 1_000 + i + 5 * (kind != "create")) for kind in ("headers", "create") for i, k in enumerate(keys)]
    first = dict.fromkeys(stateful._CALL_EVENT.names, None)
    arrived = [first | {"call_key": e["call_key"], "at_ms": e["at_ms"], "until": e["at_ms"] + within, "free": e["at_ms"] + 2 * within, "kind": 0 if e["kind"] == "create" else 2, "status_code": 200} for e in come]
    for part in (1 << 20, 600):
        monkeypatch.setattr(buckets, "PART", part)
        for schemas_, work, rows, waits in (((schema,), pair, come, True), ((stateful._CALL_EVENT, stateful._CALL_DONE), stateful._first_calls(True), arrived, False)):
            seen, bucket = [], Bucket()

            def counted(*tables):
                seen.append(sum(len(t) for t in tables[:-1]))
                return work(*tables)

            processor = stateful._CallBuckets(schemas_, counted)
            processor.init(bucket)
            clock = type("Clock", (), {"mark": 0, "getCurrentWatermarkInMs": lambda self: self.mark})()
            batches = [pd.DataFrame(rows[i : i + 500]).astype({"call_key": object}) for i in range(0, len(rows), 500)]
            out = [len(t) for t in processor.handleInputRows((0,), iter(batches), clock)]
            assert sum(out) == (0 if waits else n) and len(bucket.timers) == 1 and (len(bucket.rows) > 1) == (part < n)
            assert max(seen) <= max(part, 2 * n if part > n else 0) and sum(seen) == 2 * n
            clock.mark = 10 * within
            bucket.timers.clear()
            out = [len(t) for t in processor.handleExpiredTimer((0,), clock, None)]
            assert sum(out) == (n if waits else 0) and not bucket.rows and not bucket.timers


def test_propagation(spark):
    df = spark.createDataFrame([("t", "s", "r", True, {"TRACEPARENT": "x"}), ("t", "s", "r", False, None)], "trace_id string, span_id string, request_id string, sampled boolean, headers map<string,string>")
    got = outbound.propagated_headers(df, settings=Settings(vendor="acme")).collect()
    assert (got[0].add_traceparent, got[1].add_traceparent) == (None, "00-t-s-00")
    assert got[0].add_baggage == "acme-trace_id=t,acme-request_id=r,acme-span_id=s" and got[0].add_trace_id == "t"
