"""Tables of live files, and what streams keep from one micro-batch to the next, against the batch forms."""

import datetime
import random
import time

from pyspark.sql import functions as F

from beaconry.operators import batching, retention
from beaconry.plans import derive
from beaconry.streaming import kept, sinks
from beaconry.streaming.tables import ManifestTable

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, df.collect()))


def stream_of(df, tmp_path, parts, order=None):
    """A table as micro-batches: cut by ``order``, or shuffled."""
    spark, folder = df.sparkSession, str(tmp_path / "in")
    rows = df.collect()
    rows.sort(key=lambda r: r[order]) if order else random.Random(2).shuffle(rows)
    cuts = sorted(random.Random(3).sample(range(1, len(rows)), parts - 1))
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], df.schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_manifests(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"), "k int, v string, day date", ["day"])
    assert table.read().count() == 0
    day = datetime.date(2024, 1, 1)
    part = lambda b: spark.createDataFrame([(b * 10 + i, f"v{b}", day + datetime.timedelta(days=i % 2)) for i in range(10)], table.schema).repartition(3)
    for b in range(4):
        table.add(part(b), b)
    before, files = rows_of(table.read()), len(table.snapshot().files)
    table.add(part(3), 3)
    assert rows_of(table.read()) == before and len(before) == 40 and len(table.snapshot().files) == files

    old = table.read()
    late = table.snapshot()
    assert table.compact() > 0 and len(table.snapshot().files) == 2 and table.compact() == 0
    assert rows_of(table.read()) == before == rows_of(old)
    assert rows_of(table.read().where(F.col("day") == day)) == [r for r in before if "(2024, 1, 1)" in r]
    # A second compaction of the same files, begun before the first was seen, is void.
    table._publish(late, "compactlate", {"batch": None, "remove": sorted(late.files), "add": sorted(late.files.items())})
    assert rows_of(table.read()) == before
    table.add(part(4), 4)
    table.fold()
    assert len(table.read().collect()) == 50 and table.snapshot().has(2) and not table.snapshot().has(5)
    table.add(part(4), 4)
    assert table.vacuum(0) == files and len(table.read().collect()) == 50
    table.replace(table.read().where("k >= 40"), 5)
    table.replace(table.read().where("k < 0"), 5)
    assert sorted(r.k for r in table.read().collect()) == list(range(40, 50))


def test_a_write_without_its_manifest_is_never_read(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"), "k int")
    table.add(spark.range(3).selectExpr("cast(id as int) as k"), 0)
    table._written(spark.range(9).selectExpr("cast(id as int) as k"))
    assert table.read().count() == 3
    table.add(spark.range(5).selectExpr("cast(id as int) as k"), 1)
    assert table.read().count() == 8 and table.vacuum(0) > 0 and table.read().count() == 8


def envelopes(spark):
    e = derive.raw(spark, FOLDER, "envelopes").withColumn("queue_key", F.col("spool"))
    return e.withColumn("size", F.octet_length("payload").cast("bigint"))


def test_batches_do_not_depend_on_micro_batches(spark, tmp_path):
    rows = envelopes(spark).select("queue_key", "path", "seq", "payload")
    stream = stream_of(rows, tmp_path, 4, "seq")
    root = str(tmp_path / "root")
    kept.stream_batches(stream, root, str(tmp_path / "cp"), max_batch=7, available_now=True).awaitTermination()
    full = kept.sent_batches(spark, root)
    want = batching.pack_batches(rows, max_batch=7)
    merged = want.where(F.col("batch") < 10**6).where("envelopes = 7")
    assert rows_of(full.where("envelopes = 7")) == rows_of(merged) and merged.count() > 20
    kept.flush_batches(spark, root, rows.schema, max_batch=7)
    assert rows_of(kept.sent_batches(spark, root)) == rows_of(want)
    kept.flush_batches(spark, root, rows.schema, max_batch=7)
    assert rows_of(kept.sent_batches(spark, root)) == rows_of(want)


def test_a_batch_does_not_wait_for_ever(spark, tmp_path):
    rows = spark.createDataFrame([("q", "/ingest/v1/spans", i, '{"spans":[{}]}') for i in range(5)], "queue_key string, path string, seq bigint, payload string")
    kept.stream_batches(stream_of(rows, tmp_path, 2, "seq"), str(tmp_path / "r"), str(tmp_path / "cp"), max_batch=50, wait_ms=0, available_now=True).awaitTermination()
    got = kept.sent_batches(spark, str(tmp_path / "r")).orderBy("batch").collect()
    assert [r.batch for r in got] == [0, 1] and sum(r.rows for r in got) == 5


def test_db_batches_do_not_depend_on_micro_batches(spark, tmp_path):
    rows = [(f"q{i % 3}", 1_000 * (i // 2), f"select {i}", i) for i in range(200)] + [("q9", 10**9, "last", 1)]
    df = spark.createDataFrame(rows, "queue_key string, timestamp_millis bigint, normalized_query string, duration_ms bigint")
    order = ("timestamp_millis", "duration_ms")
    stream = stream_of(df, tmp_path, 5, "timestamp_millis")
    kept.stream_db_batches(stream, str(tmp_path / "r"), str(tmp_path / "cp"), order=order, n=4, every_ms=10_000, available_now=True).awaitTermination()
    want = batching.pack_db_batches(df, order=order, n=4, every_ms=10_000).where("queue_key <> 'q9'")
    assert rows_of(kept.sent_db_batches(spark, str(tmp_path / "r"))) == rows_of(want.select("queue_key", "window_ms", "flush", "rows", "path", "payload"))


def test_caps_over_micro_batches(spark, tmp_path):
    """Shuffled input, a repeated micro-batch, and what the byte cap dropped stays dropped."""
    rows = envelopes(spark).select("spool", "file_name", "path", "payload", "ts", "size")
    now = 1_706_745_600_000
    stream = stream_of(rows, tmp_path, 5)
    root, args = str(tmp_path / "spool"), (["spool"], now, 20 * 86_400_000, 60, 3_000)
    kept.keep_spool(stream, root, str(tmp_path / "cp"), *args, available_now=True).awaitTermination()
    want = retention.compact_spool(rows, ["spool"], *args[1:])
    assert rows_of(kept.kept(spark, root, rows.schema).drop("size")) == rows_of(want.drop("size")) and 0 < want.count() < rows.count()
    # The checkpoint is lost, the state is not: the same micro-batches come again.
    kept.keep_spool(stream, root, str(tmp_path / "cp2"), *args, available_now=True).awaitTermination()
    assert rows_of(kept.kept(spark, root, rows.schema)) == rows_of(want)

    kept.keep_newest(stream, str(tmp_path / "queue"), str(tmp_path / "cp3"), ["spool", "path"], ["file_name"], 5, available_now=True).awaitTermination()
    assert rows_of(kept.kept(spark, str(tmp_path / "queue"), rows.schema)) == rows_of(retention.cap_queue(rows, ["spool", "path"], ["file_name"], 5))


def test_live_tables(spark, tmp_path):
    rows = derive.raw(spark, FOLDER, "envelopes").select("path", "payload", "ts")
    stream = stream_of(rows, tmp_path, 4, "ts")
    root = str(tmp_path / "live")
    sinks.write_live_tables(stream, root, str(tmp_path / "cp"), available_now=True).awaitTermination()
    sinks.write_tables(stream, str(tmp_path / "plain"), str(tmp_path / "cp2"), available_now=True).awaitTermination()
    read = lambda t: rows_of(sinks.read_live_table(spark, root, t).drop("day").select("ts", *[c for c in sinks.read_live_table(spark, root, t).columns if c not in ("ts", "day")]))
    before = {t: read(t) for t in ("spans", "errors", "rejected")}
    plain = spark.read.parquet(str(tmp_path / "plain/spans"))
    assert len(before["spans"]) == plain.count() and before["rejected"]
    fewer = sinks.compact_live_tables(spark, root, keep_seconds=0)
    assert fewer["spans"] > 0 and {t: read(t) for t in before} == before
    days = spark.read.parquet(str(tmp_path / "plain/spans")).select("day").distinct().count()
    assert len(sinks._live(spark, root, "spans").snapshot().files) == days


def test_replays_leave_no_second_row(spark, tmp_path):
    """Rows with ids, rows without, and rejected ones: in one micro-batch, in later ones, and merged anew."""
    span = lambda i: f'{{"traceId":"t{i}","spanId":"s{i}","durationMs":{i}}}'
    spans, logs = "/ingest/v1/spans", "/ingest/v1/logs"
    first = [(spans, f'{{"spans":[{span(1)},{span(2)}]}}', 1000), (spans, f'{{"spans":[{span(2)}]}}', 1000), (logs, '{"message":"m"}', 1000), ("/x", "{}", 1000), (spans, "{ cut", None)]
    later = [(spans, f'{{"spans":[{span(3)},{span(1)}]}}', 1000), (logs, '{"message":"m"}', 1000), (logs, '{"message":"m"}', 5000), ("/x", "{}", 1000), (spans, "{ cut", None)]
    schema = "path string, payload string, ts bigint"
    for part in (first, later, first):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    root = str(tmp_path / "live")
    sinks.write_live_tables(stream, root, str(tmp_path / "cp"), available_now=True, once=True).awaitTermination()
    assert sorted(r.span_id for r in sinks.read_live_table(spark, root, "spans").collect()) == ["s1", "s2", "s3"]
    assert sorted(r.ts for r in sinks.read_live_table(spark, root, "logs").collect()) == [1000, 5000]
    assert sinks.read_live_table(spark, root, "rejected").count() == 2


def test_parts_follow_each_other(spark, tmp_path):
    """A part is one micro-batch, written by as many tasks as its rows lie in."""
    from beaconry.plans.queries import in_order

    seen = []

    def start(stream):
        q = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        return q.foreachBatch(lambda b, i: seen.append((i, sorted(r.seq for r in b.collect()), b.select(F.input_file_name()).distinct().count()))).start()

    in_order(spark.range(0, 90, 1, 4).withColumnRenamed("id", "seq"), 3, "seq", start)
    assert [s[:2] for s in seen] == [(i, list(range(30 * i, 30 * i + 30))) for i in range(3)] and seen[0][2] > 1
