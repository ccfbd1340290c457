"""Stream sinks: table writer and spool drain."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from beaconry.functions.clock import DAY_MS
from beaconry.operators.delivery import replay_remaining
from beaconry.operators.sampling import non_persistable
from beaconry.operators.sessions import compact_session_events
from beaconry.schemas import TABLES, record
from beaconry.settings import Settings
from beaconry.sources.envelopes import flatten, rejection, stream_envelopes, write_envelopes
from beaconry.streaming.tables import TARGET_BYTES, ManifestTable

# Fixed value: flush interval.
FLUSH = "2 seconds"


def _trigger(writer, available_now: bool, every: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def write_tables(
    envelopes: DataFrame, root: str, checkpoint: str, every: str = FLUSH, available_now: bool = False
) -> StreamingQuery:
    """Flush a stream of envelopes to one parquet table per record kind, by UTC day of ``ts`` and micro-batch.

    Envelopes without rows to write (see :func:`~beaconry.sources.envelopes.rejection`) go, as they came and with
    the ``reason``, to the table ``rejected``. A repeated micro-batch replaces its own ``day``/``batch`` folders,
    so it leaves no duplicates, and a filter on the day lists that day's folders only.
    """
    day = F.date_from_unix_date(F.floor(F.col("ts") / DAY_MS).cast("int"))

    def save(rows: DataFrame, table: str, batch_id: int) -> None:
        placed = rows.withColumn("day", day).withColumn("batch", F.lit(batch_id))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "batch").parquet(f"{root}/{table}")

    def flush(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("reason", rejection()).persist(StorageLevel.DISK_ONLY)
        try:
            good = batch.where(F.col("reason").isNull())
            for table in TABLES:
                save(flatten(good, table, ("ts",)), table, batch_id)
            save(batch.where(F.col("reason").isNotNull()).select("path", "payload", "ts", "reason"), "rejected", batch_id)
        finally:
            batch.unpersist()

    writer = envelopes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush)
    return _trigger(writer, available_now, every).start()


def _live(spark: SparkSession, root: str, table: str) -> ManifestTable:
    rejected = "path STRING, payload STRING, ts BIGINT, reason STRING"
    schema = T.StructType.fromDDL(rejected) if table == "rejected" else T.StructType([T.StructField("ts", T.LongType()), *record(table).fields])
    return ManifestTable(spark, f"{root}/{table}", T.StructType([*schema.fields, T.StructField("day", T.DateType())]), ["day"])


# What a record is known by where it has ids of its own; others by all of their columns.
RECORD_IDS = {"http_requests": ("trace_id", "span_id"), "spans": ("trace_id", "span_id")}
# The keys of delivered records lie in slots of so much of their envelope's time.
SLOT_MS = 3_600_000


def _seen(spark: SparkSession, root: str, table: str) -> ManifestTable:
    return ManifestTable(spark, f"{root}/_seen/{table}", "slot BIGINT, h1 BIGINT, h2 BIGINT", ["slot"])


def _new_rows(rows: DataFrame, seen: ManifestTable, ids: Sequence[str], slot_ms: int) -> DataFrame:
    """The rows, each once, whose key is in no delivered slot, with ``slot``, ``h1`` and ``h2``."""
    whole = F.to_json(F.struct(*rows.columns))
    key = whole
    if ids:
        known = [F.col(i).isNotNull() for i in ids]
        key = F.when(functools.reduce(Column.__and__, known), F.concat_ws("\x1f", *ids)).otherwise(whole)
    keyed = rows.withColumn("slot", F.floor(F.col("ts") / slot_ms)).withColumn("_key", key)
    keyed = keyed.withColumns({"h1": F.xxhash64("_key"), "h2": F.xxhash64(F.lit("second"), "_key")}).drop("_key")
    once = keyed.dropDuplicates(["slot", "h1", "h2"])
    # A replayed envelope carries its first time, so only the slots of this micro-batch are asked.
    slots = [r.slot for r in keyed.select("slot").distinct().collect() if r.slot is not None]
    there = seen.read().where(F.col("slot").isin(slots) | F.col("slot").isNull()).withColumnsRenamed({c: f"_{c}" for c in ("slot", "h1", "h2")})
    return once.join(there, F.col("slot").eqNullSafe(F.col("_slot")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left_anti")


def write_live_tables(
    envelopes: DataFrame, root: str, checkpoint: str, every: str = FLUSH, available_now: bool = False,
    once: bool = False, slot_ms: int = SLOT_MS,
) -> StreamingQuery:
    """:func:`write_tables` into tables of live files, which :func:`read_live_table` reads and :func:`compact_live_tables`
    keeps few: readers see whole micro-batches, before, while and after files are put together. Only the record kinds
    that a micro-batch holds are written.

    With ``once`` an envelope that is delivered again, however late, leaves no second row. A record is known by its
    trace and span ids, or by all of its columns where it has none, and the time of its envelope; the hashes of what
    was delivered are kept, sorted, in slots of that time, and a micro-batch asks the slots that it touches. Choose
    ``slot_ms`` so that a micro-batch of fresh envelopes touches a few; it must stay the same for a ``root``.
    """
    day = F.date_from_unix_date(F.floor(F.col("ts") / DAY_MS).cast("int"))

    def save(rows: DataFrame, table: str, batch_id: int) -> None:
        live = _live(rows.sparkSession, root, table)
        if not once:
            live.add(rows.withColumn("day", day), batch_id)
            return
        seen = _seen(rows.sparkSession, root, table)
        if seen.snapshot().has(batch_id):
            return
        new = _new_rows(rows, seen, RECORD_IDS.get(table, ()), slot_ms).persist(StorageLevel.DISK_ONLY)
        try:
            # Rows first: a micro-batch cut short in between finds its rows in, and adds their keys.
            live.add(new.withColumn("day", day).repartitionByRange("day", "h1"), batch_id)
            seen.add(new.select("slot", "h1", "h2").repartitionByRange("slot", "h1").sortWithinPartitions("slot", "h1"), batch_id)
        finally:
            new.unpersist()

    def flush(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("reason", rejection()).persist(StorageLevel.DISK_ONLY)
        try:
            kinds = batch.select(F.when(F.col("reason").isNull(), F.col("path")).alias("path")).distinct()
            there = {r.path for r in kinds.collect()}  # the known paths and NULL at most
            good = batch.where(F.col("reason").isNull())
            for table, path in TABLES.items():
                if path in there:
                    save(flatten(good, table, ("ts",)), table, batch_id)
            if None in there:
                save(batch.where(F.col("reason").isNotNull()).select("path", "payload", "ts", "reason"), "rejected", batch_id)
        finally:
            batch.unpersist()

    writer = envelopes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush)
    return _trigger(writer, available_now, every).start()


def read_live_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a record kind, or of ``rejected``; a filter on ``day`` skips files."""
    return _live(spark, root, table).read()


def compact_live_tables(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, keep_seconds: float = DAY_MS / 1000) -> dict[str, int]:
    """Put the small files of each day together, also while the stream writes; how many files less by table.

    Files that are no longer live go after ``keep_seconds``, when no reader is at them any more.
    """
    fewer = {}
    for table in [*TABLES, "rejected"]:
        live = _live(spark, root, table)
        fewer[table] = live.compact(target_bytes)
        live.vacuum(keep_seconds)
        seen = _seen(spark, root, table)
        seen.compact(target_bytes)
        seen.vacuum(keep_seconds)
    return fewer


def append_compacted_sessions(
    session_events: DataFrame, table: str, checkpoint: str, every: str = FLUSH, available_now: bool = False
) -> StreamingQuery:
    """Append each micro-batch's compacted session events to a table; ``fold_sessions`` of it is the state.

    The high-volume form of the session stream: aggregations only, no per-session state.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        compact_session_events(batch).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = session_events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush)
    return _trigger(writer, available_now, every).start()


def drain_stream(
    spark: SparkSession,
    folder: str,
    deliver: Callable[[DataFrame], DataFrame],
    remaining: str,
    checkpoint: str,
    settings: Settings = Settings(),
    every: str = FLUSH,
    available_now: bool = False,
    **options: str,
) -> StreamingQuery:
    """Replay a folder of envelope files in the order of their names, which is their age.

    ``deliver`` takes the envelopes of a micro-batch and returns their attempts (envelope_id,
    attempt, http_status, at_ms, path). What is neither accepted nor refused for good goes to the
    ``remaining`` spool. Session envelopes are never replayed. Files leave the folder when the
    micro-batch after theirs is planned (see :class:`~beaconry.sources.spool.EnvelopeStream`, also for ``options``).
    A restart replays nothing that is done; a micro-batch that was cut short comes again with the same files.
    """

    def replay(batch: DataFrame, batch_id: int) -> None:
        spool = batch.where(~non_persistable(F.col("path"))).withColumn("envelope_id", F.col("file_name"))
        spool = spool.persist(StorageLevel.DISK_ONLY)
        try:
            left = replay_remaining(spool, deliver(spool))
            write_envelopes(left, f"{remaining}/batch={batch_id}", settings, mode="overwrite")
        finally:
            spool.unpersist()

    source = stream_envelopes(spark, folder, **options)
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(replay)
    return _trigger(writer, available_now, every).start()
