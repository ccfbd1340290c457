"""What micro-batches hand on: unfinished batches of a queue, and the newest rows that bounded buffers keep.

State is a table of live files (:class:`~beaconry.streaming.tables.ManifestTable`) that each micro-batch replaces, so
the work is joins, windows and aggregations of whole DataFrames, hot queues are spread as in the batch form, and a
repeated micro-batch leaves everything as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from beaconry.functions.clock import DAY_MS
from beaconry.operators.batching import DB_BATCH, DB_EVERY_MS, MAX_BATCH, merge_db_rows, merge_envelopes, single_envelopes, with_window
from beaconry.operators.retention import MAX_BYTES, MAX_ENTRIES, cap_bytes, cap_entries
from beaconry.operators.sampling import MAX_AGE_MS, drop_expired
from beaconry.operators.skew import WIDTH, newest, numbered
from beaconry.schemas import ROW_ARRAYS
from beaconry.streaming.sinks import FLUSH, _trigger
from beaconry.streaming.tables import ManifestTable


def _with(schema: T.StructType, *ddl: str) -> T.StructType:
    return T.StructType([*schema.fields, *[f for d in ddl for f in T.StructType.fromDDL(d).fields]])


def _only(schema: T.StructType, names: Sequence[str], *ddl: str) -> T.StructType:
    return _with(T.StructType([schema[n] for n in names]), *ddl)


class _Queues:
    """Rows that wait for their batch to fill, and how many batches each queue has sent."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], most: int):
        self.keys, self.order, self.most = list(keys), list(order), most
        self.waiting = ManifestTable(spark, f"{root}/waiting", schema)
        self.sent = ManifestTable(spark, f"{root}/sent", _only(schema, keys, "_sent BIGINT"))

    def place(self, rows: DataFrame, width: int) -> DataFrame:
        """Waiting and new rows with the number of their batch, how many rows it has, and their place in the queue."""
        every = self.waiting.read().unionByName(rows.select(*self.waiting.schema.names))
        placed = numbered(every, self.keys, self.order, "_place", width)
        sizes = placed.groupBy(*self.keys).agg(F.max("_place").alias("_rows"))
        base = {k: f"_{k}_of" for k in self.keys}
        known = sizes.withColumnsRenamed(base).join(
            self.sent.read().withColumnsRenamed({k: f"{base[k]}_then" for k in self.keys}),
            _same([(base[k], f"{base[k]}_then") for k in self.keys]), "left",
        ).select(*base.values(), "_rows", F.coalesce("_sent", F.lit(0).cast("long")).alias("_base"))
        joined = placed.join(known, _same([(k, base[k]) for k in self.keys])).drop(*base.values())
        number = F.floor((F.col("_place") - 1) / self.most)
        return joined.withColumns({
            "batch": F.col("_base") + number, "_fill": F.least(F.lit(self.most), F.col("_rows") - number * self.most).cast("long"),
        })

    def hand_on(self, placed: DataFrame, goes: Column, batch_id: int, counted: Column | None = None) -> None:
        """Keep what does not go, and count the batches that do, of the keys that are still ``counted``."""
        later = placed.where(goes).groupBy(*self.keys).agg((F.max("batch") + 1).alias("_sent"))
        counts = self.sent.read().unionByName(later).groupBy(*self.keys).agg(F.max("_sent").alias("_sent"))
        counts = counts if counted is None else counts.where(counted)
        self.sent.replace(counts, batch_id)
        self.waiting.replace(placed.where(~goes), batch_id)


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    on = F.lit(True)
    for a, b in pairs:
        on = on & F.col(a).eqNullSafe(F.col(b))
    return on


def stream_batches(
    rows: DataFrame, root: str, checkpoint: str, queue_key: Sequence[str] = ("queue_key",), order: Sequence[str] = ("seq",),
    max_batch: int = MAX_BATCH, wait_ms: int | None = None, width: int = WIDTH, every: str = FLUSH, available_now: bool = False,
) -> StreamingQuery:
    """The batches of :func:`~beaconry.operators.batching.pack_batches` over a stream, whatever its micro-batches are.

    A batch goes to the table :func:`sent_batches` reads when it is full; with ``wait_ms`` also when the micro-batch
    is that much later than the one that brought its first row. What is left waits; :func:`flush_batches` sends it
    when the stream is over. Rows come in the ``order`` of their queue; one that comes later than its batch
    is in the next.
    """
    keys = [*queue_key, "path"]
    names = [*keys, *order, "payload"]
    schema = _only(rows.schema, list(dict.fromkeys(names)), "_since TIMESTAMP")

    def flush(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        queues = _Queues(spark, root, schema, keys, order, max_batch)
        if queues.waiting.snapshot().has(batch_id):
            return
        merged = F.col("path").isin(list(ROW_ARRAYS))
        placed = queues.place(batch.where(merged), width)
        goes = F.col("_fill") == max_batch
        if wait_ms is not None:
            oldest = F.min("_since").over(Window.partitionBy(*keys, "batch"))
            placed = placed.withColumn("_old", F.unix_millis(F.lit(batch.agg(F.max("_since")).first()[0])) - F.unix_millis(oldest))
            goes = goes | F.coalesce(F.col("_old") >= wait_ms, F.lit(False))
        placed = placed.persist(StorageLevel.DISK_ONLY)
        try:
            out = merge_envelopes(placed.where(goes), keys, F.col("batch")).unionByName(single_envelopes(batch, keys, order))
            _sent(spark, root, out.schema).add(out, batch_id)
            queues.hand_on(placed, goes, batch_id)
        finally:
            placed.unpersist()

    timed = rows.withColumn("_since", F.current_timestamp()).select(*schema.names)
    return _trigger(timed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush), available_now, every).start()


def _sent(spark: SparkSession, root: str, schema: T.StructType) -> ManifestTable:
    return ManifestTable(spark, f"{root}/batches", T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))


def sent_batches(spark: SparkSession, root: str, queue_key: str = "queue_key STRING") -> DataFrame:
    """The batches that :func:`stream_batches` has sent so far."""
    return ManifestTable(spark, f"{root}/batches", f"{queue_key}, path STRING, batch BIGINT, envelopes BIGINT, rows INT, payload STRING").read()


def sent_db_batches(spark: SparkSession, root: str, queue_key: str = "queue_key STRING") -> DataFrame:
    """The batches that :func:`stream_db_batches` has sent so far."""
    return ManifestTable(spark, f"{root}/batches", f"{queue_key}, window_ms BIGINT, flush BIGINT, rows BIGINT, path STRING, payload STRING").read()


def flush_batches(
    spark: SparkSession, root: str, schema: T.StructType, queue_key: Sequence[str] = ("queue_key",),
    order: Sequence[str] = ("seq",), max_batch: int = MAX_BATCH, width: int = WIDTH,
) -> None:
    """Send what still waits, as after the last flush of a queue; no stream may be at work. ``schema``: of its rows."""
    keys = [*queue_key, "path"]
    names = list(dict.fromkeys([*keys, *order, "payload"]))
    queues = _Queues(spark, root, _only(schema, names, "_since TIMESTAMP"), keys, order, max_batch)
    nothing = spark.createDataFrame([], queues.waiting.schema)
    placed = queues.place(nothing, width)
    out = merge_envelopes(placed, keys, F.col("batch"))
    table = _sent(spark, root, out.schema)
    last = max([table.snapshot().through, *table.snapshot().batches, -1]) + 1
    table.add(out, last)
    queues.hand_on(placed, F.lit(True), last)


def stream_db_batches(
    rows: DataFrame, root: str, checkpoint: str, queue_key: Sequence[str] = ("queue_key",), order: Sequence[str] = ("timestamp_millis",),
    n: int = DB_BATCH, every_ms: int = DB_EVERY_MS, late_ms: int = DAY_MS, width: int = WIDTH, every: str = FLUSH, available_now: bool = False,
) -> StreamingQuery:
    """The batches of :func:`~beaconry.operators.batching.pack_db_batches` over a stream of query rows in time order.

    A batch goes when it has ``n`` rows, or when a row of any queue is later than the end of its timer window. The
    batches of a window are counted for ``late_ms``; a row that is later still begins at flush 0 again.
    :func:`sent_db_batches` reads them.
    """
    if every_ms <= 0:
        n, every_ms = 1, 1
    keys = [*queue_key, "window_ms"]
    windowed = with_window(rows, every_ms)
    schema = _only(windowed.schema, list(dict.fromkeys([*keys, *order, "_json"])))

    def flush(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        queues = _Queues(spark, root, schema, keys, order, n)
        if queues.waiting.snapshot().has(batch_id):
            return
        clock = ManifestTable(spark, f"{root}/clock", "at_ms BIGINT")
        latest = clock.read().unionByName(batch.select(F.col("window_ms").cast("bigint").alias("at_ms"))).agg(F.max("at_ms").alias("at_ms"))
        now = latest.first()[0]
        clock.replace(latest, batch_id)
        placed = queues.place(batch, width).persist(StorageLevel.DISK_ONLY)
        goes = (F.col("_fill") == n) | F.coalesce(F.lit(now) > F.col("window_ms"), F.lit(False))
        try:
            out = merge_db_rows(placed.where(goes), keys, F.col("batch"))
            _sent(spark, root, out.schema).add(out, batch_id)
            queues.hand_on(placed, goes, batch_id, F.coalesce(F.col("window_ms") >= F.lit(now) - late_ms, F.lit(True)))
        finally:
            placed.unpersist()

    return _trigger(windowed.select(*schema.names).writeStream.option("checkpointLocation", checkpoint).foreachBatch(flush), available_now, every).start()


def keep_newest(
    rows: DataFrame, root: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], n: int,
    every: str = FLUSH, available_now: bool = False,
) -> StreamingQuery:
    """The newest ``n`` rows per key of a whole stream, kept up by every micro-batch; :func:`kept` reads them."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        table = ManifestTable(batch.sparkSession, f"{root}/kept", rows.schema)
        table.replace(newest(table.read().unionByName(batch), keys, order, n), batch_id)

    return _trigger(rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge), available_now, every).start()


def keep_spool(
    envelopes: DataFrame, root: str, checkpoint: str, spool: Sequence[str], now_ms: int, max_age_ms: int = MAX_AGE_MS,
    max_entries: int = MAX_ENTRIES, max_bytes: int = MAX_BYTES, every: str = FLUSH, available_now: bool = False,
) -> StreamingQuery:
    """:func:`~beaconry.operators.retention.compact_spool` of a whole stream, kept up by every micro-batch.

    Envelopes may come in any order of their names. What the byte cap has dropped stays dropped, and so does what is
    older: the newest such name of each spool is kept beside the envelopes, or an old small one could slip in later.
    """
    keys = list(spool)

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = ManifestTable(spark, f"{root}/kept", envelopes.schema)
        floors = ManifestTable(spark, f"{root}/floors", _only(envelopes.schema, keys, "_floor STRING"))
        names = {k: f"_{k}_of" for k in keys}
        floor = floors.read().withColumnsRenamed(names)
        every_one = drop_expired(table.read().unionByName(batch), now_ms, max_age_ms).join(floor, _same([(k, names[k]) for k in keys]), "left")
        above = every_one.where(F.col("_floor").isNull() | (F.col("file_name") > F.col("_floor"))).select(*batch.columns)
        some = cap_entries(above, keys, max_entries).persist(StorageLevel.DISK_ONLY)
        try:
            rest = cap_bytes(some, keys, max_bytes)
            least = rest.groupBy(*keys).agg(F.min("file_name").alias("_least")).withColumnsRenamed(names)
            gone = some.join(least, _same([(k, names[k]) for k in keys]), "left").where(F.col("_least").isNull() | (F.col("file_name") < F.col("_least")))
            edge = gone.groupBy(*keys).agg(F.max("file_name").alias("_floor"))
            floors.replace(floors.read().unionByName(edge).groupBy(*keys).agg(F.max("_floor").alias("_floor")), batch_id)
            table.replace(rest, batch_id)
        finally:
            some.unpersist()

    return _trigger(envelopes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge), available_now, every).start()


def kept(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """What :func:`keep_newest` or :func:`keep_spool` holds now."""
    return ManifestTable(spark, f"{root}/kept", schema).read()
