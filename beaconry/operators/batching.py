"""FIFO batches of envelopes and of query rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.operators.skew import WIDTH, numbered
from beaconry.schemas import DB, ROW_ARRAYS, record, wire_struct

# Envelopes per delivery batch, query rows per first-level batch, its timer.
MAX_BATCH = 50
DB_BATCH = 20
DB_EVERY_MS = 5_000


def _raw_rows(payload: str, field: str):
    """The rows of a payload's array, each as JSON text; a payload without the array has none."""
    rows = F.from_json(payload, f"{field} ARRAY<STRING>")[field]
    return F.coalesce(rows, F.array().cast("array<string>"))


def merge_envelopes(placed: DataFrame, keys: Sequence[str], batch: Column) -> DataFrame:
    """One payload of all row arrays per key and ``batch``, in the order of ``_place``; query payloads without rows go."""
    items = F.lit(None).cast("array<string>")
    for path, field in ROW_ARRAYS.items():
        items = F.when(F.col("path") == path, _raw_rows("payload", field)).otherwise(items)
    field = F.lit(None).cast("string")
    for path, name in ROW_ARRAYS.items():
        field = F.when(F.col("path") == path, F.lit(name)).otherwise(field)
    return (
        placed.select(*keys, batch.alias("batch"), "_place", items.alias("_items"))
        .groupBy(*keys, "batch")
        .agg(
            F.count(F.lit(1)).alias("envelopes"),
            F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_items"))), lambda e: e["_items"])).alias("_rows"),
        )
        .where((F.col("path") != DB) | (F.size("_rows") > 0))
        .select(
            *keys, "batch", "envelopes", F.size("_rows").alias("rows"),
            F.concat(F.lit('{"'), field, F.lit('":['), F.array_join("_rows", ","), F.lit("]}")).alias("payload"),
        )
    )


def single_envelopes(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Envelopes of paths without a row array, each a batch of its own."""
    return rows.where(~F.col("path").isin(list(ROW_ARRAYS))).select(
        *keys, F.col(order[0]).cast("bigint").alias("batch"), F.lit(1).cast("bigint").alias("envelopes"), F.lit(1).alias("rows"), "payload"
    )


def pack_batches(
    rows: DataFrame,
    queue_key: Sequence[str] = ("queue_key",),
    order: Sequence[str] = ("seq",),
    max_batch: int = MAX_BATCH,
    width: int = WIDTH,
) -> DataFrame:
    """Merge each run of ``max_batch`` envelopes of a queue and path into one payload, in order.

    Paths without a row array (errors, logs, ...) are passed on one by one, their place in ``order`` as ``batch``. A merged query payload
    without rows is skipped; merged request and span payloads are sent even when empty.
    """
    keys = [*queue_key, "path"]
    place = numbered(rows.where(F.col("path").isin(list(ROW_ARRAYS))), keys, order, "_place", width)
    packed = merge_envelopes(place, keys, F.floor((F.col("_place") - 1) / max_batch))
    return packed.unionByName(single_envelopes(rows, keys, order))


def with_window(rows: DataFrame, every_ms: int) -> DataFrame:
    """Query rows with the start of their timer window and their JSON form."""
    fields = record("db_queries")
    body = F.to_json(wire_struct(type(fields)([f for f in fields.fields if f.name in rows.columns])))
    return rows.withColumn("_json", body).withColumn("window_ms", F.floor(F.col("timestamp_millis") / every_ms) * every_ms)


def merge_db_rows(placed: DataFrame, keys: Sequence[str], batch: Column) -> DataFrame:
    """One query payload per key and ``batch``, rows in the order of ``_place``."""
    return (
        placed.groupBy(*keys, batch.alias("flush"))
        .agg(F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list(F.struct("_place", "_json"))).alias("_list"))
        .select(
            *keys, "flush", "rows", F.lit(DB).alias("path"),
            F.concat(F.lit('{"queries":['), F.array_join(F.transform("_list", lambda e: e["_json"]), ","), F.lit("]}")).alias("payload"),
        )
    )


def pack_db_batches(
    rows: DataFrame,
    queue_key: Sequence[str] = ("queue_key",),
    order: Sequence[str] = ("timestamp_millis",),
    n: int = DB_BATCH,
    every_ms: int = DB_EVERY_MS,
    width: int = WIDTH,
) -> DataFrame:
    """First-level query batches: full at ``n`` rows or at the timer, whichever comes first.

    Timer windows are anchored at the epoch. Without a timer every row is its own batch. The result
    is a table of envelopes for :func:`pack_batches`.
    """
    if every_ms <= 0:
        n, every_ms = 1, 1
    keys = [*queue_key, "window_ms"]
    placed = numbered(with_window(rows, every_ms), keys, order, "_place", width)
    return merge_db_rows(placed, keys, F.floor((F.col("_place") - 1) / n))
