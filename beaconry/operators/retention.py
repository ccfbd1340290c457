"""Bounded buffers: queue caps, spool caps and spool maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.operators.sampling import MAX_AGE_MS, drop_expired
from beaconry.operators.skew import newest, newest_within

# Caps.
MAX_QUEUE = 1000
MAX_ENTRIES = 200
MAX_BYTES = 5 * 1024 * 1024


def cap_queue(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_QUEUE) -> DataFrame:
    """Newest ``max_rows`` rows per producer and queue."""
    return newest(df, keys, order, max_rows)


def queue_drops(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_QUEUE) -> DataFrame:
    """Rows per queue: seen, still queued and dropped."""
    n = F.col("seen")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("seen")).select(
        *keys, "seen", F.least(n, F.lit(max_rows)).alias("queued"), F.greatest(n - max_rows, F.lit(0)).alias("dropped")
    )


def cap_entries(df: DataFrame, spool: Sequence[str], max_entries: int = MAX_ENTRIES) -> DataFrame:
    """Newest envelopes per spool by file name in text order."""
    return newest(df, spool, ["file_name"], max_entries)


def cap_bytes(df: DataFrame, spool: Sequence[str], max_bytes: int = MAX_BYTES) -> DataFrame:
    """Longest newest run of envelopes per spool within the byte limit."""
    return newest_within(df, spool, ["file_name"], F.col("size"), max_bytes)


def compact_spool(
    df: DataFrame,
    spool: Sequence[str],
    now_ms: int | Column,
    max_age_ms: int = MAX_AGE_MS,
    max_entries: int = MAX_ENTRIES,
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Age limit, then entry cap, then byte cap."""
    return cap_bytes(cap_entries(drop_expired(df, now_ms, max_age_ms), spool, max_entries), spool, max_bytes)
