"""Delivery attempts as tables: retry plan, settlement, replay and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions.clock import RETRY_AFTER_CAP_MS, retry_after_ms
from beaconry.functions.text import unit_interval
from beaconry.operators.sampling import non_persistable, retryable

# Backoff.
MAX_RETRIES = 3
BASE_MS = 500
CEILING_MS = 8_000


def accepted(status: Column) -> Column:
    return F.coalesce(status.between(200, 299), F.lit(False))


def plan_retries(attempts: DataFrame, max_retries: int = MAX_RETRIES, now: str = "at_ms") -> DataFrame:
    """Add the wait expected after each failed attempt; NULL where sending stops.

    Jitter comes from a hash of envelope and attempt, so a plan can be recomputed.
    """
    a, status = F.col("attempt"), F.col("http_status")
    asked = F.when(status.isin(429, 503), retry_after_ms(F.col("retry_after"), F.col(now))).otherwise(0)
    base = F.least(F.lit(CEILING_MS), F.lit(BASE_MS) * F.pow(F.lit(2), a)).cast("bigint")
    jitter = F.floor(unit_interval(F.col("envelope_id"), F.lit(":"), a.cast("string")) * (base / 4))
    stops = accepted(status) | (a >= max_retries) | ~retryable(status)
    wait = F.when(asked > 0, F.least(asked, F.lit(RETRY_AFTER_CAP_MS))).otherwise(base + jitter)
    return attempts.withColumn("wait_ms", F.when(~stops, wait).cast("bigint"))


def last_attempts(attempts: DataFrame) -> DataFrame:
    """The final attempt of each envelope."""
    last = F.max(F.struct("attempt", "at_ms", F.coalesce("http_status", F.lit(-1)).alias("code"), *_optional(attempts)))
    return (
        attempts.groupBy("envelope_id")
        .agg(last.alias("l"), F.max("path").alias("path"))
        .select(
            "envelope_id", "path", F.col("l.attempt").alias("attempt"),
            F.when(F.col("l.code") >= 0, F.col("l.code")).alias("http_status"),
            *[F.col(f"l.{c}").alias(c) for c in _optional(attempts)],
        )
    )


def _optional(attempts: DataFrame) -> list[str]:
    return [c for c in ("saturated",) if c in attempts.columns]


def settle(attempts: DataFrame, spooling: bool = True) -> DataFrame:
    """Outcome of each envelope after its last attempt: ``delivered``, ``spooled`` or ``dropped``.

    Saturated envelopes (optional boolean column) were never sent: spooled if possible, else dropped.
    """
    last = last_attempts(attempts)
    status = F.col("http_status")
    stored = F.lit(spooling) & ~non_persistable(F.col("path"))
    saturated = F.coalesce(F.col("saturated"), F.lit(False)) if "saturated" in last.columns else F.lit(False)
    outcome = (
        F.when(~saturated & accepted(status), F.lit("delivered"))
        .when(stored & (saturated | retryable(status)), F.lit("spooled"))
        .otherwise(F.lit("dropped"))
    )
    return last.withColumn("outcome", outcome)


def settled_tables(attempts: DataFrame, spooling: bool = True) -> dict[str, DataFrame]:
    out = settle(attempts, spooling)
    return {name: out.where(F.col("outcome") == name) for name in ("delivered", "spooled", "dropped")}


def replay_remaining(spool: DataFrame, attempts: DataFrame) -> DataFrame:
    """Spooled envelopes left after a replay: accepted and permanently refused ones go."""
    last = last_attempts(attempts)
    gone = last.where(accepted(F.col("http_status")) | ~retryable(F.col("http_status")))
    return spool.join(gone.select("envelope_id"), "envelope_id", "left_anti")


def delivery_stats(settled: DataFrame, drops: DataFrame) -> DataFrame:
    """One row of counters. ``dropped`` counts overflow and saturation, not refused envelopes."""
    if "saturated" in settled.columns:
        lost = F.count_if((F.col("outcome") == "dropped") & F.coalesce(F.col("saturated"), F.lit(False)))
    else:
        lost = F.lit(0).cast("bigint")
    none = F.lit(0).cast("bigint")
    sent = settled.agg(lost.alias("dropped"), none.alias("queued"), F.count_if(F.col("outcome") == "spooled").alias("persisted"))
    held = drops.agg(F.sum("dropped").alias("dropped"), F.sum("queued").alias("queued"), none.alias("persisted"))
    return sent.unionByName(held).agg(*[F.coalesce(F.sum(c), none).alias(c) for c in ("dropped", "queued", "persisted")])
