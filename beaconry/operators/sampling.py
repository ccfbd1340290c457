"""Row predicates: sampling, level gate, host exclusion, failure classes, age limit, user hook."""

from __future__ import annotations

import copy
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions.text import unit_interval
from beaconry.schemas import SESSION_PATHS

# Severities of the log levels.
SEVERITY = {"trace": 10, "debug": 20, "info": 30, "warn": 40, "error": 50, "fatal": 60}
# Fixed value: spool age limit.
MAX_AGE_MS = 48 * 60 * 60 * 1000


def clamped_rate(rate: float | None) -> float:
    """Rates outside [0, 1] are clamped; unset and non-finite rates keep everything."""
    if rate is None or not math.isfinite(rate):
        return 1.0
    return min(max(float(rate), 0.0), 1.0)


def keeps(rate: float | None, *parts: Column) -> Column:
    rate = clamped_rate(rate)
    return F.lit(True) if rate >= 1 else unit_interval(*parts) < rate


def sample_traces(df: DataFrame, rate: float | None, trace_id: str = "trace_id", inbound: str | None = None, salt: str = "") -> DataFrame:
    """Keep whole traces: the inbound flag wins, else a hash of the trace id against the rate.

    A random draw per row would split traces; the hash gives one decision per trace in every table.
    """
    own = keeps(rate, F.lit(salt), F.col(trace_id))
    return df.where(F.coalesce(F.col(inbound), own) if inbound else own)


def sample_errors(df: DataFrame, rate: float | None, error_id: str, salt: str = "error:") -> DataFrame:
    """Keep a share of the errors, independently of the trace decision."""
    return df.where(keeps(rate, F.lit(salt), F.col(error_id)))


def severity(level: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv]), level)


def min_level(df: DataFrame, level: str = "info", column: str = "level") -> DataFrame:
    return df.where(severity(F.col(column)) >= SEVERITY[level])


def exclude_ingest_host(df: DataFrame, ingest_host: str, column: str = "host") -> DataFrame:
    """Drop calls to the ingest host itself; an empty host on either side matches nothing."""
    if not ingest_host:
        return df
    return df.where(F.lower(F.coalesce(F.col(column), F.lit(""))) != ingest_host.lower())


def non_persistable(path: Column) -> Column:
    return path.isin(SESSION_PATHS)


def retryable(status: Column) -> Column:
    """No answer, 408, 429 and 5xx are worth another try (and worth keeping); the rest is permanent."""
    return status.isNull() | status.isin(408, 429) | status.between(500, 599)


def classify_failure(df: DataFrame, status: str = "http_status") -> DataFrame:
    s = F.col(status)
    ok = F.coalesce(s.between(200, 299), F.lit(False))
    return df.withColumn(
        "failure", F.when(~ok, F.when(retryable(s), F.lit("retryable")).otherwise(F.lit("permanent")))
    )


def drop_expired(df: DataFrame, now_ms: int | Column, max_age_ms: int = MAX_AGE_MS, ts: str = "ts") -> DataFrame:
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    return df.where(F.col(ts) >= now - F.lit(max_age_ms))


def before_send(df: DataFrame, hook: Callable[[dict], dict | None]) -> DataFrame:
    """User hook over envelopes, as Arrow batches. None drops the row; an exception, or a result that
    does not have the row's types, keeps the original.

    Hooks that can be written with column functions belong in ``df.transform`` instead.
    """

    def fits(row: dict, schema: pa.Schema) -> bool:
        try:
            pa.RecordBatch.from_pylist([row], schema=schema)
        except Exception:
            return False
        return True

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, made = [], []
            for row in batch.to_pylist():
                try:
                    # The hook may change what it gets, also deep inside; a failed one leaves the row as it was.
                    out = hook(copy.deepcopy(row))
                except Exception:
                    out = row
                if out is not None:
                    given.append(row)
                    made.append(out)
            try:
                whole = pa.RecordBatch.from_pylist(made, schema=batch.schema)
            except Exception:
                # Some result has other types: row by row, to find which.
                kept = [out if fits(out, batch.schema) else row for row, out in zip(given, made, strict=True)]
                whole = pa.RecordBatch.from_pylist(kept, schema=batch.schema)
            yield whole

    return df.mapInArrow(apply, df.schema)
