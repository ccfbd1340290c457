"""Statistics kept by day as mergeable sketches: any range of days is answered from its days' rows alone.

Counts, sums and extremes are exact. Percentiles come from KLL sketches, distinct users from HyperLogLog sketches;
both are binary columns of bounded size, so the tables can be stored, replaced day by day, and merged in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions import sqltext
from beaconry.functions.clock import DAY_MS

# Size of the percentile sketches: ranks are off by at most 1.7 % of the rows in 99 of 100 cases.
KLL_K = 200
# Size of the user sketches: 2^12 registers, a standard error of 1.6 %.
LG_K = 12

STATEMENT = ["normalized_query", "query_type", "database_type"]
ROUTE = ["service", "method", "path"]


def _day(at_ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(at_ms / DAY_MS).cast("int")).alias("day")


def daily_statements(db_queries: DataFrame) -> DataFrame:
    """One row per day of ``timestamp_millis`` and statement. Durations without a value are in no percentile."""
    return db_queries.groupBy(_day(F.col("timestamp_millis")), *STATEMENT).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == "error").alias("errors"),
        F.sum(F.greatest("rows_affected", F.lit(0))).alias("rows_affected"), F.min("timestamp_millis").alias("first_seen"),
        F.max("timestamp_millis").alias("last_seen"), F.max("duration_ms").alias("max_ms"), F.sum("duration_ms").alias("total_ms"),
        F.kll_sketch_agg_bigint("duration_ms", F.lit(KLL_K)).alias("durations"),
    )


def _quantiles(merged: DataFrame, shares: dict[str, float]) -> DataFrame:
    some = F.kll_sketch_get_n_bigint("durations") > 0
    return merged.withColumns({
        name: F.when(some, F.kll_sketch_get_quantile_bigint(F.col("durations"), F.lit(share))) for name, share in shares.items()
    }).drop("durations")


def merge_statements(daily: DataFrame, by: Sequence[str] = STATEMENT) -> DataFrame:
    """The rows of some days of :func:`daily_statements` as one row per statement (or other columns ``by``)."""
    merged = daily.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("calls", "errors", "rows_affected", "total_ms")], F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"), F.max("max_ms").alias("max_ms"), F.kll_merge_agg_bigint("durations", F.lit(KLL_K)).alias("durations"),
    )
    out = _quantiles(merged, {"p50_ms": 0.5, "p95_ms": 0.95})
    return out.withColumn("query_hash", sqltext.text_hash(F.col("normalized_query"))) if "normalized_query" in by else out


def daily_routes(http: DataFrame) -> DataFrame:
    """One row per day of ``timestamp`` and route of request rows."""
    return http.groupBy(_day(F.unix_millis("timestamp")), *ROUTE).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 500).alias("errors"), F.max("duration_ms").alias("max_ms"),
        F.kll_sketch_agg_bigint("duration_ms", F.lit(KLL_K)).alias("durations"),
    )


def merge_routes(daily: DataFrame, by: Sequence[str] = ROUTE) -> DataFrame:
    """The rows of some days of :func:`daily_routes` as one row per route."""
    merged = daily.groupBy(*by).agg(
        F.sum("requests").alias("requests"), F.sum("errors").alias("errors"), F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_bigint("durations", F.lit(KLL_K)).alias("durations"),
    )
    return _quantiles(merged.withColumn("error_rate", F.col("errors") / F.col("requests")), {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99})


def daily_sessions(sessions: DataFrame, by: Sequence[str] = ("release", "environment")) -> DataFrame:
    """One row per day of ``started_ms`` and group of folded sessions, with sketches of all users and of those with a crash."""
    crashed = F.coalesce(F.col("ended") & (F.col("status") == "crashed"), F.lit(False))
    return sessions.groupBy(_day(F.col("started_ms")), *by).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if(crashed).alias("crashed_sessions"),
        F.hll_sketch_agg("user_id", F.lit(LG_K)).alias("users"), F.hll_sketch_agg(F.when(crashed, F.col("user_id")), F.lit(LG_K)).alias("crashed_users"),
    )


def merge_sessions(daily: DataFrame, by: Sequence[str] = ("release", "environment")) -> DataFrame:
    """Crash-free shares of some days of :func:`daily_sessions`; a user of several days counts once."""
    users = {c: F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in ("users", "crashed_users")}
    merged = daily.groupBy(*by).agg(F.sum("sessions").alias("sessions"), F.sum("crashed_sessions").alias("crashed_sessions"), *users.values())
    return merged.withColumns({
        "crash_free_sessions": 1 - F.col("crashed_sessions") / F.col("sessions"),
        "crash_free_users": F.when(F.col("users") > 0, 1 - F.least("crashed_users", "users") / F.col("users")),
    })
