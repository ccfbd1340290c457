"""SQL activity: statement fingerprints, query rows and per-fingerprint statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from beaconry.functions import sqltext
from beaconry.functions.text import utf16_prefix
from beaconry.operators.skew import lookup
from beaconry.settings import Settings

# Fixed value: longest error message kept, in UTF-16 units.
MAX_ERROR_UNITS = 500


def fingerprint_sql(df: DataFrame, sql_col: str = "sql") -> DataFrame:
    """Add ``normalized_query``, ``query_hash`` and ``query_type``; no shuffle."""
    sql = F.col(sql_col)
    return (
        df.withColumn("normalized_query", sqltext.normalized_sql(sql))
        .withColumn("query_hash", sqltext.text_hash(F.col("normalized_query")))
        .withColumn("query_type", sqltext.statement_type(F.coalesce(sql, F.lit(""))))
    )


def build_db_rows(
    raw_queries: DataFrame, contexts: DataFrame | None = None, settings: Settings = Settings(), hashed: bool = True
) -> DataFrame:
    """Query rows of the statements no ORM layer reports itself.

    Driver flag ``ignores_orm`` (optional column) marks drivers without the ORM check. ``contexts``
    (one row per ``request_key``) supplies trace and span ids when the raw rows have none. With
    ``hashed=False`` the hash is left out, for callers that group by the text first.
    """
    kept = ~F.coalesce(F.col("orm_owned"), F.lit(False))
    if "ignores_orm" in raw_queries.columns:
        kept = kept | F.coalesce(F.col("ignores_orm"), F.lit(False))
    rows = raw_queries.where(kept)
    if contexts is not None:
        ids = contexts.select("request_key", F.col("trace_id").alias("_t"), F.col("span_id").alias("_s"))
        rows = lookup(rows, ids, ["request_key"], ["started_ms", "sql"]).withColumns({"trace_id": F.col("_t"), "span_id": F.col("_s")})
    sql = F.col("sql")
    text = sqltext.normalized_sql(sql)
    if hashed:
        rows = rows.withColumn("normalized_query", text)
        text = F.col("normalized_query")
    hash_col = [sqltext.text_hash(text).alias("query_hash")] if hashed else []
    return rows.select(
        text.alias("normalized_query"), *hash_col,
        sqltext.statement_type(F.coalesce(sql, F.lit(""))).alias("query_type"),
        (F.col("ended_ms") - F.col("started_ms")).cast("bigint").alias("duration_ms"),
        F.col("started_ms").alias("timestamp_millis"),
        "status",
        utf16_prefix(F.col("error"), MAX_ERROR_UNITS).alias("error_message"),
        F.coalesce("database", F.lit("")).alias("database_name"),
        "database_type",
        F.lit(settings.service).alias("service"),
        F.lit(settings.environment).alias("environment"),
        "trace_id", "span_id",
        F.coalesce("rows", F.lit(-1)).cast("bigint").alias("rows_affected"),
    )


def rows_affected(driver: str, row_count: str = "row_count", affected: str = "affected", length: str = "length"):
    """Row count each driver family reports: pg its count, mysql affected else length, sqlite changes else length."""
    first = F.col(row_count) if driver == "postgresql" else F.coalesce(F.col(affected), F.col(length))
    return F.coalesce(first, F.lit(-1)).cast("bigint")


def query_fingerprint_stats(db_queries: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Calls, errors, duration percentiles, rows and first/last seen per statement.

    Percentiles are exact: counts per (statement, duration) come first, so that a hot statement reaches its final
    task as one row per distinct millisecond value. With ``accuracy`` they are durations whose rank is off by at
    most calls / accuracy, from sketches of bounded size, in one aggregation. The hash is taken once per
    statement; the text is part of the key, since the hash has only 32 bits.
    """
    keys = ["normalized_query", "query_type", "database_type"]
    sums = [
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.sum(F.greatest("rows_affected", F.lit(0))).alias("rows_affected"),
        F.min("timestamp_millis").alias("first_seen"),
        F.max("timestamp_millis").alias("last_seen"),
    ]
    if accuracy:
        p = F.percentile_approx("duration_ms", [0.5, 0.95], accuracy).cast("array<double>")
        longest, total = F.max("duration_ms"), F.sum("duration_ms")
        stats = db_queries.groupBy(*keys).agg(*sums, p.alias("p"), longest.alias("max_ms"), total.alias("total_ms"))
    else:
        counted = db_queries.groupBy(*keys, "duration_ms").agg(*sums)
        stats = counted.groupBy(*keys).agg(
            F.percentile("duration_ms", [0.5, 0.95], F.col("calls")).alias("p"),
            F.max("duration_ms").alias("max_ms"),
            F.sum(F.col("duration_ms") * F.col("calls")).alias("total_ms"),
            *[F.sum(c).alias(c) for c in ("calls", "errors", "rows_affected")],
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
    return stats.select(
        sqltext.text_hash(F.col("normalized_query")).alias("query_hash"), *keys, "calls", "errors",
        F.get("p", F.lit(0)).alias("p50_ms"), F.get("p", F.lit(1)).alias("p95_ms"), "max_ms", "total_ms",
        "rows_affected", "first_seen", "last_seen",
    )
