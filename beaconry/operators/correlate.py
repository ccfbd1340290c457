"""Joins of the record tables by trace, span and request."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from beaconry.operators.skew import lookup


def _present(name: str):
    return F.nullif(F.col(name), F.lit(""))


def trace_db_time(spans: DataFrame, db_queries: DataFrame) -> DataFrame:
    """Database calls and time of each server span. Queries are added up before the join."""
    per_span = (
        db_queries.where(_present("trace_id").isNotNull() & _present("span_id").isNotNull())
        .groupBy("trace_id", "span_id")
        .agg(F.count(F.lit(1)).alias("db_calls"), F.sum("duration_ms").alias("db_ms"))
    )
    return lookup(spans, per_span, ["trace_id", "span_id"], ["span_id"], blank=True).withColumns(
        {"db_calls": F.coalesce("db_calls", F.lit(0)), "db_ms": F.coalesce("db_ms", F.lit(0))}
    )


def trace_logs(requests: DataFrame, logs: DataFrame) -> DataFrame:
    """Log lines and their errors and warnings of each request, by request id within its trace."""
    per_request = (
        logs.where(_present("trace_id").isNotNull() & _present("request_id").isNotNull())
        .groupBy("trace_id", "request_id")
        .agg(
            F.count(F.lit(1)).alias("log_lines"),
            F.count_if(F.col("level").isin("error", "fatal")).alias("error_lines"),
            F.count_if(F.col("level") == "warn").alias("warn_lines"),
        )
    )
    return lookup(requests, per_request, ["trace_id", "request_id"], ["span_id", "request_id"], blank=True).withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("log_lines", "error_lines", "warn_lines")}
    )


def link_log_errors(logs: DataFrame, errors: DataFrame, error_id: str = "error_id") -> DataFrame:
    """Logs that carry an error, with the number and the first id of the matching error rows.

    Matching error rows are counted per (trace, class, message) first: a log line stays one row
    however many errors share its key.
    """
    kinds = (
        errors.where(_present("trace_id").isNotNull())
        .groupBy("trace_id", F.col("exception_class").alias("error_type"), F.coalesce("message", F.lit("")).alias("error_message"))
        .agg(F.count(F.lit(1)).alias("matching_errors"), F.min(error_id).alias("first_error_id"))
    )
    carrying = logs.withColumns(
        {
            "error_type": F.try_element_at("metadata", F.lit("error.type")),
            "error_message": F.coalesce(F.try_element_at("metadata", F.lit("error.message")), F.lit("")),
            "trace_id": _present("trace_id"),
        }
    ).where(F.col("error_type").isNotNull())
    return lookup(carrying, kinds, ["trace_id", "error_type", "error_message"]).withColumn(
        "matching_errors", F.coalesce("matching_errors", F.lit(0))
    )


def span_parents(spans: DataFrame) -> DataFrame:
    """Each span with its parent's operation and its role: ``root``, ``child`` or ``orphan``."""
    parents = (
        spans.where(_present("trace_id").isNotNull())
        .groupBy("trace_id", F.col("span_id").alias("_parent"))
        .agg(F.min("operation").alias("parent_operation"), F.min("start_time_millis").alias("parent_start_millis"))
    )
    keyed = spans.withColumn("_parent", _present("parent_span_id"))
    role = (
        F.when(F.col("_parent").isNull(), F.lit("root"))
        .when(F.col("parent_operation").isNull(), F.lit("orphan"))
        .otherwise(F.lit("child"))
    )
    return lookup(keyed, parents, ["trace_id", "_parent"], ["trace_id", "span_id"], blank=True).withColumn("role", role).drop("_parent")


def failed_request_context(requests: DataFrame, errors: DataFrame, failed: bool = True) -> DataFrame:
    """Requests that have (or, with ``failed=False``, do not have) errors of their own."""
    ids = errors.where(_present("request_id").isNotNull()).select("request_id").distinct()
    return requests.join(ids, "request_id", "left_semi" if failed else "left_anti")
