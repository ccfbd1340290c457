"""Outbound calls: pairing of call events, request rows and client spans."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from beaconry.functions import trace, url
from beaconry.operators.requests import sdk_tags
from beaconry.operators.sampling import exclude_ingest_host
from beaconry.operators.skew import WIDTH, with_next
from beaconry.settings import Settings

COMPLETIONS = ["headers", "error"]
CALL_FIELDS = ("at_ms", "kind", "origin", "path", "method", "trace_id", "parent_span_id", "request_id", "sampled", "status_code")


def call_context(creates: DataFrame) -> DataFrame:
    """Trace fields of call creations: the caller's, or those of a trace of their own."""
    orphan = F.col("trace_id").isNull()
    key = F.concat_ws(":", "call_key", F.col("at_ms").cast("string"))
    return (
        creates.withColumn("span_id", trace.generated_span_id(key, "call"))
        .withColumn("parent_span_id", F.when(orphan, F.lit("")).otherwise(F.coalesce("parent_span_id", F.lit(""))))
        .withColumn("trace_id", F.coalesce("trace_id", trace.generated_trace_id(F.concat(F.lit("call:"), key))))
        .withColumn("request_id", F.when(orphan, F.col("trace_id")).otherwise(F.coalesce("request_id", "trace_id")))
        .withColumn("sampled", F.coalesce("sampled", F.lit(True)))
    )


def call_target(creates: DataFrame) -> DataFrame:
    """Host, port, path and method of call creations."""
    return creates.withColumn("_origin", url.parse_origin(F.col("origin"))).withColumns(
        {
            "host": F.col("_origin.host"),
            "port": F.col("_origin.port"),
            "path": url.outbound_path(F.col("path")),
            "method": F.upper(F.coalesce(F.nullif(F.col("method"), F.lit("")), F.lit("GET"))),
        }
    ).drop("_origin")


def propagated_headers(creates: DataFrame, headers: str = "headers", settings: Settings = Settings()) -> DataFrame:
    """Headers to add to an outbound call; NULL where the call already carries the header."""
    t, s, r = F.col("trace_id"), F.col("span_id"), F.col("request_id")
    values = {
        "traceparent": trace.traceparent(t, s, F.col("sampled")),
        "baggage": trace.vendor_baggage(t, r, s, settings),
        settings.header("trace-id"): t,
        settings.header("request-id"): r,
    }
    names = ["add_traceparent", "add_baggage", "add_trace_id", "add_request_id"]
    return creates.withColumns(
        {n: F.when(~trace.has_header(F.col(headers), h), v) for n, (h, v) in zip(names, values.items())}
    )


def pair_outbound_calls(
    call_events: DataFrame, ingest_host: str = "", order: tuple[str, ...] = ("at_ms", "seq"), width: int = WIDTH
) -> DataFrame:
    """One row per finished call: a creation and the first completion after it.

    Within a call key a completion belongs to the event right before it if that is a creation: a
    second creation takes the place of an open one, a second completion finds nothing open.
    """
    heard = heard_events(call_events, ingest_host)
    names = list(dict.fromkeys(["call_key", *order, *CALL_FIELDS]))
    following = F.struct(F.col("kind"), F.col("at_ms"), F.col("status_code"))
    events = with_next(heard.select(*names), ["call_key"], list(order), following, "_after", width)
    return finished_calls(events.where((F.col("kind") == "create") & F.col("_after.kind").isin(COMPLETIONS)))


def heard_events(call_events: DataFrame, ingest_host: str) -> DataFrame:
    """Completions, and the creations that emit something; an unsampled or own-host creation leaves an open call open."""
    create, done = F.col("kind") == "create", F.col("kind").isin(COMPLETIONS)
    heard = call_events.where(done | (create & F.coalesce("sampled", F.lit(True))))
    if ingest_host:
        heard = exclude_ingest_host(heard.withColumn("host", url.parse_origin(F.col("origin"))["host"]), ingest_host).drop("host")
    return heard


def finished_calls(creates: DataFrame) -> DataFrame:
    """Finished calls of creations with the struct ``_after``: kind, at_ms and status_code of their completion."""
    failed = F.col("_after.kind") == "error"
    code = F.when(failed, 0).otherwise(F.coalesce("_after.status_code", F.lit(0)))
    return call_target(call_context(creates)).select(
        "call_key", F.col("at_ms").alias("started_ms"), "trace_id", "parent_span_id", "request_id", "span_id",
        "method", "host", "port", "path", F.col("_after.at_ms").alias("ended_ms"), code.cast("int").alias("status_code"),
        F.when(failed | (code >= 500), F.lit("error")).otherwise(F.lit("ok")).alias("status"),
    )


def build_outbound_rows(paired: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Request rows of finished calls."""
    return paired.select(
        "call_key",
        F.lit("outbound").alias("direction"),
        "method",
        F.coalesce(F.nullif(F.col("host"), F.lit("")), F.lit("unknown")).alias("host"),
        "path", "status_code",
        _duration().alias("duration_ms"),
        F.timestamp_millis("started_ms").alias("timestamp"),
        "trace_id", "span_id", "parent_span_id", "request_id",
        F.lit(settings.environment).alias("environment"),
        F.lit(settings.release).alias("release"),
        F.lit(settings.service).alias("service"),
        F.lit("").alias("request_headers"),
        sdk_tags(settings).alias("metadata"),
    )


def build_client_spans(paired: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Client spans of finished calls."""
    return paired.select(
        "trace_id", "span_id", "parent_span_id",
        F.lit("http.client").alias("operation"),
        F.concat(F.col("method"), F.lit(" "), F.col("host"), F.col("path")).alias("description"),
        "status",
        _duration().alias("duration_ms"),
        F.col("started_ms").alias("start_time_millis"),
        (F.col("started_ms") + _duration()).alias("end_time_millis"),
        F.lit(settings.service).alias("service"),
        F.lit(settings.environment).alias("environment"),
        F.lit(settings.release).alias("release"),
        F.create_map(
            F.lit("component"), F.lit(settings.client_component), F.lit("method"), F.col("method"),
            F.lit("statusCode"), F.col("status_code").cast("string"), F.lit("http.host"), F.col("host"),
        ).alias("tags"),
        F.to_json(F.struct("host", "port", "path")).alias("data"),
    )


def _duration():
    return F.greatest(F.round(F.col("ended_ms") - F.col("started_ms")), F.lit(0)).cast("bigint")
