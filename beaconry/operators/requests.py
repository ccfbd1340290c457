"""Inbound requests: trace context, propagation audit, request rows and server spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions import trace, url
from beaconry.functions.maps import empty_map, overlay, prefixed
from beaconry.functions.privacy import Extras, redact_typed
from beaconry.operators.redact import headers_to_string
from beaconry.operators.sampling import keeps
from beaconry.operators.skew import lookup
from beaconry.settings import Settings


def resolve_trace_context(starts: DataFrame, settings: Settings = Settings(), rate: float | None = None) -> DataFrame:
    """Add trace, request, span and parent ids and the sampling decision to request starts."""
    h = F.col("headers")
    key = F.col("request_key")
    given = lambda name: F.nullif(trace.header_value(h, name), F.lit(""))
    parent = F.col("_traceparent")
    return (
        starts.withColumn("_traceparent", trace.parse_traceparent(trace.header_value(h, "traceparent")))
        .withColumn(
            "trace_id",
            F.coalesce(given(settings.header("trace-id")), parent["trace_id"], trace.generated_trace_id(key)),
        )
        .withColumn("request_id", F.coalesce(given(settings.header("request-id")), given("x-request-id"), F.col("trace_id")))
        .withColumn("span_id", trace.generated_span_id(key))
        .withColumn(
            "parent_span_id",
            F.coalesce(given(settings.header("parent-span-id")), parent["span_id"], F.lit("")),
        )
        .withColumn("sampled", F.coalesce(parent["sampled"], keeps(rate, F.col("trace_id"))))
        .drop("_traceparent")
    )


def expected_headers(ctx: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The five correlation headers a response should carry, as columns."""
    key = F.col("request_key")
    t, s, r = F.col("trace_id"), F.col("span_id"), F.col("request_id")
    own = trace.vendor_baggage(t, r, s, settings)
    return ctx.withColumns(
        {
            "expected_traceparent": trace.traceparent(
                trace.repaired(t, 32, trace.generated_trace_id(key)),
                trace.repaired(s, 16, trace.generated_span_id(key)),
                F.col("sampled"),
            ),
            "expected_baggage": trace.merged_baggage(trace.header_value(F.col("headers"), "baggage"), own, settings),
            "expected_vendor_baggage": own,
            "expected_trace_id": t,
            "expected_request_id": r,
        }
    )


def audit_propagation(ctx: DataFrame, recorded: str = "recorded_headers", settings: Settings = Settings()) -> DataFrame:
    """Expected response headers next to the recorded ones, with a mismatch flag."""
    out = expected_headers(ctx, settings)
    pairs = {
        "expected_traceparent": "traceparent",
        "expected_baggage": "baggage",
        "expected_vendor_baggage": settings.baggage_header,
        "expected_trace_id": settings.header("trace-id"),
        "expected_request_id": settings.header("request-id"),
    }
    differs = F.lit(False)
    for column, header in pairs.items():
        differs = differs | ~F.col(column).eqNullSafe(F.try_element_at(F.col(recorded), F.lit(header)))
    return out.withColumn("mismatch", differs)


def scope_metadata(user: Column, tags: Column, extras: Column, contexts: Column) -> Column:
    """Flat metadata of a merged scope; contexts become JSON text."""
    empty = empty_map()
    ident = F.map_filter(
        F.create_map(F.lit("userId"), user["id"], F.lit("userEmail"), user["email"]), lambda _, v: v.isNotNull()
    )
    ctx = F.transform_values(contexts, lambda _, v: F.to_json(v))
    out = F.coalesce(ident, empty)
    for part, prefix in ((tags, "tag."), (extras, "extra."), (ctx, "context.")):
        out = overlay(out, prefixed(part, prefix))
    return out


def sdk_tags(settings: Settings) -> Column:
    return F.create_map(
        F.lit("sdk.name"), F.lit(settings.sdk_name), F.lit("sdk.version"), F.lit(settings.sdk_version)
    )


def request_row(df: DataFrame, settings: Settings, capture_headers: bool, extra: Extras, scoped: bool) -> DataFrame:
    """Projection of a joined start and end to the request contract (batch and stream)."""
    meta = sdk_tags(settings)
    user_id = F.col("user_id")
    if scoped:
        meta = overlay(meta, scope_metadata(F.col("_user"), F.col("_tags"), F.col("_extras"), F.col("_contexts")))
        user_id = F.coalesce(F.col("_user")["id"], user_id)
    shown, _ = redact_typed(meta, df.select(meta.alias("m")).schema["m"].dataType, settings.vendor, extra)
    started = F.col("started_ms")
    return df.select(
        "request_key",
        F.lit("inbound").alias("direction"),
        F.upper("method").alias("method"),
        url.request_host(F.col("headers"), F.col("hostname")).alias("host"),
        url.inbound_path(F.col("url")).alias("path"),
        "status_code",
        F.greatest(F.col("ended_ms") - started, F.lit(0)).cast("bigint").alias("duration_ms"),
        F.timestamp_millis(started).alias("timestamp"),
        "trace_id", "span_id", "parent_span_id", "request_id",
        F.lit(settings.environment).alias("environment"),
        F.lit(settings.release).alias("release"),
        F.lit(settings.service).alias("service"),
        user_id.alias("user_id"),
        (headers_to_string(F.col("headers"), extra, settings) if capture_headers else F.lit("")).alias("request_headers"),
        shown.alias("metadata"),
    )


def with_scope(df: DataFrame, scopes: DataFrame, key: str, present: bool = False) -> DataFrame:
    """Attach the merged scope (one row per scope key) under underscored names.

    ``present`` says that no key is NULL, as after an inner join on it, whose partitioning is then used again.
    """
    side = scopes.select(
        F.col("scope_key").alias(key),
        *[F.col(c).alias(f"_{c}") for c in scopes.columns if c != "scope_key"],
    )
    return df.join(side, key, "left") if present else lookup(df, side, [key])


def build_http_rows(
    ctx: DataFrame,
    ends: DataFrame,
    scopes: DataFrame | None = None,
    settings: Settings = Settings(),
    capture_headers: bool = False,
    extra: Extras = (),
) -> DataFrame:
    """Request rows of the sampled starts (with context) that have an end."""
    joined = ctx.where("sampled").join(ends, "request_key")
    if scopes is not None:
        joined = with_scope(joined, scopes, "request_key", present=True)
    return request_row(joined, settings, capture_headers, extra, scopes is not None)


def build_server_spans(http: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One server span per request row."""
    start = F.unix_millis("timestamp")
    return http.select(
        "trace_id", "span_id", "parent_span_id",
        F.lit(f"{settings.component}.request").alias("operation"),
        F.concat_ws(" ", "method", "path").alias("description"),
        F.when(F.col("status_code") >= 500, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        "duration_ms",
        start.alias("start_time_millis"),
        (start + F.col("duration_ms")).alias("end_time_millis"),
        "service", "environment", "release",
        F.create_map(
            F.lit("component"), F.lit(settings.component), F.lit("method"), F.col("method"),
            F.lit("statusCode"), F.col("status_code").cast("string"),
        ).alias("tags"),
        F.to_json(F.struct("host", "path")).alias("data"),
    )
