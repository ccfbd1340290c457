"""Record contracts and raw inputs. Columns are snake_case; :func:`wire` gives the JSON names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from beaconry.functions.privacy import camel

# The delivery paths.
HTTP_REQUESTS = "/ingest/v1/http-requests"
ERRORS = "/ingest/v1/errors"
SPANS = "/ingest/v1/spans"
DB = "/ingest/v1/db"
LOGS = "/ingest/v1/logs"
RELEASES = "/ingest/v1/releases"
SESSION_STARTS = "/ingest/v1/sessions/start"
SESSION_ENDS = "/ingest/v1/sessions/end"
PATHS = [HTTP_REQUESTS, ERRORS, SPANS, DB, LOGS, RELEASES, SESSION_STARTS, SESSION_ENDS]
SESSION_PATHS = [SESSION_STARTS, SESSION_ENDS]

# Payload field holding the row array, for the paths that send several rows at once.
ROW_ARRAYS = {HTTP_REQUESTS: "requests", SPANS: "spans", DB: "queries"}

TABLES = {
    "http_requests": HTTP_REQUESTS, "errors": ERRORS, "spans": SPANS, "db_queries": DB, "logs": LOGS,
    "releases": RELEASES, "session_starts": SESSION_STARTS, "session_ends": SESSION_ENDS,
}

_TRACE = "trace_id STRING, span_id STRING"

RECORDS = {
    "http_requests": "direction STRING, method STRING, host STRING, path STRING, status_code INT, duration_ms BIGINT, "
    f"timestamp STRING, {_TRACE}, parent_span_id STRING, request_id STRING, environment STRING, release STRING, "
    "service STRING, user_id STRING, request_headers STRING, metadata MAP<STRING,STRING>",
    "spans": f"{_TRACE}, parent_span_id STRING, operation STRING, description STRING, status STRING, "
    "duration_ms BIGINT, start_time_millis BIGINT, end_time_millis BIGINT, service STRING, environment STRING, "
    "release STRING, tags MAP<STRING,STRING>, data STRING",
    "errors": "exception_class STRING, message STRING, stack_trace ARRAY<STRING>, level STRING, environment STRING, "
    f"release STRING, {_TRACE}, parent_span_id STRING, request_id STRING, sdk_name STRING, sdk_version STRING, "
    "platform STRING, metadata MAP<STRING,STRING>, session_id STRING, user_id STRING, fingerprint ARRAY<STRING>, "
    "breadcrumbs ARRAY<STRUCT<type:STRING,category:STRING,message:STRING,level:STRING,timestamp:STRING,"
    "data:MAP<STRING,STRING>>>",
    "db_queries": "normalized_query STRING, query_hash STRING, query_type STRING, duration_ms BIGINT, "
    "timestamp_millis BIGINT, status STRING, error_message STRING, database_name STRING, database_type STRING, "
    f"service STRING, environment STRING, {_TRACE}, rows_affected BIGINT",
    "logs": f"level STRING, message STRING, service STRING, environment STRING, release STRING, {_TRACE}, "
    "request_id STRING, metadata MAP<STRING,STRING>",
    "releases": "version STRING, environment STRING, author STRING, message STRING",
    "session_starts": "session_id STRING, release STRING, environment STRING, user_id STRING, sdk_name STRING, "
    "sdk_version STRING, platform STRING",
    "session_ends": "session_id STRING, duration_ms BIGINT, status STRING",
}

RAW = {
    "request_starts": "request_key STRING, method STRING, url STRING, hostname STRING, "
    "headers MAP<STRING,ARRAY<STRING>>, user_id STRING, started_ms BIGINT",
    "request_ends": "request_key STRING, status_code INT, ended_ms BIGINT",
    "request_errors": "request_key STRING, error_name STRING, error_message STRING, error_stack STRING, seq BIGINT",
    "raw_queries": "sql STRING, started_ms BIGINT, ended_ms BIGINT, status STRING, error STRING, database STRING, "
    f"database_type STRING, rows BIGINT, orm_owned BOOLEAN, {_TRACE}",
    "raw_logs": "level STRING, arg_kind STRING, arg_text STRING, message STRING, merge_obj MAP<STRING,STRING>, "
    f"error STRUCT<name:STRING,message:STRING,stack:STRING>, {_TRACE}, request_id STRING",
    "call_events": "call_key STRING, kind STRING, origin STRING, path STRING, method STRING, status_code INT, "
    "at_ms BIGINT, trace_id STRING, parent_span_id STRING, request_id STRING, sampled BOOLEAN",
    "session_events": "session_id STRING, seq BIGINT, kind STRING, final_status STRING, at_ms BIGINT, "
    "release STRING, environment STRING, user_id STRING, platform STRING",
    "envelopes": "file_name STRING, path STRING, payload STRING, ts BIGINT, size BIGINT",
    "delivery_attempts": "envelope_id STRING, path STRING, attempt INT, http_status INT, retry_after STRING, "
    "at_ms BIGINT",
    "scopes": "scope_key STRING, depth INT, user STRUCT<id:STRING,email:STRING>, tags MAP<STRING,STRING>, "
    "extras MAP<STRING,STRING>, contexts MAP<STRING,MAP<STRING,STRING>>, fingerprint ARRAY<STRING>, level STRING",
    "breadcrumbs": "scope_key STRING, seq BIGINT, type STRING, category STRING, message STRING, level STRING, "
    "timestamp STRING, data MAP<STRING,STRING>",
}


def record(name: str) -> T.StructType:
    return T.StructType.fromDDL(RECORDS[name])


def raw(name: str) -> T.StructType:
    return T.StructType.fromDDL(RAW[name])


def wire(schema: T.StructType) -> T.StructType:
    """The same schema under the JSON field names."""
    return T.StructType([T.StructField(camel(f.name), f.dataType) for f in schema.fields])


def wire_struct(schema: T.StructType) -> Column:
    """Struct of a record's columns under the JSON field names; NULL fields vanish in ``to_json``."""
    return F.struct(*[F.col(f.name).alias(camel(f.name)) for f in schema.fields])
