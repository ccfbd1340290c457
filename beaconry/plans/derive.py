"""Raw telemetry inputs derived from the given tables.

Every scalar column is one SQL expression that Spark and DuckDB read alike, so both sides of a check
start from the same rows; ``{ms}`` is the epoch millisecond of the table's time column. Maps and
arrays are put together in Spark only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from beaconry.functions.maps import without_nulls
from beaconry.settings import Settings

SETTINGS = Settings(
    vendor="acme", environment="prod", release="1.4.0", service="shop", platform="node-linux",
    sdk_name="acme-sdk", sdk_version="2.1.0", component="web",
)
RATE = 0.5
NOW_MS = 1706745600000  # 2024-02-01T00:00:00Z, just after the events

TIME_COLUMN = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}

K = "CAST(event_id AS STRING)"
U = "CAST(user_id AS STRING)"

# table, {column: expression}, filter
INPUTS: dict[str, tuple[str, dict[str, str], str | None]] = {
    "request_starts": (
        "events",
        {
            "request_key": K,
            "method": "CASE event_type WHEN 'view' THEN 'get' WHEN 'click' THEN 'Post' ELSE 'PUT' END",
            "url": "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN '?x=1' ELSE "
            f"'/' || event_type || '/' || {U} || CASE event_id % 4 WHEN 0 THEN '?k=' || {K} "
            "WHEN 1 THEN '/items/' || CAST(event_id % 10 AS STRING) ELSE '' END END",
            "hostname": f"CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'svc-' || CAST(user_id % 5 AS STRING) END",
            "user_id": f"CASE WHEN event_id % 5 = 0 THEN NULL ELSE {U} END",
            "started_ms": "{ms}",
            "h_host": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'api-' || CAST(user_id % 3 AS STRING) || '.example.test' END",
            "h_traceparent": "CASE event_id % 6 WHEN 0 THEN NULL "
            f"WHEN 1 THEN '00-' || md5('t' || {K}) || '-' || substr(md5('p' || {K}), 1, 16) || '-01' "
            f"WHEN 2 THEN '00-' || md5('t' || {K}) || '-' || substr(md5('p' || {K}), 1, 16) || '-00' "
            "WHEN 3 THEN '00-abc-def' "
            f"WHEN 4 THEN '00-' || md5('t' || {K}) || '-short-zz' "
            f"ELSE '00-short-' || substr(md5('p' || {K}), 1, 16) || '-03' END",
            "h_trace_id": f"CASE WHEN event_id % 11 = 0 THEN 'vt-' || {K} ELSE NULL END",
            "h_request_id": f"CASE WHEN event_id % 13 = 0 THEN 'vr-' || {K} ELSE NULL END",
            "h_x_request_id": f"CASE WHEN event_id % 4 = 1 THEN 'xr-' || {K} ELSE NULL END",
            "h_parent": f"CASE WHEN event_id % 17 = 0 THEN 'vp-' || {K} ELSE NULL END",
            "h_baggage": f"CASE WHEN event_id % 2 = 0 THEN 'team=a, Acme-old=1 ,,k=' || {K} ELSE NULL END",
            "h_authorization": f"CASE WHEN event_id % 8 = 0 THEN 'Bearer ' || md5({K}) ELSE NULL END",
        },
        None,
    ),
    "request_ends": (
        "events",
        {
            "request_key": K,
            "status_code": "CAST(CASE WHEN event_type = 'error' THEN 500 + event_id % 4 WHEN event_type = 'signup' THEN 404 "
            "ELSE 200 END AS INT)",
            "ended_ms": "{ms} + CAST(floor(value * 10) AS BIGINT) - 30",
        },
        "event_id % 19 <> 0",
    ),
    "request_errors": (
        "events",
        {
            "request_key": K,
            "error_name": "CASE event_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'TypeError' ELSE 'RangeError' END",
            "error_message": f"'failed for u' || {U} || '@example.com from 10.0.' || CAST(user_id % 256 AS STRING) || '.7'",
            "error_stack": f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'Error: x' || chr(10) || ' at f (/srv/10.1.2.3/a.js:' || {K} || ')' END",
            "seq": "event_id",
        },
        "event_type = 'error'",
    ),
    "raw_queries": (
        "orders",
        {
            "request_key": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END",
            "sql": "CASE o_orderkey % 7 "
            "WHEN 0 THEN 'SELECT * FROM orders WHERE o_orderkey = ' || CAST(o_orderkey AS STRING) || ' AND prio = ''' || o_orderpriority || ''' -- c' || CAST(o_custkey AS STRING) "
            "WHEN 1 THEN 'INSERT INTO t VALUES (' || CAST(o_orderkey AS STRING) || ', ''it''''s ' || o_orderpriority || ''')' "
            "WHEN 2 THEN '  update  customers /* x ' || CAST(o_orderkey AS STRING) || ' */ SET a = ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '.5 WHERE id' || CAST(o_custkey % 4 AS STRING) || ' = ' || CAST(o_custkey AS STRING) "
            "WHEN 3 THEN 'DELETE FROM \"public\".\"Task\" WHERE k = $1 AND d = 1e5' "
            "WHEN 4 THEN 'COMMIT;' "
            "WHEN 5 THEN 'BEGIN' "
            "ELSE 'WITH x AS (SELECT $tag$ body ' || CAST(o_custkey AS STRING) || ' $tag$) SELECT 0xFF, é' || CAST(o_custkey AS STRING) || ' FROM x' END",
            "started_ms": "{ms} + (o_orderkey % 86400) * 1000",
            "ended_ms": "{ms} + (o_orderkey % 86400) * 1000 + CAST(floor(o_totalprice / 1000) AS BIGINT)",
            "status": "CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'success' END",
            "error": "CASE WHEN o_orderstatus = 'F' THEN 'duplicate key ' || repeat('é', CAST(o_orderkey % 700 AS INT)) ELSE NULL END",
            "database": "CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'db' || CAST(o_custkey % 3 AS STRING) END",
            "database_type": "CASE o_orderkey % 3 WHEN 0 THEN 'postgresql' WHEN 1 THEN 'mysql' ELSE 'sqlite' END",
            "rows": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey % 50 END",
            "orm_owned": "o_orderkey % 10 = 0",
        },
        None,
    ),
    "raw_logs": (
        "events",
        {
            "seq": "event_id",
            "request_key": K,
            "level": "CASE event_id % 6 WHEN 0 THEN 'trace' WHEN 1 THEN 'debug' WHEN 2 THEN 'info' WHEN 3 THEN 'warn' WHEN 4 THEN 'error' ELSE 'fatal' END",
            "arg_kind": "CASE (event_id + user_id) % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'object' WHEN 2 THEN 'string' WHEN 3 THEN 'other' ELSE NULL END",
            "arg_text": f"CASE (event_id + user_id) % 5 WHEN 2 THEN 'contact u' || {U} || '@example.com now' WHEN 3 THEN {K} ELSE NULL END",
            "message": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'it was ' || event_type END",
            "m_note": f"CASE WHEN event_id % 2 = 0 THEN 'ip 10.2.3.' || CAST(user_id % 256 AS STRING) ELSE 'plain' END",
            "m_err": "CASE WHEN event_id % 7 = 0 THEN 'not an error' ELSE NULL END",
            "error_name": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'TypeError' END",
            "error_message": f"'boom ' || {U} || ' at u' || {U} || '@example.com'",
            "error_stack": f"CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'TypeError: boom' || chr(10) || ' at h (10.9.8.7:' || {K} || ')' END",
            "error_key": "CASE WHEN event_id % 2 = 0 THEN 'err' ELSE 'error' END",
            "has_error": "(event_id + user_id) % 5 = 0 OR event_id % 3 = 1",
        },
        None,
    ),
    "session_events": (
        "events",
        {
            "session_id": f"{U} || '-' || CAST(CAST(floor({{ms}} / 86400000) AS BIGINT) AS STRING)",
            "seq": "event_id",
            "kind": "CASE event_type WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'start' WHEN 'signup' THEN 'end' "
            "WHEN 'error' THEN CASE WHEN value > 100 THEN 'crash' ELSE 'error' END "
            "ELSE CASE WHEN value > 60 THEN 'abnormal' ELSE 'error' END END",
            "final_status": "CASE WHEN event_type = 'signup' AND event_id % 12 = 0 THEN 'ok' ELSE NULL END",
            "at_ms": "{ms}",
            "release": "CASE WHEN event_id % 23 = 0 THEN '' ELSE 'v' || CAST(user_id % 4 AS STRING) END",
            "environment": "CASE WHEN user_id % 2 = 0 THEN 'prod' ELSE 'staging' END",
            "user_id": f"CASE WHEN user_id % 9 = 0 THEN NULL ELSE 'u' || CAST(user_id % 40 AS STRING) END",
            "platform": "'node-linux'",
        },
        None,
    ),
    "delivery_attempts": (
        "lineitem",
        {
            "envelope_id": "'env-' || CAST(l_orderkey AS STRING)",
            "path": "CASE l_orderkey % 5 WHEN 0 THEN '/ingest/v1/sessions/end' WHEN 1 THEN '/ingest/v1/errors' ELSE '/ingest/v1/spans' END",
            "attempt": "CAST(l_linenumber - 1 AS INT)",
            "http_status": "CAST(CASE WHEN l_quantity < 10 THEN 200 WHEN l_quantity < 18 THEN 503 WHEN l_quantity < 25 THEN 429 WHEN l_quantity < 30 THEN 400 "
            "WHEN l_quantity < 35 THEN NULL WHEN l_quantity < 40 THEN 408 ELSE 500 END AS INT)",
            "retry_after": "CASE l_partkey % 6 WHEN 0 THEN ' 2 ' WHEN 1 THEN NULL WHEN 2 THEN 'soon' "
            "WHEN 3 THEN 'Tue, 04 Apr 2000 0' || CAST(l_suppkey % 10 AS STRING) || ':30:15 GMT' WHEN 4 THEN '999' ELSE '2000-04-04T05:31:00Z' END",
            "at_ms": "954806400000 + (l_orderkey % 36000) * 1000",
            "saturated": "l_orderkey % 29 = 0",
        },
        None,
    ),
    "envelopes": (
        "events",
        {
            "envelope_id": "'env-' || " + K,
            "spool": "'spool-' || CAST(user_id % 4 AS STRING)",
            "seq": "event_id",
            "file_name": "CAST({ms} AS STRING) || '-' || substr(md5(" + K + "), 1, 6) || '.json'",
            "ts": "{ms}",
            "path": "CASE event_id % 10 WHEN 0 THEN '/ingest/v1/http-requests' WHEN 1 THEN '/ingest/v1/http-requests' WHEN 2 THEN '/ingest/v1/spans' "
            "WHEN 3 THEN '/ingest/v1/db' WHEN 4 THEN '/ingest/v1/logs' WHEN 5 THEN '/ingest/v1/errors' WHEN 6 THEN '/ingest/v1/releases' "
            "WHEN 7 THEN '/ingest/v1/sessions/start' WHEN 8 THEN '/ingest/v1/sessions/end' ELSE '/elsewhere' END",
            "payload": "CASE event_id % 10 "
            f"WHEN 0 THEN '{{{{\"requests\":[{{{{\"method\":\"GET\",\"path\":\"/a/' || {U} || '\",\"statusCode\":200,\"traceId\":\"' || md5({K}) || '\"}}}},{{{{\"method\":\"POST\",\"path\":\"/b\",\"statusCode\":503}}}}]}}}}' "
            f"WHEN 1 THEN '{{{{\"requests\":[{{{{\"method\":\"PUT\",\"path\":\"/c/' || {K} || '\",\"statusCode\":404}}}}]}}}}' "
            f"WHEN 2 THEN CASE WHEN user_id % 4 = 1 THEN '{{{{\"other\":1}}}}' ELSE '{{{{\"spans\":[{{{{\"traceId\":\"' || md5({K}) || '\",\"durationMs\":' || {U} || '}}}}]}}}}' END "
            f"WHEN 3 THEN CASE WHEN user_id % 4 = 2 THEN '{{{{\"queries\":[]}}}}' ELSE '{{{{\"queries\":[{{{{\"normalizedQuery\":\"select ?\",\"durationMs\":' || {U} || '}}}}]}}}}' END "
            f"WHEN 4 THEN '{{{{\"level\":\"info\",\"message\":\"m' || {K} || '\",\"metadata\":{{{{\"password\":\"p\",\"n\":\"x\"}}}}}}}}' "
            f"WHEN 5 THEN '{{{{\"exceptionClass\":\"E\",\"message\":\"e' || {U} || '\",\"token\":\"t\"}}}}' "
            f"WHEN 6 THEN '{{{{\"version\":\"v' || {U} || '\",\"environment\":\"prod\"}}}}' "
            f"WHEN 7 THEN '{{{{\"sessionId\":\"s' || {K} || '\",\"release\":\"r\"}}}}' "
            f"WHEN 8 THEN '{{{{\"sessionId\":\"s' || {K} || '\",\"durationMs\":' || {U} || ',\"status\":\"ok\"}}}}' "
            f"ELSE '{{{{\"x\":' || {U} || '}}}}' END",
        },
        None,
    ),
    "deployments": (
        "customer",
        {
            "deployment": "c_custkey",
            "explicit": "CASE c_custkey % 10 WHEN 0 THEN '  v' || CAST(c_custkey AS STRING) || ' ' WHEN 1 THEN '   ' ELSE NULL END",
            **{
                f"env{i}": f"CASE WHEN c_custkey % {p} = 2 THEN '{'' if i % 2 else ' '}e{i}-' || CAST(c_custkey AS STRING) WHEN c_custkey % {p} = 3 THEN ' ' ELSE NULL END"
                for i, p in zip(range(1, 8), (11, 13, 17, 19, 23, 29, 31))
            },
            "git_describe": "CASE WHEN c_custkey % 3 = 0 THEN 'v1-' || CAST(c_custkey AS STRING) || '-dirty' WHEN c_custkey % 3 = 1 THEN ' ' ELSE NULL END",
            "git_sha": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE ' ' || substr(md5(c_name), 1, 7) END",
            "git_status": "CASE c_custkey % 5 WHEN 0 THEN ' M a.py' WHEN 1 THEN '  ' ELSE NULL END",
            "version": "'0.9.' || CAST(c_nationkey AS STRING)",
            "auto_detect": "c_custkey % 7 <> 0",
        },
        None,
    ),
    "registrations": (
        "orders",
        {
            "host": "'https://h' || CAST(o_custkey % 3 AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '/' ELSE '' END",
            "api_key": "CASE WHEN o_custkey % 50 = 0 THEN '' ELSE 'k' || CAST(o_custkey % 50 AS STRING) END",
            "environment": "CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'staging' ELSE NULL END",
            "release": "CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE 'v' || CAST(o_orderkey % 8 AS STRING) END",
        },
        None,
    ),
    "scope_ops": (
        "events",
        {
            "scope_key": U,
            "seq": "event_id",
            "op": "CASE event_id % 9 WHEN 0 THEN 'set_user' WHEN 1 THEN 'set_tag' WHEN 2 THEN 'set_extra' WHEN 3 THEN 'set_context' "
            "WHEN 4 THEN 'set_level' WHEN 5 THEN 'set_fingerprint' WHEN 6 THEN 'set_tag' WHEN 7 THEN 'add_breadcrumb' "
            "ELSE CASE WHEN value > 60 THEN 'clear' ELSE 'add_breadcrumb' END END",
            "name": "'n' || CAST(CAST(floor(value) AS BIGINT) % 3 AS STRING)",
            "value": "event_type || " + K,
            "user_ref": "CASE WHEN value < 5 THEN NULL ELSE 'u' || " + K + " END",
            "print_ref": "CASE WHEN value < 8 THEN '' ELSE event_type END",
            "context_ref": "CASE WHEN value < 12 THEN NULL ELSE 'c' || " + K + " END",
        },
        None,
    ),
}

LINE = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
CALL_FIELDS = {
    "origin": "CASE l_partkey % 6 WHEN 0 THEN 'http://Ingest.Example.com' WHEN 1 THEN 'http://svc.internal:8080' WHEN 2 THEN 'https://api.example.com:443' "
    "WHEN 3 THEN NULL WHEN 4 THEN '10.0.0.1:9000/x' ELSE 'http://1.2.3.4:9000' END",
    "path": "CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '/v1/p?q=' || CAST(l_partkey AS STRING) WHEN 2 THEN '?z' ELSE '/v1/s/' || CAST(l_suppkey AS STRING) END",
    "method": "CASE l_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'post' ELSE 'GET' END",
    "trace_id": "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE md5('t' || CAST(l_orderkey AS STRING)) END",
    "parent_span_id": "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE substr(md5('s' || CAST(l_orderkey AS STRING)), 1, 16) END",
    "request_id": "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE 'req-' || CAST(l_orderkey AS STRING) END",
    "sampled": "CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE l_orderkey % 7 <> 0 END",
}
CALL_BASE = {
    "call_key": LINE,
    "seq": "l_partkey * 1000000 + l_suppkey * 10",
    "at_ms": "{ms}",
    "status_code": "CAST(CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 15 THEN 503 ELSE 201 END AS INT)",
    "outcome": "CASE l_returnflag WHEN 'R' THEN 'error' WHEN 'A' THEN 'headers' ELSE NULL END",
    "took_ms": "CAST(floor(l_extendedprice / 10) AS BIGINT)",
    **CALL_FIELDS,
}
INPUTS["call_lines"] = ("lineitem", CALL_BASE, None)
# The same calls under a key that is used once.
INPUTS["single_calls"] = (
    "lineitem",
    {**CALL_BASE, "call_key": LINE + " || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(floor(l_extendedprice * 100) AS BIGINT) AS STRING) || '-' || CAST({ms} AS STRING)"},
    None,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _millis(df: DataFrame, column: str) -> str:
    if df.schema[column].dataType.typeName() == "timestamp":
        return f"unix_millis({column})"
    return f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column})"


def scalars(source: DataFrame, name: str) -> DataFrame:
    """The scalar columns of a raw input from its (batch or streaming) source table."""
    base, columns, where = INPUTS[name]
    ms = _millis(source, TIME_COLUMN[base]) if base in TIME_COLUMN else ""
    df = source.where(where) if where else source
    return df.selectExpr(*[f"{expr.format(ms=ms)} AS `{col}`" for col, expr in columns.items()])


def cte(name: str, alias: str | None = None) -> str:
    """The same scalar columns as a DuckDB common table expression."""
    base, columns, where = INPUTS[name]
    ms = f"(epoch_us({TIME_COLUMN[base]}) // 1000)" if base in TIME_COLUMN else ""
    select = ", ".join(f'{expr.format(ms=ms)} AS "{col}"' for col, expr in columns.items())
    return f"{alias or name} AS (SELECT {select} FROM {base}{' WHERE ' + where if where else ''})"


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw input with its nested columns."""
    return nested(scalars(table(spark, folder, INPUTS[name][0]), name), name)


def nested(df: DataFrame, name: str) -> DataFrame:
    if name == "request_starts":
        v = SETTINGS.vendor
        names = {
            "host": "h_host", "traceparent": "h_traceparent", f"x-{v}-trace-id": "h_trace_id",
            f"x-{v}-request-id": "h_request_id", "x-request-id": "h_x_request_id",
            f"x-{v}-parent-span-id": "h_parent", "baggage": "h_baggage", "authorization": "h_authorization",
        }
        pairs = [x for k, c in names.items() for x in (F.lit(k), F.when(F.col(c).isNotNull(), F.array(F.col(c))))]
        return df.withColumn("headers", without_nulls(F.create_map(*pairs))).drop(*names.values())
    if name == "raw_logs":
        obj = without_nulls(
            F.create_map(
                F.lit("note"), F.col("m_note"), F.lit("level"), F.lit("30"), F.lit("err"), F.col("m_err"),
                F.lit("user_email"), F.lit("kept@example.com"), F.lit("sdk.version"), F.lit("over"),
            )
        )
        error = F.struct(
            F.col("error_name").alias("name"), F.col("error_message").alias("message"), F.col("error_stack").alias("stack")
        )
        return df.withColumn("merge_obj", obj).withColumn("error", F.when(F.col("has_error"), error))
    if name == "scope_ops":
        return df.select(
            "scope_key", "seq", "op", "name", "value",
            F.when(F.col("user_ref").isNotNull(), F.struct(F.col("user_ref").alias("id"), F.lit(None).cast("string").alias("email"))).alias("user"),
            F.when(F.col("print_ref") == "", F.array().cast("array<string>")).otherwise(F.array("print_ref")).alias("fingerprint"),
            F.when(F.col("context_ref").isNotNull(), F.create_map(F.lit("v"), F.col("context_ref"))).alias("context"),
            F.struct(F.col("value").alias("message")).alias("crumb"),
        )
    if name in ("call_lines", "single_calls"):
        fields = list(CALL_FIELDS)
        create = F.struct("seq", F.lit("create").alias("kind"), "at_ms", F.lit(None).cast("int").alias("status_code"))
        done = F.struct(
            (F.col("seq") + 1).alias("seq"), F.col("outcome").alias("kind"), (F.col("at_ms") + F.col("took_ms")).alias("at_ms"), "status_code"
        )
        both = F.when(F.col("outcome").isNull(), F.array(create)).otherwise(F.array(create, done))
        return df.select("call_key", *fields, F.inline(both))
    return df


# One scope stack per event: the global copy, and for every other event a fork on top of it.
SCOPE_ROWS = {
    "scope_key": K,
    "u": U,
    "forked": "event_id % 2 = 0",
    "region": "'r' || CAST(user_id % 4 AS STRING)",
    "kind": "event_type",
    "ref": K,
    "severe": "event_id % 10 = 0",
    "printed": "event_id % 8 = 0",
}
INPUTS["scope_base"] = ("events", SCOPE_ROWS, None)


def scopes(spark: SparkSession, folder: str) -> DataFrame:
    base = raw(spark, folder, "scope_base")
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    bag = lambda **kv: F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), text(v))])
    crumb = lambda m: F.struct(F.lit("log").alias("type"), m.alias("message"))
    empty = F.expr("CAST(map() AS MAP<STRING,STRING>)")
    bottom = F.struct(
        F.lit(0).alias("depth"),
        F.lit(None).cast("struct<id:string,email:string>").alias("user"),
        bag(region=F.col("region"), tier="free").alias("tags"),
        empty.alias("extras"),
        F.expr("CAST(map() AS MAP<STRING,MAP<STRING,STRING>>)").alias("contexts"),
        F.lit(None).cast("array<string>").alias("fingerprint"),
        F.lit("warning").alias("level"),
        F.array(crumb(F.concat(F.lit("a"), F.col("ref")))).alias("breadcrumbs"),
    )
    top = F.struct(
        F.lit(1).alias("depth"),
        F.struct(F.concat(F.lit("u-"), F.col("u")).alias("id"), F.concat(F.lit("u"), F.col("u"), F.lit("@example.com")).alias("email")).alias("user"),
        bag(region=F.col("region"), tier="paid", feature=F.col("kind")).alias("tags"),
        bag(order=F.col("ref"), api_token="secret").alias("extras"),
        F.create_map(F.lit("app"), bag(v="1")).alias("contexts"),
        F.when(F.col("printed"), F.array(F.lit("fp"), F.col("kind"))).alias("fingerprint"),
        F.when(F.col("severe"), F.lit("fatal")).alias("level"),
        F.array(crumb(F.concat(F.lit("a"), F.col("ref"))), crumb(F.concat(F.lit("b"), F.col("ref")))).alias("breadcrumbs"),
    )
    return base.select("scope_key", F.inline(F.when(F.col("forked"), F.array(bottom, top)).otherwise(F.array(bottom))))
