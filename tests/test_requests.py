"""Trace context, sampling, request rows, releases, logs and scopes on literal cases."""

import pytest
from pyspark.sql import functions as F

from beaconry.operators import errors, logs, releases, requests, sampling, scopes
from beaconry.operators.correlate import span_parents
from beaconry.schemas import raw
from beaconry.settings import Settings

S = Settings(vendor="acme", sdk_name="acme-sdk", sdk_version="2", component="web", service="shop")
A, B = "a" * 32, "b" * 16


def starts(spark, *headers, url="/health?x=1", user="u"):
    rows = [(str(i), "get", url, "svc", {k: [v] for k, v in h.items()}, user, 1000) for i, h in enumerate(headers)]
    return spark.createDataFrame(rows, raw("request_starts"))


def test_context(spark):
    df = starts(
        spark,
        {"traceparent": f"00-{A}-{B}-01", "x-acme-request-id": "req"},
        {"traceparent": f"00-{A}-{B}-00"},
        {},
        {"traceparent": f"00-{A}-{B}-zz", "x-request-id": "x", "x-acme-trace-id": "mine", "x-acme-parent-span-id": "p"},
        {"traceparent": "00-short-short-03"},
        {"traceparent": f"00-{A}-{B}"},
    )
    got = requests.resolve_trace_context(df, S, rate=0).orderBy("request_key").collect()
    assert [(r.trace_id, r.request_id, r.parent_span_id, r.sampled) for r in got[:2]] == [(A, "req", B, True), (A, A, B, False)]
    assert len(got[2].trace_id) == 32 and len(got[2].span_id) == 16 and got[2].parent_span_id == "" and not got[2].sampled
    assert (got[3].trace_id, got[3].request_id, got[3].parent_span_id, got[3].sampled) == ("mine", "x", "p", False)
    assert (got[4].parent_span_id, got[4].sampled) == ("", True)
    assert (got[5].parent_span_id, got[5].sampled) == ("", False)
    assert requests.resolve_trace_context(starts(spark, {}), S).first().sampled


def test_audit(spark):
    ctx = requests.resolve_trace_context(starts(spark, {"baggage": " a=1 ,ACME-x=2,,b=3", "x-acme-trace-id": "odd"}), S)
    row = requests.audit_propagation(ctx.withColumn("recorded_headers", F.create_map(F.lit("x"), F.lit("y"))), settings=S).first()
    assert row.expected_baggage.startswith("a=1,b=3,acme-trace_id=odd,acme-request_id=odd,acme-span_id=") and row.mismatch
    _, trace, span, flag = row.expected_traceparent.split("-")
    assert (len(trace), len(span), flag) == (32, 16, "01") and row.expected_trace_id == "odd"


@pytest.mark.parametrize("rate, want", [(0.0, 0), (1.0, 50), (-3, 0), (7, 50), (float("nan"), 50), (None, 50)])
def test_rates(spark, rate, want):
    df = spark.range(50).select(F.col("id").cast("string").alias("trace_id"))
    assert sampling.sample_traces(df, rate).count() == want


def test_sampling_is_the_same_in_every_table(spark):
    ids = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("trace_id"))
    one = {r.trace_id for r in sampling.sample_traces(ids, 0.3).collect()}
    two = {r.trace_id for r in sampling.sample_traces(ids.union(ids).repartition(7), 0.3).collect()}
    assert one == two and 60 < len(one) < 180


def test_http_rows_and_spans(spark):
    ctx = requests.resolve_trace_context(starts(spark, {"host": "h", "authorization": "Bearer S", "traceparent": f"00-{A}-{B}-01"}), S)
    ends = spark.createDataFrame([("0", 503, 900)], raw("request_ends"))
    stack = spark.createDataFrame(
        [("0", 0, ("u-42", "e@x.io"), {"region": "eu"}, {"orderId": "7", "token": "t"}, {"app": {"v": "1"}}, None, None)], raw("scopes")
    )
    http = requests.build_http_rows(ctx, ends, scopes.merge_scopes(stack), S, capture_headers=True)
    row = http.first()
    assert (row.method, row.host, row.path, row.duration_ms, row.user_id, row.parent_span_id) == ("GET", "h", "/health", 0, "u-42", B)
    assert "authorization: [REDACTED]" in row.request_headers
    assert row.metadata == {
        "sdk.name": "acme-sdk", "sdk.version": "2", "userId": "u-42", "userEmail": "e@x.io", "tag.region": "eu",
        "extra.orderId": "7", "extra.token": "[REDACTED]", "context.app": '{"v":"1"}',
    }
    span = requests.build_server_spans(http, S).first()
    assert (span.operation, span.description, span.status, span.data) == ("web.request", "GET /health", "error", '{"host":"h","path":"/health"}')
    plain = requests.build_http_rows(ctx, ends, None, S).first()
    assert (plain.user_id, plain.request_headers) == ("u", "")


def test_errors_with_scope(spark):
    ctx = requests.resolve_trace_context(starts(spark, {}, url="/parcels/8?key=2"), S)
    errs = spark.createDataFrame([("0", None, "boom", "E: boom\n at x", 1), ("0", "T", None, None, 2)], raw("request_errors"))
    rows = errors.build_error_rows(ctx, errs, S).withColumnRenamed("request_key", "scope_key")
    fork = [("0", 0, None, {"t": "1", "k": "a"}, None, None, ["f"], "info"), ("0", 1, ("7", None), {"k": "b"}, {"secret": "x"}, None, None, None)]
    merged = scopes.merge_scopes(spark.createDataFrame(fork, raw("scopes")))
    got = {r.seq: r for r in errors.apply_scope(rows, merged, S).collect()}
    assert (got[1].exception_class, got[1].stack_trace, got[2].exception_class, got[2].stack_trace) == ("Error", ["E: boom", " at x"], "T", [])
    assert (got[1].level, got[1].fingerprint, got[1].user_id) == ("info", ["f"], "7")
    assert got[1].metadata["tag.k"] == "b" and got[1].metadata["tag.t"] == "1" and got[1].metadata["extra.secret"] == "[REDACTED]"
    assert got[1].metadata["httpPath"] == "/parcels/8" and got[1].metadata["httpMethod"] == "get"
    other = errors.apply_scope(rows.withColumn("scope_key", F.lit(None).cast("string")), merged, S).collect()
    assert len(other) == 2 and all(r.level == "error" and r.user_id is None for r in other)
    crumb = errors.request_breadcrumbs(ctx).first()
    assert (crumb.message, crumb.category, crumb.data["host"], crumb.timestamp) == ("GET /parcels/8", "http.server", "svc", "1970-01-01T00:00:01.000Z")
    given = spark.createDataFrame([("t", 5), (None, 5)], "timestamp string, at_ms bigint")
    assert [r.timestamp for r in errors.stamp_breadcrumbs(given).collect()] == ["t", "1970-01-01T00:00:00.005Z"]


OPS = "scope_key string, seq bigint, op string, name string, value string, user struct<id:string,email:string>, fingerprint array<string>, context map<string,string>, crumb struct<message:string>"


def test_scope_ops(spark):
    op = lambda seq, op, name=None, value=None, user=None, fp=None, ctx=None, crumb=None: ("s", seq, op, name, value, user, fp, ctx, crumb)
    log = [
        op(1, "set_tag", "old", "x"), op(2, "set_user", user=("u0", None)), op(3, "add_breadcrumb", crumb=("gone",)), op(4, "clear"),
        op(5, "set_tag", "a", "1"), op(6, "set_tag", "a", "2"), op(7, "set_extra", "e", "9"), op(8, "set_context", "c", ctx={"v": "1"}),
        op(9, "set_context", "d", ctx={"v": "2"}), op(10, "set_context", "c"), op(11, "set_level", value="fatal"), op(12, "set_user", user=("u1", "m")),
        op(13, "set_fingerprint", fp=["p"]), op(14, "set_fingerprint", fp=[]), *[op(20 + i, "add_breadcrumb", crumb=(f"c{i}",)) for i in range(60)],
    ]
    row = scopes.apply_scope_ops(spark.createDataFrame(log, OPS).repartition(3)).first()
    assert (row.user.id, row.level, row.fingerprint) == ("u1", "fatal", None)
    assert (row.tags, row.extras, row.contexts) == ({"a": "2"}, {"e": "9"}, {"d": {"v": "2"}})
    assert [c.message for c in row.breadcrumbs] == [f"c{i}" for i in range(10, 60)]
    cleared = scopes.apply_scope_ops(spark.createDataFrame([*log, op(99, "set_user")], OPS)).first()
    assert cleared.user is None


RAW_LOG = dict(level="info", arg_kind="string", arg_text=None, message=None, merge_obj=None, error=None, trace_id="t", span_id="s", request_id="r")


def log(spark, min_level="info", **kw):
    row = {**RAW_LOG, **kw}
    return logs.build_log_rows(spark.createDataFrame([tuple(row.values())], raw("raw_logs")), min_level, settings=S).first()


def test_logs(spark):
    assert log(spark, arg_text="parcel for ann.lee@example.org is late").message == "parcel for [REDACTED] is late"
    err = ("TypeError", "boom", "TypeError: boom\n at 10.0.0.1")
    row = log(spark, level="error", arg_kind="error", error=err)
    assert row.message == "boom" and row.metadata["error.type"] == "TypeError"
    assert row.metadata["error.stackTrace"] == '["TypeError: boom"," at [REDACTED]"]'
    assert log(spark, level="error", arg_kind="error", error=err, message="said").message == "said"
    row = log(spark, level="warn", arg_kind="object", merge_obj={"level": "9", "pid": "1", "k": "v", "sdk.name": "over"}, message="m", error=err)
    assert (row.message, row.metadata) == ("m", {"sdk.name": "over", "sdk.version": "2", "k": "v"})
    assert log(spark, arg_kind="object", merge_obj={"k": "v"}, error=err).message == "boom"
    assert log(spark, level="trace", min_level="trace", arg_text="x").level == "debug"
    assert log(spark, min_level="warn", arg_text="x") is None and log(spark, arg_kind=None) is None
    assert "error.type" not in log(spark, level="error", arg_text="plain", error=err).metadata


DEPLOY = "explicit string, env1 string, env2 string, env3 string, env4 string, env5 string, env6 string, env7 string, git_describe string, git_sha string, git_status string, version string, auto_detect boolean"


@pytest.mark.parametrize("given, want", [
    (dict(explicit=" v1 ", env1="e"), "v1"), (dict(env1="  ", env2=" two "), "two"), (dict(env7="seven", git_describe="g"), "seven"),
    (dict(git_describe="v1-3-gabc-dirty\n", git_sha="s"), "v1-3-gabc-dirty"), (dict(git_sha="abc", git_status=" M f"), "abc-dirty"),
    (dict(git_describe=" ", git_sha=" abc", git_status=" "), "abc"), (dict(version="1.0"), "1.0"), (dict(version="1.0", auto_detect=False), ""),
    (dict(env3="e", auto_detect=False), "e"), (dict(), ""),
])
def test_releases(spark, given, want):
    names = [c.split()[0] for c in DEPLOY.split(", ")]
    df = spark.createDataFrame([tuple(given.get(n, True if n == "auto_detect" else None) for n in names)], DEPLOY)
    assert releases.resolve_releases(df).first().release == want


def test_registrations(spark):
    df = spark.createDataFrame([("h/", "k", "", "v"), ("h", "k", "production", "v"), ("h", "k", "dev", "v"), ("h", "", "dev", "v"), ("h", "k", "dev", "")], "host string, api_key string, environment string, release string")
    assert {(r.version, r.environment, r.author) for r in releases.register_releases(df, S).collect()} == {("v", "production", "acme-sdk/2"), ("v", "dev", "acme-sdk/2")}


def test_hook(spark):
    def hook(row):
        if row["v"] is None:
            row["s"] = "was null"
            return row
        if row["v"] == 1:
            return None
        if row["v"] == 2:
            raise RuntimeError
        row["v"] += 10
        return row

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "v int, s string")
    assert {tuple(r) for r in sampling.before_send(df, hook).collect()} == {(2, "b"), (13, "c"), (None, "was null")}


def test_span_roles(spark):
    rows = [("t", "a", "", "root", 1), ("t", "b", "a", "x", 2), ("t", "c", "zz", "x", 3), ("u", "d", "a", "x", 4), ("", "e", "a", "x", 5)]
    df = spark.createDataFrame(rows, "trace_id string, span_id string, parent_span_id string, operation string, start_time_millis bigint")
    assert {r.span_id: (r.role, r.parent_operation) for r in span_parents(df).collect()} == {
        "a": ("root", None), "b": ("child", "root"), "c": ("orphan", None), "d": ("orphan", None), "e": ("orphan", None)
    }
