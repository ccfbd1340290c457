"""Error and message rows, scope application, breadcrumbs and grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions import url
from beaconry.functions.clock import iso_millis
from beaconry.functions.maps import overlay
from beaconry.functions.privacy import Extras, redact_typed
from beaconry.operators.requests import scope_metadata, sdk_tags, with_scope
from beaconry.operators.skew import WIDTH, lookup, running_total
from beaconry.settings import Settings

# Fixed value: breadcrumbs kept per scope.
MAX_BREADCRUMBS = 50


def _identity(settings: Settings) -> list[Column]:
    return [
        F.lit(settings.environment).alias("environment"),
        F.lit(settings.release).alias("release"),
        F.lit(settings.sdk_name).alias("sdk_name"),
        F.lit(settings.sdk_version).alias("sdk_version"),
        F.lit(settings.platform).alias("platform"),
    ]


def _lines(stack: Column) -> Column:
    return F.when(F.coalesce(stack, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(stack, "\n"))


def _class(name: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("Error"))


def build_error_rows(ctx: DataFrame, errors: DataFrame, settings: Settings = Settings(), sessions: DataFrame | None = None) -> DataFrame:
    """Error rows of failed requests, before scope. ``sessions`` (request_key, session_id) is optional.

    A request may fail many times, so errors look their request up and not the other way round.
    """
    meta = overlay(
        sdk_tags(settings),
        F.create_map(
            F.lit("service"), F.lit(settings.service), F.lit("httpMethod"), F.col("method"),
            F.lit("httpPath"), url.inbound_path(F.col("url")),
        ),
    )
    rows = errors.join(
        ctx.select("request_key", "method", "url", "trace_id", "span_id", "parent_span_id", "request_id"), "request_key"
    )
    if sessions is not None:
        rows = lookup(rows, sessions.select("request_key", "session_id"), ["request_key"], ["seq"])
    else:
        rows = rows.withColumn("session_id", F.lit(None).cast("string"))
    return rows.select(
        "request_key", "seq",
        _class(F.col("error_name")).alias("exception_class"),
        F.col("error_message").alias("message"),
        _lines(F.col("error_stack")).alias("stack_trace"),
        F.lit("error").alias("level"),
        *_identity(settings),
        "trace_id", "span_id", "parent_span_id", "request_id",
        meta.alias("metadata"),
        "session_id",
    )


def build_manual_rows(captures: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Error rows of manual captures: ``error_*``, optional ``level``, ``extra`` map, ``session_id``."""
    service = F.create_map(F.lit("service"), F.lit(settings.service))
    return captures.select(
        *[c for c in ("scope_key", "seq") if c in captures.columns],
        _class(F.col("error_name")).alias("exception_class"),
        F.col("error_message").alias("message"),
        _lines(F.col("error_stack")).alias("stack_trace"),
        F.coalesce("level", F.lit("error")).alias("level"),
        *_identity(settings),
        overlay(overlay(sdk_tags(settings), service), F.col("extra")).alias("metadata"),
        "session_id",
    )


def build_message_rows(messages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Messages as error rows: class ``Message``, no stack, level ``info`` unless given."""
    service = F.create_map(F.lit("service"), F.lit(settings.service))
    return messages.select(
        *[c for c in ("scope_key", "seq") if c in messages.columns],
        F.lit("Message").alias("exception_class"),
        "message",
        F.array().cast("array<string>").alias("stack_trace"),
        F.coalesce("level", F.lit("info")).alias("level"),
        *_identity(settings),
        overlay(sdk_tags(settings), service).alias("metadata"),
        "session_id",
    )


def apply_scope(
    records: DataFrame, merged: DataFrame, settings: Settings = Settings(), extra: Extras = (), key: str = "scope_key"
) -> DataFrame:
    """Overlay merged scopes on error rows.

    User, tags, extras and contexts go to the metadata, which is then key-redacted; level and
    fingerprint replace the record's; breadcrumbs are attached when there are any; the user id is
    filled where absent.
    """
    rows = with_scope(records, merged, key)
    meta = overlay(F.col("metadata"), scope_metadata(F.col("_user"), F.col("_tags"), F.col("_extras"), F.col("_contexts")))
    shown, _ = redact_typed(meta, rows.select(meta.alias("m")).schema["m"].dataType, settings.vendor, extra)
    own = lambda name: F.col(name) if name in records.columns else F.lit(None)
    columns = {
        "metadata": shown,
        "level": F.coalesce(F.col("_level"), own("level")),
        "fingerprint": F.coalesce(F.col("_fingerprint"), own("fingerprint")),
        "user_id": F.coalesce(own("user_id"), F.col("_user")["id"]),
    }
    if "breadcrumbs" in merged.columns:
        crumbs = F.col("_breadcrumbs")
        columns["breadcrumbs"] = F.coalesce(F.when(F.size(crumbs) > 0, crumbs), own("breadcrumbs"))
    out = rows.withColumns(columns)
    return out.drop(*[f"_{c}" for c in merged.columns if c != "scope_key"])


def request_breadcrumbs(ctx: DataFrame) -> DataFrame:
    """The automatic breadcrumb of each request start."""
    method, path = F.upper("method"), url.inbound_path(F.col("url"))
    return ctx.select(
        F.col("request_key").alias("scope_key"),
        F.lit("http").alias("type"),
        F.lit("http.server").alias("category"),
        F.concat_ws(" ", method, path).alias("message"),
        F.lit("info").alias("level"),
        F.create_map(
            F.lit("method"), method, F.lit("path"), path,
            F.lit("host"), url.request_host(F.col("headers"), F.col("hostname")), F.lit("requestId"), F.col("request_id"),
        ).alias("data"),
        iso_millis(F.col("started_ms")).alias("timestamp"),
        "started_ms",
    )


def stamp_breadcrumbs(crumbs: DataFrame, at_ms: str = "at_ms") -> DataFrame:
    """Fill the timestamp of crumbs recorded without one."""
    return crumbs.withColumn("timestamp", F.coalesce("timestamp", iso_millis(F.col(at_ms))))


def attach_breadcrumbs(
    errors: DataFrame, crumbs: DataFrame, n: int = MAX_BREADCRUMBS, width: int = WIDTH
) -> DataFrame:
    """Add the newest ``n`` breadcrumbs recorded in the error's scope before it, oldest first.

    Both inputs carry (scope_key, seq), ``seq`` unique in its scope. Crumbs are numbered per scope
    and packed into blocks of ``n``; an error that follows ``k`` crumbs needs at most the block of
    crumb ``k`` and the one before, so no scope is ever collected whole. Without crumbs: NULL. An error's row goes
    along whole, so errors need no id.
    """
    fields = [c for c in crumbs.columns if c not in ("scope_key", "seq")]
    names = [c for c in errors.columns if c != "breadcrumbs"]
    row, crumb = F.struct(*names), F.struct(*fields)
    shapes = [f.dataType for f in (errors.select(row.alias("r")).schema["r"], crumbs.select(crumb.alias("c")).schema["c"])]
    scoped = errors.where(F.col("scope_key").isNotNull())
    both = crumbs.where(F.col("scope_key").isNotNull()).select("scope_key", "seq", F.lit(0).alias("_after"), crumb.alias("_crumb"), F.lit(None).cast(shapes[0]).alias("_row"))
    both = both.unionByName(scoped.select("scope_key", "seq", F.lit(1).alias("_after"), F.lit(None).cast(shapes[1]).alias("_crumb"), row.alias("_row")))
    # At equal seq a crumb comes before the error.
    counted = running_total(both, ["scope_key"], ["seq", "_after"], (1 - F.col("_after")).cast("bigint"), "_k", width)
    # Each crumb goes to its own block and, as history, to the next one: at most 2 n crumbs a block.
    block = F.floor((F.col("_k") - 1) / n)
    blocks = (
        counted.where("_after = 0")
        .select("scope_key", "_k", "_crumb", F.explode(F.array(block, block + 1)).alias("_block"))
        .groupBy("scope_key", "_block")
        .agg(F.collect_list(F.struct("_k", "_crumb")).alias("_list"))
    )
    found = counted.where("_after = 1").select("scope_key", "_row", "_k", block.alias("_block")).join(blocks, ["scope_key", "_block"], "left")
    k = F.col("_k")
    kept = F.filter("_list", lambda e: (e["_k"] <= k) & (e["_k"] > k - n))
    ordered = F.array_sort(kept, lambda a, b: (a["_k"] - b["_k"]).cast("int"))
    with_crumbs = found.select("_row.*", F.transform(ordered, lambda e: e["_crumb"]).alias("breadcrumbs"))
    nothing = F.lit(None).cast(with_crumbs.schema["breadcrumbs"].dataType).alias("breadcrumbs")
    return with_crumbs.unionByName(errors.where(F.col("scope_key").isNull()).select(*names, nothing))


def group_errors(errors: DataFrame) -> DataFrame:
    """Error groups: by fingerprint where given, else by class and message with the numbers masked.

    Counts per (group, user, release) come first, so the distinct counts run on reduced rows.
    """
    masked = F.trim(F.regexp_replace(F.coalesce("message", F.lit("")), r"[0-9]+", "?"))
    key = F.coalesce(
        F.when(F.size("fingerprint") > 0, F.array_join("fingerprint", "\x1f")),
        F.concat_ws("\x1f", "exception_class", masked),
    )
    seen = errors.groupBy(key.alias("group_key"), "user_id", "release").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("timestamp_millis").alias("first_seen"),
        F.max("timestamp_millis").alias("last_seen"),
    )
    return seen.groupBy("group_key").agg(
        F.sum("n").alias("count"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("release").alias("releases"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
