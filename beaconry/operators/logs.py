"""Log rows from logger calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from beaconry.functions.maps import overlay, without_nulls
from beaconry.functions.privacy import SKIP_KEYS, scrubbed
from beaconry.operators.requests import sdk_tags
from beaconry.operators.sampling import min_level as at_least
from beaconry.settings import Settings

# Logger fields that are not copied, and levels that carry their error.
STRUCTURAL = ["level", "time", "pid", "hostname"]
PROMOTED = ["error", "fatal"]


def build_log_rows(
    raw_logs: DataFrame, min_level: str = "info", send_default_pii: bool = False, settings: Settings = Settings()
) -> DataFrame:
    """Gate by level, read the logger's argument shapes, promote errors and scrub the values.

    ``arg_kind`` is the shape of the first argument: ``error``, ``object``, ``string`` or ``other``;
    NULL (no argument) emits nothing. ``message`` is the second argument when it is text. For
    objects, ``error_key`` (optional column) says which key the error came from; a value under
    ``err`` that is no error hides one under ``error``.
    """
    rows = at_least(raw_logs.where(F.col("arg_kind").isNotNull()), min_level)
    kind, error = F.col("arg_kind"), F.col("error")
    if "error_key" in raw_logs.columns:
        hidden = (
            (kind == "object") & (F.col("error_key") == "error")
            & F.try_element_at("merge_obj", F.lit("err")).isNotNull()
        )
        error = F.when(~F.coalesce(hidden, F.lit(False)), error)
    error = F.when(kind.isin("error", "object"), error)
    second = F.coalesce("message", F.lit(""))
    said = F.when(kind.isin("error", "object"), second).otherwise(F.coalesce("arg_text", F.lit("")))
    message = F.coalesce(F.nullif(said, F.lit("")), error["message"], F.lit(""))

    clean = lambda c: scrubbed(c, send_default_pii)
    merged = F.map_filter(F.when(kind == "object", F.col("merge_obj")), lambda k, _: ~k.isin(STRUCTURAL))
    base = F.transform_values(
        overlay(sdk_tags(settings), merged), lambda k, v: F.when(F.lower(k).isin(SKIP_KEYS), v).otherwise(clean(v))
    )
    stack = F.to_json(F.transform(F.split(F.nullif(error["stack"], F.lit("")), "\n"), clean))
    promoted = F.when(
        F.col("level").isin(PROMOTED) & error.isNotNull(),
        without_nulls(
            F.create_map(
                F.lit("error.type"), clean(F.coalesce(F.nullif(error["name"], F.lit("")), F.lit("Error"))),
                F.lit("error.message"), clean(error["message"]),
                F.lit("error.stackTrace"), stack,
            )
        ),
    )
    return rows.select(
        F.when(F.col("level") == "trace", F.lit("debug")).otherwise(F.col("level")).alias("level"),
        clean(message).alias("message"),
        F.lit(settings.service).alias("service"),
        F.lit(settings.environment).alias("environment"),
        F.lit(settings.release).alias("release"),
        "trace_id", "span_id", "request_id",
        overlay(base, promoted).alias("metadata"),
    )
