"""Release resolution and registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.functions.text import non_blank
from beaconry.settings import Settings

ENV_COLUMNS = [f"env{i}" for i in range(1, 8)]


def resolved_release(env_columns: Sequence[str] = ENV_COLUMNS) -> Column:
    """First non-blank of: explicit, environment columns in order, git description or sha, version."""
    sha = non_blank(F.col("git_sha"))
    dirty = F.when(non_blank(F.col("git_status")).isNotNull(), F.lit("-dirty")).otherwise(F.lit(""))
    detected = F.coalesce(non_blank(F.col("git_describe")), F.concat(sha, dirty), F.col("version"))
    return F.coalesce(
        non_blank(F.col("explicit")),
        *[non_blank(F.col(c)) for c in env_columns],
        F.when(F.coalesce("auto_detect", F.lit(True)), detected),
        F.lit(""),
    )


def resolve_releases(deployments: DataFrame, env_columns: Sequence[str] = ENV_COLUMNS) -> DataFrame:
    return deployments.withColumn("release", resolved_release(env_columns))


def register_releases(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One release row per distinct (host, key, environment, release).

    ``rows`` are (host, api_key, environment, release); a row without key or release registers nothing.
    """
    ready = rows.where((F.coalesce("release", F.lit("")) != "") & (F.coalesce("api_key", F.lit("")) != "")).withColumn(
        "environment", F.coalesce(F.nullif(F.col("environment"), F.lit("")), F.lit("production"))
    ).withColumn("host", F.regexp_replace("host", r"/\z", ""))
    keys = ["host", "api_key", "environment", "release"]
    distinct = ready.dropDuplicatesWithinWatermark(keys) if ready.isStreaming else ready.select(*keys).distinct()
    return distinct.select(
        "host", "api_key",
        F.col("release").alias("version"),
        "environment",
        F.lit(f"{settings.sdk_name}/{settings.sdk_version}").alias("author"),
        F.lit("Registered automatically at runtime").alias("message"),
    )
