"""URL columns and per-route statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from beaconry.functions import url


def url_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host``, ``port`` and ``path`` (no query) of an absolute URL."""
    u = F.col(url_col)
    return df.withColumn("_origin", url.parse_origin(u)).withColumns(
        {"host": F.col("_origin.host"), "port": F.col("_origin.port"), "path": url.inbound_path(url.request_target(u))}
    ).drop("_origin")


def route_stats(http: DataFrame, template: bool = False, accuracy: int | None = None) -> DataFrame:
    """Requests, errors, error rate and latency percentiles per service, method and path.

    ``template`` turns numeric path segments into ``:id``. Counts per millisecond value come first,
    as for the statement statistics, and ``accuracy`` has the same meaning.
    """
    path = F.regexp_replace("path", r"(?<=/)[0-9]+(?=/|\z)", ":id") if template else F.col("path")
    keys = ["service", "method", "route"]
    rows, shares = http.withColumn("route", path), [0.5, 0.95, 0.99]
    sums = [F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status_code") >= 500).alias("errors")]
    longest = F.max("duration_ms").alias("max_ms")
    if accuracy:
        p = F.percentile_approx("duration_ms", shares, accuracy).cast("array<double>")
        stats = rows.groupBy(*keys).agg(*sums, p.alias("p"), longest)
    else:
        counted = rows.groupBy(*keys, "duration_ms").agg(*sums)
        p = F.percentile("duration_ms", shares, F.col("requests"))
        stats = counted.groupBy(*keys).agg(p.alias("p"), longest, *[F.sum(c).alias(c) for c in ("requests", "errors")])
    return stats.select(
        *keys, "requests", "errors", (F.col("errors") / F.col("requests")).alias("error_rate"),
        *[F.get("p", F.lit(i)).alias(f"{name}_ms") for i, name in enumerate(("p50", "p95", "p99"))], "max_ms",
    )
