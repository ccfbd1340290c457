"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores). Results go to the no-op sink, so
every column is computed and nothing is collected. Each query runs once to warm up and once timed.
"""

from __future__ import annotations

import json
import os
import platform
import sys
import time

from pyspark.sql import SparkSession

from beaconry.plans.queries import QUERIES

# Query: the table whose rows it reads, for the rows-per-second figure.
HEADLINE = {
    "query_fingerprint_stats": "orders",
    "build_db_rows": "orders",
    "fingerprint_sql": "orders",
    "scrub_corpus_documents": "documents",
    "scrub_payload": "events",
    "redact_keys": "events",
    "resolve_trace_context": "events",
    "build_http_rows": "events",
    "route_stats": "events",
    "pair_outbound_calls": "lineitem",
    "plan_retries": "lineitem",
    "settle": "lineitem",
    "fold_sessions": "events",
    "crash_free_rates": "events",
    "merge_scopes": "events",
    "attach_breadcrumbs": "events",
    "pack_batches": "events",
    "cap_bytes": "events",
    "trace_db_time": "orders",
    "span_parents": "events",
    "build_log_rows": "events",
    "url_parts": "pages",
    "stream_compacted_sessions": "events",
    "redact_keys_json": "events",
    "scrub_payload_json": "events",
    "before_send": "events",
    "stream_http_rows": "events",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("beaconry-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    counts: dict[str, int] = {}
    seconds, rates = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        source = HEADLINE[name]
        if source not in counts:
            counts[source] = spark.read.parquet(f"{folder}/{source}.parquet").count()
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        rates[name] = round(counts[source] / seconds[name])
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "rows_per_sec": rates, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "host": {"cpus": cpus, "machine": platform.machine(), "spark": spark.version},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
