"""Envelope files and tables: ``{path, payload, ts}``, payload as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from beaconry.functions.clock import iso_millis
from beaconry.functions.privacy import camel, json_cleaner, may_hold_sensitive_keys
from beaconry.schemas import PATHS, ROW_ARRAYS, TABLES, record, wire
from beaconry.settings import Settings
from beaconry.sources import spool

# Fixed value: names of envelope files.
FILE_NAME = r"(?i)^[0-9]+-[0-9a-z]+\.json(?![\s\S])"


def envelope_rows(files: DataFrame) -> DataFrame:
    """(file_name, value, size) rows with what they hold: path, payload, ts, and the ``reason`` why they hold none.

    Files with other names are no envelopes and don't appear. Reasons: ``unreadable`` (no text), ``json``, ``path``
    (not text), ``ts`` (no number). File names in text order are age order.
    """
    named = files.where(F.col("file_name").rlike(FILE_NAME))
    tree = F.call_function("try_parse_json", F.col("value"))
    kind = lambda at: F.coalesce(
        F.call_function("schema_of_variant", F.call_function("try_variant_get", F.col("_tree"), F.lit(at), F.lit("variant"))), F.lit("")
    )
    reason = (
        F.when(F.col("value").isNull(), "unreadable").when(F.col("_tree").isNull(), "json").when(kind("$.path") != "STRING", "path")
        .when(~kind("$.ts").rlike(r"^(BIGINT|DOUBLE|DECIMAL|INT|SMALLINT|TINYINT|FLOAT)"), "ts")
    )
    read = named.withColumn("_tree", tree).withColumn("reason", reason).drop("_tree")
    body = F.when(F.col("reason").isNull(), F.from_json("value", "path STRING, payload STRING, ts DOUBLE"))
    return read.withColumn("_body", body).select(
        "file_name", "_body.path", "_body.payload", F.floor("_body.ts").alias("ts"), "size", "value", "reason"
    )


def parse_envelopes(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`envelope_rows` as envelopes and rejected files."""
    rows = envelope_rows(files)
    good = rows.where(F.col("reason").isNull()).drop("value", "reason")
    return good, rows.where(F.col("reason").isNotNull()).select("file_name", "value", "size", "reason")


def read_envelopes(spark: SparkSession, folder: str, **options: str) -> tuple[DataFrame, DataFrame]:
    """Envelopes and rejected files of a folder with one JSON document per file; filters on ``file_name`` prune files.

    Each of the two reads the folder; :func:`envelope_rows` of :func:`~beaconry.sources.spool.files` has both at once.
    """
    return parse_envelopes(spool.files(spark, folder, **options))


def stream_envelopes(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The readable envelopes of the folder as a stream in the order of file names."""
    return parse_envelopes(spool.file_stream(spark, folder, **options))[0]


def write_envelopes(df: DataFrame, folder: str, settings: Settings = Settings(), mode: str = "append") -> None:
    """Persist envelopes after one more key redaction, one folder per path.

    Payloads without a sensitive key stay as they are and in the JVM; only the others are taken apart in Python. A
    payload that can't be taken apart, unreadable or nested too deeply, is withheld: the mark of redaction stands for it.
    """
    payload = F.col("payload")
    some = F.when(may_hold_sensitive_keys(payload, settings.vendor), payload)
    clean = json_cleaner(settings.vendor, scrub=False, withhold=True)(some)
    df.select("path", F.coalesce(clean, payload).alias("payload"), "ts").write.mode(mode).partitionBy("path").json(folder)


def read_spool(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`write_envelopes` wrote; filters on ``path`` prune folders."""
    return spark.read.schema("payload STRING, ts BIGINT, path STRING").json(folder)


def with_route(envelopes: DataFrame) -> DataFrame:
    """Add ``route``, the path of an envelope or ``unknown``: all routes in one pass, as for ``partitionBy("route")``."""
    return envelopes.withColumn("route", F.when(F.col("path").isin(PATHS), F.col("path")).otherwise("unknown"))


def route_envelopes(envelopes: DataFrame) -> dict[str, DataFrame]:
    """Envelopes by path, plus the ones with a path nobody knows."""
    out = {path: envelopes.where(F.col("path") == path) for path in PATHS}
    out["unknown"] = envelopes.where(~F.coalesce(F.col("path").isin(PATHS), F.lit(False)))
    return out


def rejection(path: str = "path", payload: str = "payload") -> Column:
    """Why an envelope has no rows in any table, NULL for one that is readable.

    ``path``: nobody knows it; ``payload``: no JSON object; ``rows``: a batched path without its row array.
    """
    known = F.coalesce(F.col(path).isin(PATHS), F.lit(False))
    tree = F.call_function("try_parse_json", F.col(payload))
    is_object = F.coalesce(F.call_function("schema_of_variant", tree).startswith("OBJECT"), F.lit(False))
    rows = F.lit(True)
    for batched, field in ROW_ARRAYS.items():
        held = F.from_json(payload, f"{field} ARRAY<STRING>")[field].isNotNull()
        rows = F.when(F.col(path) == batched, held).otherwise(rows)
    return F.when(~known, "path").when(~is_object, "payload").when(~rows, "rows")


def build_envelopes(rows: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One envelope per record, as it is queued: wire names, ISO times, NULL fields left out.

    The inverse of :func:`flatten`; columns outside the record contract are dropped unless kept.
    """
    fields = [f for f in record(table).fields if f.name in rows.columns]
    times = {f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"}
    value = lambda n: iso_millis(F.unix_millis(n)) if n in times else F.col(n)
    body = F.to_json(F.struct(*[value(f.name).alias(camel(f.name)) for f in fields]))
    path = TABLES[table]
    if path in ROW_ARRAYS:
        body = F.concat(F.lit(f'{{"{ROW_ARRAYS[path]}":['), body, F.lit("]}"))
    return rows.select(*keep, F.lit(path).alias("path"), body.alias("payload"))


def flatten(envelopes: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of one table. Batched payloads are exploded, the others are one row each."""
    path = TABLES[table]
    schema = record(table)
    rows = envelopes.where(F.col("path") == path)
    wired = wire(schema).simpleString()
    field = ROW_ARRAYS.get(path)
    if field:
        parsed = F.from_json("payload", f"struct<{field}:array<{wired}>>")[field]
        rows = rows.select(*keep, F.explode(parsed).alias("_row"))
    else:
        rows = rows.select(*keep, F.from_json("payload", wired).alias("_row"))
    return rows.select(*keep, *[F.col("_row")[camel(f.name)].alias(f.name) for f in schema.fields])
