"""Redaction and scrubbing of whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from beaconry.functions import privacy
from beaconry.functions.privacy import REDACTED, Extras, camel
from beaconry.functions.text import longer_than
from beaconry.settings import Settings


def redact_keys(
    df: DataFrame, cols: Sequence[str] | None = None, extra: Extras = (), settings: Settings = Settings(), naming=str
) -> DataFrame:
    """Replace the values of sensitive keys, the columns' own names included, at any depth."""
    out = {}
    for name in cols or df.columns:
        if privacy.is_sensitive_name(naming(name), settings.vendor, extra):
            out[name] = F.when(F.col(name).isNotNull(), F.lit(REDACTED))
        else:
            out[name], _ = privacy.redact_typed(F.col(name), df.schema[name].dataType, settings.vendor, extra, naming)
    return df.withColumns(out)


def headers_to_string(headers: Column, extra: Extras = (), settings: Settings = Settings()) -> Column:
    """Sorted ``key: value`` lines, array values joined by commas, sensitive values redacted."""

    def line(e: Column) -> Column:
        value = F.array_join(F.coalesce(e["value"], F.array().cast("array<string>")), ",")
        hidden = privacy.sensitive_key(e["key"], settings.vendor, extra)
        return F.concat(e["key"], F.lit(": "), F.when(hidden, F.lit(REDACTED)).otherwise(value))

    return F.coalesce(F.array_join(F.transform(F.array_sort(F.map_entries(headers)), line), "\n"), F.lit(""))


def scrub_text(df: DataFrame, cols: Sequence[str], send_default_pii: bool = False) -> DataFrame:
    return df.withColumns({c: privacy.scrubbed(F.col(c), send_default_pii) for c in cols})


def scrub_values(df: DataFrame, cols: Sequence[str] | None = None, send_default_pii: bool = False, naming=str) -> DataFrame:
    return df.withColumns(
        {
            c: privacy.scrub_typed(
                F.col(c), df.schema[c].dataType, send_default_pii, naming, skip=naming(c).lower() in privacy.SKIP_KEYS
            )
            for c in cols or df.columns
        }
    )


def scrub_payload(df: DataFrame, send_default_pii: bool = False, settings: Settings = Settings()) -> DataFrame:
    """Last scrub of a record table before it leaves: default key redaction, then value scrubbing.

    Columns count as top-level keys under their wire names. The session id is put back, since the
    key list would hide it.
    """
    keep = isinstance(df.schema["session_id"].dataType, T.StringType) if "session_id" in df.columns else False
    source = df.withColumn("_session", F.col("session_id")) if keep else df
    names = df.columns
    out = scrub_values(redact_keys(source, names, (), settings, camel), names, send_default_pii, camel)
    return out.withColumn("session_id", F.col("_session")).drop("_session") if keep else out


def scrub_payload_json(df: DataFrame, column: str = "payload", send_default_pii: bool = False, settings: Settings = Settings()) -> DataFrame:
    """The same over JSON text of unknown shape (Arrow UDF)."""
    return df.withColumn(column, privacy.json_cleaner(settings.vendor, send_default_pii=send_default_pii)(F.col(column)))


def redact_json(df: DataFrame, column: str = "payload", extra: Extras = (), settings: Settings = Settings()) -> DataFrame:
    return df.withColumn(column, privacy.json_cleaner(settings.vendor, extra, scrub=False)(F.col(column)))


def scrub_corpus(df: DataFrame, text_col: str, send_default_pii: bool = False) -> DataFrame:
    """Scrub a text column and report, per row, whether it changed and the hits of each class.

    Hits are counted where they are replaced, on the text as the steps before left it.
    """
    text = F.col(text_col)
    skip = F.coalesce(longer_than(text, privacy.MAX_SCAN_UNITS), F.lit(True))
    out = df.withColumn("_text", text)
    hits = []
    for name, replace, count in privacy.scrub_steps(send_default_pii):
        out = out.withColumn(f"{name}_hits", F.when(skip, F.lit(0)).otherwise(count(F.col("_text"))))
        out = out.withColumn("_text", F.when(F.col(f"{name}_hits") > 0, replace(F.col("_text"))).otherwise(F.col("_text")))
        hits.append(f"{name}_hits")
    return (
        out.withColumn("changed", sum((F.col(h) for h in hits), F.lit(0)) > 0)
        .withColumn(text_col, F.col("_text"))
        .drop("_text")
    )
