"""Epoch-millisecond helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry.functions.text import non_blank

# Fixed values of the delivery contract.
RETRY_AFTER_CAP_MS = 300_000
DAY_MS = 86_400_000


def _two(c: Column, width: int = 2) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def iso_millis(ms: Column) -> Column:
    """``2024-01-31T08:15:00.123Z`` from epoch milliseconds, by arithmetic."""
    ms = ms.cast("bigint")
    days = F.floor(ms / DAY_MS).cast("int")
    rest = F.pmod(ms, F.lit(DAY_MS).cast("bigint"))
    part = lambda div, mod: _two(F.floor(rest / div) % mod)
    return F.concat(
        F.date_from_unix_date(days).cast("string"),
        F.lit("T"), part(3_600_000, 24), F.lit(":"), part(60_000, 60), F.lit(":"), part(1_000, 60),
        F.lit("."), _two(rest % 1000, 3), F.lit("Z"),
    )


def _clock_millis(date: Column, clock: Column) -> Column:
    """Epoch milliseconds of a UTC date and an ``HH:mm:ss`` text; NULL when either is out of range."""
    h, m, sec = (F.substring(clock, at, 2).cast("bigint") for at in (1, 4, 7))
    total = F.unix_date(date).cast("bigint") * DAY_MS + ((h * 60 + m) * 60 + sec) * 1000
    return F.when((h < 24) & (m < 60) & (sec < 60), total)


def retry_after_ms(header: Column, now_ms: Column) -> Column:
    """Delay asked for by a ``Retry-After`` header: seconds, IMF-fixdate or ISO date-time, capped.

    Blank, absent and unreadable values give 0.
    """
    raw = non_blank(header)
    digits = raw.rlike(r"^[0-9]+\z")
    # Past seven digits the cap applies anyway, so the cast cannot overflow.
    short = F.when(digits & (F.length(F.ltrim(raw, F.lit("0"))) <= 7), raw)
    seconds = F.coalesce(short.cast("bigint") * 1000, F.lit(RETRY_AFTER_CAP_MS))
    imf = raw.rlike(r"^[A-Za-z]{3}, \d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} GMT\z")
    iso = raw.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{3})?Z\z")
    fraction = F.coalesce(F.nullif(F.regexp_extract(raw, r"\.(\d{3})Z", 1), F.lit("")), F.lit("0"))
    when = F.when(
        imf, _clock_millis(F.try_to_date(F.substring(raw, 6, 11), "dd MMM yyyy"), F.substring(raw, 18, 8))
    ).when(iso, _clock_millis(F.try_to_date(F.substring(raw, 1, 10)), F.substring(raw, 12, 8)) + fraction.cast("bigint"))
    delay = F.when(digits, seconds).otherwise(F.greatest(when - now_ms, F.lit(0)))
    return F.coalesce(F.least(delay, F.lit(RETRY_AFTER_CAP_MS)), F.lit(0)).cast("bigint")
