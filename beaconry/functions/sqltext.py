"""SQL text fingerprinting: normalized text, stable hash and leading verb."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry.functions.text import AFTER_WORD, BEFORE_DIGIT, SPACE, let, trimmed

# The masking steps in the order they apply, as (pattern, replacement, needle). The
# needle is a text every match contains; rows without it skip the pattern.
MASKS = [
    (r"/\*[\s\S]*?\*/", " ", "/*"),
    (r"--[^\n]*", " ", "--"),
    # Possessive forms run without recursion. The second closes an unclosed text at its last doubled quote.
    (r"'[^']*+(?:''[^']*+)*+'|'(?:[^']*+''(?=[^']*+''))*+[^']*+'", "?", "'"),
    (r"\$[a-zA-Z0-9_]*\$[\s\S]*?\$[a-zA-Z0-9_]*\$", "?", "$"),
    (BEFORE_DIGIT + r"\d+(?:\.\d+)?" + AFTER_WORD, "?", ""),
    # A single plain space already is what it would become.
    (f"{SPACE}{{2,}}|[{SPACE}&&[^ ]]", " ", ""),
]

# The verbs with a type of their own.
VERBS = ["SELECT", "INSERT", "UPDATE", "DELETE", "BEGIN", "COMMIT", "ROLLBACK"]


def normalized_sql(sql: Column) -> Column:
    """Comments and literals masked, whitespace collapsed. Double-quoted identifiers are kept."""
    out = F.coalesce(sql, F.lit(""))
    for pattern, replacement, needle in MASKS:
        out = _masked(out, pattern, replacement, needle)
    return trimmed(out)


def _masked(c: Column, pattern: str, replacement: str, needle: str) -> Column:
    if not needle:
        return F.regexp_replace(c, pattern, replacement)
    return let(c, lambda x: F.when(F.contains(x, F.lit(needle)), F.regexp_replace(x, pattern, replacement)).otherwise(x))


def text_hash(text: Column) -> Column:
    """``h = 31 h + unit`` over UTF-16 units in 32-bit arithmetic, absolute value in base 36.

    An ``aggregate`` over the characters: its cost grows with the text, so callers that group by
    the text hash after grouping.
    """
    mask = F.lit(0xFFFFFFFF).cast("bigint")

    def unit(h: Column, value: Column) -> Column:
        return (h * 31 + value).bitwiseAND(mask)

    def plain(h: Column, ch: Column) -> Column:
        return unit(h, F.ascii(ch))

    def astral(h: Column, ch: Column) -> Column:
        point = F.ascii(ch)
        high = F.lit(0xD800) + F.shiftright(point - 0x10000, 10)
        low = F.lit(0xDC00) + (point - 0x10000) % 1024
        return F.when(point < 0x10000, unit(h, point)).otherwise(unit(unit(h, high), low))

    def fold(t: Column) -> Column:
        start = F.lit(0).cast("bigint")
        chars = F.split(t, "")
        h = F.when(t.rlike(r"[\x{10000}-\x{10FFFF}]"), F.aggregate(chars, start, astral)).otherwise(
            F.aggregate(chars, start, plain)
        )
        return F.when(t == "", start).otherwise(h)

    signed = let(let(text, fold), lambda h: F.when(h >= 0x80000000, F.lit(0x100000000) - h).otherwise(h))
    return F.lower(F.conv(signed.cast("string"), 10, 36))


def statement_type(sql: Column) -> Column:
    """Leading verb of the raw statement, or ``OTHER``."""
    first = F.upper(F.regexp_extract(sql, f"^{SPACE}*+([^{SPACE[1:-1]}]+)", 1))
    return let(first, lambda v: F.when(v.isin(VERBS), v).otherwise(F.lit("OTHER")))
