"""String helpers with the string model of the telemetry wire format (UTF-16 units, wide whitespace)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The whitespace class of the wire format, which is wider than Java's ``\s``.
SPACE = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"

# ASCII word edge. Java's ``\b`` also treats accented letters as word characters. Next to a pattern
# that starts (ends) with a word character the edge is plainly BEFORE_WORD (AFTER_WORD).
EDGE = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
BEFORE_WORD = r"(?<!\w)"
# The same ahead of a digit, with the cheap test first: most positions of a text hold no digit.
BEFORE_DIGIT = r"(?=[0-9])(?<!\w)"
AFTER_WORD = r"(?!\w)"


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(c), body), F.lit(0))


# The characters of SPACE, for the functions that take a set of characters.
SPACE_CHARS = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(c: Column) -> Column:
    """Strip every leading and trailing whitespace character of :data:`SPACE`."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def non_blank(c: Column) -> Column:
    """The trimmed text, or NULL when nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def utf16_length(c: Column) -> Column:
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def longer_than(c: Column, units: int) -> Column:
    """True when ``c`` has more than ``units`` UTF-16 units; encodes only the borderline rows."""
    chars = F.char_length(c)
    return F.when(chars > units, True).when(chars * 2 <= units, False).otherwise(utf16_length(c) > units)


def utf16_prefix(c: Column, units: int) -> Column:
    """First ``units`` UTF-16 units. A surrogate pair cut in half is left out, as UTF-8 cannot hold it."""
    raw = F.encode(c, "UTF-16BE")
    last = F.hex(F.substring(raw, 2 * units - 1, 1))
    keep = F.when(last.between("D8", "DB"), 2 * units - 2).otherwise(2 * units)
    cut = F.decode(raw.substr(F.lit(1), keep), "UTF-16BE")
    return F.when(longer_than(c, units), cut).otherwise(c)


def unit_interval(*parts: Column) -> Column:
    """Deterministic value in [0, 1) from the md5 of the concatenated parts."""
    head = F.substring(F.md5(F.concat(*parts)), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)
