"""Trace-context headers: lookup, W3C traceparent parsing, baggage."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry.functions.text import let, trimmed
from beaconry.settings import Settings


def header_value(headers: Column, name: str) -> Column:
    """First value under the exact name, else under the lower-case name; ``''`` when missing."""
    values = F.try_element_at(headers, F.lit(name))
    if name != name.lower():
        values = F.coalesce(values, F.try_element_at(headers, F.lit(name.lower())))
    return F.coalesce(F.get(values, F.lit(0)), F.lit(""))


def parse_traceparent(value: Column) -> Column:
    """Struct of ``trace_id``, ``span_id`` and ``sampled`` of a W3C traceparent, NULL where it does not say.

    Ids count when their length is right; ``sampled`` is bit 0 of two hex digits.
    """

    def ids(parts: Column) -> Column:
        trace, span, flags = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
        return F.when(
            F.size(parts) >= 4,
            F.struct(
                F.when(F.char_length(trace) == 32, trace).alias("trace_id"),
                F.when(F.char_length(span) == 16, span).alias("span_id"),
                F.when(flags.rlike(r"^[0-9a-fA-F]{2}\z"), F.conv(flags, 16, 10).cast("int") % 2 == 1).alias("sampled"),
            ),
        )

    return let(F.split(value, "-"), ids)


def generated_trace_id(key: Column) -> Column:
    return F.md5(key)


def generated_span_id(key: Column, kind: str = "span") -> Column:
    return F.substring(F.md5(F.concat(F.lit(f"{kind}:"), key)), 1, 16)


def traceparent(trace_id: Column, span_id: Column, sampled: Column) -> Column:
    return F.concat(
        F.lit("00-"), trace_id, F.lit("-"), span_id, F.lit("-"), F.when(sampled, F.lit("01")).otherwise(F.lit("00"))
    )


def repaired(value: Column, length: int, generated: Column) -> Column:
    """The id itself when it has the wire length, else the generated one."""
    return F.when(F.char_length(value) == length, value).otherwise(F.substring(generated, 1, length))


def vendor_baggage(trace_id: Column, request_id: Column, span_id: Column, s: Settings) -> Column:
    p = s.baggage_prefix
    return F.concat(
        F.lit(f"{p}trace_id="), trace_id, F.lit(f",{p}request_id="), request_id, F.lit(f",{p}span_id="), span_id
    )


def merged_baggage(existing: Column, vendor: Column, s: Settings) -> Column:
    """Foreign entries of the inbound baggage, then the vendor entries."""
    parts = F.transform(F.split(existing, ","), trimmed)
    kept = F.filter(parts, lambda p: (p != "") & ~F.lower(p).startswith(s.baggage_prefix.lower()))
    return F.array_join(F.concat(kept, F.array(vendor)), ",")


def has_header(headers: Column, name: str) -> Column:
    return F.coalesce(F.exists(F.map_keys(headers), lambda k: F.lower(k) == name.lower()), F.lit(False))
