"""Map helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry.functions.text import let

EMPTY = "CAST(map() AS MAP<STRING,STRING>)"


def empty_map() -> Column:
    return F.expr(EMPTY)


def overlay(base: Column, over: Column) -> Column:
    """Both maps, the second winning per key. A NULL map counts as empty."""
    base = F.coalesce(base, empty_map())
    return let(
        F.coalesce(over, empty_map()),
        lambda o: F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(o, k)), o),
    )


def without_nulls(m: Column) -> Column:
    return F.map_filter(m, lambda _, v: v.isNotNull())


def prefixed(m: Column, prefix: str) -> Column:
    return F.transform_keys(F.coalesce(m, empty_map()), lambda k, _: F.concat(F.lit(prefix), k))
