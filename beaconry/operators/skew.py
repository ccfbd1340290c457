"""Ordered per-key work that stays spread out when one key holds a large share of the rows.

A plain window sends a key to one task. Here a key is cut into slices of its order: ``width`` units of the
first order column where it is a number (a sequence number, a time), or its first four characters where it is
a text. The window runs inside a slice, and what a slice needs from its neighbours comes as one extra row of the slice, from a table with one row per
(key, slice). There is one plan for every size, and building it starts no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Units of the first order column in a slice: rows for sequence numbers, milliseconds (17 minutes) for times.
WIDTH = 1_000_000
SALTS = 64
# Salts of a join whose skew the runtime can split further.
JOIN_SALTS = 4


def _sliced(df: DataFrame, order: Sequence[str], width: int) -> DataFrame:
    if isinstance(df.schema[order[0]].dataType, T.StringType):
        return df.withColumn("_slice", F.substring(order[0], 1, 4))
    return df.withColumn("_slice", F.floor(F.col(order[0]) / F.lit(width)).cast("bigint"))


def _with_extra(rows: DataFrame, extra: DataFrame, side: int) -> DataFrame:
    """Rows (``_side`` 1) together with one extra row per slice, before (0) or after (2) the others."""
    return rows.withColumn("_side", F.lit(1)).unionByName(
        extra.withColumn("_side", F.lit(side)), allowMissingColumns=True
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, out: str, width: int = WIDTH
) -> DataFrame:
    """Add the inclusive running sum of ``amount`` per key. ``order`` must be a total order."""
    parts = _sliced(df.withColumn("_amount", amount), order, width)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*keys, "_slice").agg(F.sum("_amount").alias("_total"))
    carry = (
        totals.withColumn("_amount", F.sum("_total").over(earlier))
        .where(F.col("_amount").isNotNull()).drop("_total")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("_side", *order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        _with_extra(parts, carry, 0).withColumn(out, F.sum("_amount").over(inside))
        .where(F.col("_side") == 1).drop("_amount", "_slice", "_side")
    )


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, width: int = WIDTH) -> DataFrame:
    """Add the 1-based position of each row within its key."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), out, width)


def _beside(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, width: int, ahead: bool
) -> DataFrame:
    parts = _sliced(df.withColumn("_value", value), order, width)
    pick, step, side = (F.min_by, F.lead, 2) if ahead else (F.max_by, F.lag, 0)
    edge = parts.groupBy(*keys, "_slice").agg(pick("_value", F.struct(*order)).alias("_edge"))
    carry = (
        edge.withColumn("_value", step("_edge").over(Window.partitionBy(*keys).orderBy("_slice")))
        .where(F.col("_value").isNotNull()).drop("_edge")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("_side", *order)
    return (
        _with_extra(parts, carry, side).withColumn(out, step("_value").over(inside))
        .where(F.col("_side") == 1).drop("_value", "_slice", "_side")
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, width: int = WIDTH
) -> DataFrame:
    """Add ``value`` of the row before, within the key. ``value`` must not be NULL."""
    return _beside(df, keys, order, value, out, width, False)


def with_next(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, width: int = WIDTH
) -> DataFrame:
    """Add ``value`` of the row after, within the key. ``value`` must not be NULL."""
    return _beside(df, keys, order, value, out, width, True)


def _salt(order: Sequence[str], salts: int) -> Column:
    return F.pmod(F.xxhash64(*order), F.lit(salts))


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, salts: int = SALTS) -> DataFrame:
    """Newest ``n`` rows per key by ``order`` (ascending is older).

    First per (key, salt), then per key: the last step sees at most ``salts * n`` rows of a key.
    """
    down = [F.col(c).desc() for c in order]
    spread = Window.partitionBy(*keys, "_salt").orderBy(*down)
    whole = Window.partitionBy(*keys).orderBy(*down)
    return (
        df.withColumn("_salt", _salt(order, salts))
        .withColumn("_rank", F.row_number().over(spread))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def newest_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, limit: int, salts: int = SALTS
) -> DataFrame:
    """Longest newest run per key whose total ``amount`` (not negative) stays within ``limit``.

    The first pass keeps, per (key, salt), the rows with at most ``limit`` strictly newer than them.
    That never loses a row of the answer nor the row that ends it, because a salt's newer total is
    at most the key's. The second pass then sees at most about ``salts * limit`` of a key.
    """
    down = [F.col(c).desc() for c in order]
    frame = lambda *by: Window.partitionBy(*by).orderBy(*down).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("_amount", F.coalesce(amount, F.lit(0)).cast("bigint"))
        .withColumn("_salt", _salt(order, salts))
        .withColumn("_sum", F.sum("_amount").over(frame(*keys, "_salt")))
        .where(F.col("_sum") - F.col("_amount") <= limit)
        .withColumn("_sum", F.sum("_amount").over(frame(*keys)))
        .where(F.col("_sum") <= limit)
        .drop("_amount", "_salt", "_sum")
    )


def lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str] | None = None, blank: bool = False
) -> DataFrame:
    """Left join to a table with one row per key, rows without a key never meeting in one task.

    A NULL in the first key is replaced, for the shuffle only, by a text from the row's content: of the columns
    ``spread_by``, or of all. The join condition still asks for real keys; with ``blank`` an empty text is none.
    A large real key is on the left only, so the runtime skew join can split it.
    """
    first, names = keys[0], {k: f"_right_{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    content = F.xxhash64(*(spread_by or [c for c in left.columns if _hashable(left, c)]))
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
        if blank:
            keyed = keyed & (F.col(k) != "")
    spread = F.when(keyed, F.col(first).cast("string")).otherwise(F.concat(F.lit("\x00"), content.cast("string")))
    on = keyed & (F.col("_key") == F.col(names[first]).cast("string"))
    for k in keys[1:]:
        on = on & (F.col(k) == F.col(names[k]))
    return left.withColumn("_key", spread).join(right, on, "left").drop("_key", *names.values())


def _hashable(df: DataFrame, name: str) -> bool:
    return "map" not in df.schema[name].dataType.simpleString() and "variant" not in df.schema[name].dataType.simpleString()


def match_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: Sequence[str], salts: int = JOIN_SALTS
) -> DataFrame:
    """Inner join of many rows per key to one row per key, ahead of an aggregation on the key.

    The small side is repeated per salt and the large side joins by salt. As the aggregation then needs an
    exchange of its own, behind its map-side combine, the runtime skew join may split a salt further.
    """
    each = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    right = right.withColumn("_salt", F.explode(each))
    return left.withColumn("_salt", _salt(spread_by, salts)).join(right, [*keys, "_salt"]).drop("_salt")
