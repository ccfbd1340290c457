"""Homomorphic multiset fingerprints of documents. DataFrame operations only.

A fingerprint is an array of 64-bit integers: the sums, modulo powers of two, of wide vectors hashed from the
paragraphs of a text. It does not depend on their order, and paragraphs are added or removed by adding or
subtracting their vectors. Its parts:

* the number of pieces, modulo 2^32;
* EQUAL lanes modulo 2^32, hashed from whole paragraphs: two texts with the same paragraphs have the same lanes;
* LIKE * 3 lanes modulo 2^20, three to a number, that count hash bits of the paragraphs' pieces of a few words: their
  scalar products estimate how many pieces two texts share.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

EQUAL, LIKE = 8, 21
LANE_BITS, SLOT_BITS = 20, 21
LANES = LIKE * 3
M32 = (1 << 32) - 1
ONES = sum(1 << (SLOT_BITS * i) for i in range(3))
LANE = (1 << LANE_BITS) - 1
FULL = ONES * LANE
GUARD = ONES << LANE_BITS
# A piece: words of a paragraph up to one that ends in such a character, at most LONGEST_PIECE of them. Cuts depend on
# the words alone, so an inserted or removed word changes its own piece and leaves the later ones as they are, up
# to the next cut at most. Only words that end in Latin-1 characters cut; other scripts have strides of LONGEST_PIECE.
LONGEST_PIECE = 12
_CUT = "".join(re.escape(chr(c)) for c in range(0x21, 0x100) if c % 4 == 2 and not chr(c).isspace())
PIECE = rf"(?:[^\s]*[^\s{_CUT}][^\S\n]+){{0,{LONGEST_PIECE - 1}}}[^\s]+"


def _long(n: int) -> Column:
    return F.lit(n).cast("long")


def _sum(vectors: Column, width: int, add: Callable[[Column, Column], Column]) -> Column:
    zero = F.array_repeat(_long(0), width)
    return F.aggregate(vectors, zero, lambda acc, v: F.zip_with(acc, v, add))


def _add32(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(_long(M32))


def _add20(a: Column, b: Column) -> Column:
    """Three lanes at once: the guard bit above each takes the carry and is cleared."""
    return (a + b).bitwiseAND(_long(FULL))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (null: empty). Paragraphs are parted at line feeds."""
    text = F.coalesce(text, F.lit(""))

    def whole(paragraph: Column) -> Column:
        hashes = [F.xxhash64(_long(i), paragraph) for i in range(EQUAL // 2)]
        return F.array(*[x for h in hashes for x in (h.bitwiseAND(_long(M32)), F.shiftrightunsigned(h, 32))])

    def bits(piece: Column) -> Column:
        h = F.xxhash64(piece)
        return F.array(*[F.shiftrightunsigned(h, i).bitwiseAND(_long(ONES)) for i in range(LIKE)])

    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    equal = _sum(F.transform(F.split(text, "\n", -1), whole), EQUAL, _add32)
    like = _sum(F.transform(pieces, bits), LIKE, _add20)
    return F.concat(F.array(F.size(pieces).cast("long")), equal, like)


def combine(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of both."""
    heads = F.zip_with(F.slice(a, 1, 1 + EQUAL), F.slice(b, 1, 1 + EQUAL), _add32)
    return F.concat(heads, F.zip_with(F.slice(a, 2 + EQUAL, LIKE), F.slice(b, 2 + EQUAL, LIKE), _add20))


def remove(a: Column, b: Column) -> Column:
    """The fingerprint of the paragraphs of ``a`` without those of ``b``."""
    heads = F.zip_with(F.slice(a, 1, 1 + EQUAL), F.slice(b, 1, 1 + EQUAL), lambda x, y: (x - y).bitwiseAND(_long(M32)))
    less = lambda x, y: (x.bitwiseOR(_long(GUARD)) - y).bitwiseAND(_long(FULL))
    return F.concat(heads, F.zip_with(F.slice(a, 2 + EQUAL, LIKE), F.slice(b, 2 + EQUAL, LIKE), less))


def _signed(fp: Column) -> Column:
    """Lanes as sums of signs: twice the count of ones less the number of pieces, in the ring modulo 2^20."""
    n = fp.getItem(0)
    lanes = F.flatten(F.transform(F.slice(fp, 2 + EQUAL, LIKE), lambda x: F.array(*[F.shiftrightunsigned(x, SLOT_BITS * i).bitwiseAND(_long(LANE)) for i in range(3)])))
    half = 1 << (LANE_BITS - 1)
    # (2c - n + half) mod 2^20 - half: right as long as the signed sum itself is below half, however large the counts.
    return F.transform(lanes, lambda c: ((c * 2 - n + half).bitwiseAND(_long(LANE)) - half).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the estimated shared pieces as a part of the mean number of pieces; 1 for equal fingerprints."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    x, y = _signed(a), _signed(b)
    both, norm = total(F.zip_with(x, y, lambda p, q: p * q)), total(F.zip_with(x, y, lambda p, q: p * p + q * q))
    share = F.when(norm > 0, both * 2 / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)))


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, F.hex), "-")


def _slice_of(key: Column, cuts: list[float], low: int, high: int) -> Column:
    """How many cuts are below the key, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key <= cuts[middle], _slice_of(key, cuts, low, middle)).otherwise(_slice_of(key, cuts, middle + 1, high))


def with_next(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Each (doc_id, text) with its fingerprint and, as next_text and next_fingerprint, the document after it in
    descending doc_id; the first one comes after the last.

    Rows are dealt to slices of neighbouring ids, so the texts are shuffled once and no task holds them all. The
    cuts between slices are numbers from an approximate quantile, as many as shuffle partitions, and fixed in the
    plan, so a retried task deals alike. The last row of a slice gets the first of the next from a table of one
    row per slice. A null doc_id is last; rows of equal doc_id are ordered by their texts' hash.
    """
    spark = docs.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.col("doc_id").cast("double")
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(docs.select(key.alias("k")).approxQuantile("k", shares, 0.2 / slices))) if shares else []
    # Slice 0 has the largest ids.
    number = F.when(key.isNull(), len(cuts) + 1).otherwise(len(cuts) - _slice_of(key, cuts, 0, len(cuts)))
    rows = docs.select(number.alias("slice"), "doc_id", F.xxhash64("text").alias("tie"), "text", fingerprint(F.col("text")).alias("fingerprint"))
    order = F.struct(F.coalesce("doc_id", _long(-(1 << 63))), "tie")
    firsts = docs.select(number.alias("slice"), "doc_id", F.xxhash64("text").alias("tie")).groupBy("slice").agg(F.max(order).alias("first"))
    along = Window.orderBy("slice")  # one small row per slice
    after = firsts.select("slice", F.coalesce(F.lead("first").over(along), F.first("first").over(along)).alias("first"))
    # first() over a growing frame is the first of all: the end of the circle.
    after = after.select("slice", F.col("first").getField("tie").alias("first_tie"), F.col("first").getField("col1").alias("first_id"))
    heads = (
        rows.select("doc_id", "tie", "text", "fingerprint")
        .join(F.broadcast(after.withColumnRenamed("slice", "of")), (F.coalesce("doc_id", _long(-(1 << 63))) == F.col("first_id")) & (F.col("tie") == F.col("first_tie")))
        .groupBy("of").agg(F.first(F.struct("text", "fingerprint")).alias("head"))
    )
    within = Window.partitionBy("slice").orderBy(F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    rows = rows.withColumn("next", F.lead(F.struct("text", "fingerprint")).over(within))
    joined = rows.join(heads, (F.col("slice") == F.col("of")) & F.col("next").isNull(), "left")
    follow = F.coalesce("next", "head")
    return joined.select("doc_id", "text", "fingerprint", follow.getField("text").alias("next_text"), follow.getField("fingerprint").alias("next_fingerprint"))


def edited(text: Column, other: Column) -> Column:
    """The text whose last third (rounded down, in code points) is replaced by as many of the other's first, or all."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - third), F.substring(other, F.lit(1), third))


def compare_documents(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Fingerprint every whole text (null: empty), its edited text and its neighbour.

    Returns doc_id, n_chars, edited, fingerprint, edited_fingerprint (arrays), near_edited, near_next. Empty texts
    are equal to each other. Extra columns are ignored; no rows give no rows; a single row is its own neighbour.
    """
    rows = with_next(docs, slices).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "edited", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
