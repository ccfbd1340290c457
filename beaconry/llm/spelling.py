"""Spelling variants: words of a corpus that differ by one letter, found by asymmetric chunks, and their likely forms.

Of two words at distance one the shorter (of equally long ones the first) gives two disjoint chunks, its halves. The
other gives its grams of a half's length with their places. One edit leaves one of the halves whole, and that half
stands in the other word at its own place, or one further on behind an inserted letter. So the two meet on (length of
the shorter, place, chunk), and what the chunk leaves over is verified. Grams that stand where no half can meet them
within a shift of one are not written, which leaves a head and a tail for each of the two lengths the shorter word
may have. DataFrame operations only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from beaconry.llm.store import materialise

# Letters of a word once A-Z are lower-cased.
LETTERS = "[a-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A key with more pairs of rows than this goes on by the halves of what its chunk leaves over.
MOST_PAIRS = 1 << 14


def misspelt(doc_id: Column, run: Column) -> Column:
    """The run without one code point if 31 divides crc32 of ``doc_id:run``: that at crc32 modulo its length."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, least_chars: int = 7, least_count: int = 2, misspell: bool = False) -> DataFrame:
    """Words of all whole texts and how often they occur: (word, n).

    Words are the longest runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least ``least_chars`` code
    points and with at least ``least_count`` occurrences. A null text has none. ``misspell`` drops letters on
    purpose (:func:`misspelt`; a null doc_id is an empty text there). Each task counts before words are shuffled.
    """
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"{LETTERS}{{{least_chars},}}"), F.lit(0))
    words = docs.select("doc_id", F.explode(runs).alias("word"))
    if misspell:
        words = words.select(misspelt(F.col("doc_id"), F.col("word")).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _signs(rows: DataFrame) -> DataFrame:
    """Two signs of each row: the key under which it may meet others by the head or tail of its rest.

    Rows: ctx, word, n, ``chunk`` (it gives chunks, not grams), ``size`` (length of the rest that gives chunks, which
    the one that gives grams equals or exceeds by one) and ``rest``. What the sign leaves of the rest is the new rest.
    """
    rest, size = F.col("rest"), F.col("size")
    head = F.floor(size / 2).cast("int")
    tail = size - head
    beyond = F.length(rest) - tail
    ways = []
    for place, gram, left, shorter in (("head", F.substr(rest, F.lit(1), head), F.substr(rest, head + 1), tail), ("tail", F.substr(rest, beyond + 1), F.substr(rest, F.lit(1), beyond), head)):
        key = F.struct("ctx", "size", F.lit(place).alias("place"), gram.alias("gram"))
        ways.append(F.struct(
            F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")).alias("ctx"),
            F.lit(place).alias("place"), shorter.alias("size"), left.alias("rest"),
        ))
    return rows.select("word", "n", "chunk", F.explode(F.array(*ways)).alias("sign")).select("word", "n", "chunk", "sign.*")


def _met(signs: DataFrame) -> DataFrame:
    """Pairs under a common key whose rests differ by one edit."""
    named = lambda rows, side: rows.select("ctx", *[F.col(c).alias(f"{c}_{side}") for c in ("place", "word", "n", "rest")])
    both = named(signs.where("chunk"), "a").join(named(signs.where("NOT chunk"), "b"), "ctx")
    # Equally long words meet in both roles, and a pair whose heads are equal has met by them, not only by its tails.
    once = (F.length("rest_a") < F.length("rest_b")) | (F.col("word_a") < F.col("word_b"))
    first = (F.col("place_a") == "head") | ~F.startswith("rest_b", "rest_a")
    return both.where(once & first & (F.levenshtein("rest_a", "rest_b", 1) == 1)).select("word_a", "n_a", "word_b", "n_b")


def near_pairs(words: DataFrame, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Each pair of words (word, n) at distance one, once: word_a, n_a, word_b, n_b.

    A chunk that many words share is a hot key. Words under a key of more than ``most_pairs`` pairs don't meet there:
    what the chunk leaves over is halved again, with the key as its context, until keys are small or one letter is
    left, when a key has no more rows than there are letters and pairs of letters. All pairs are found whatever
    ``most_pairs`` is. Keys are compared by 128-bit hashes.
    """
    roles = F.array(*[F.struct(F.lit(chunk).alias("chunk"), (F.length("word") - less).alias("size")) for chunk, less in ((True, 0), (False, 0), (False, 1))])
    top = F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    rows = words.select(top.alias("ctx"), "word", "n", F.explode(roles).alias("role"), F.col("word").alias("rest")).select("ctx", "word", "n", "rest", "role.*")
    found = []
    while True:
        signs = materialise(_signs(rows.where("size > 0")), "spelling-signs")
        sizes = signs.groupBy("ctx").agg(F.count_if("chunk").alias("a"), F.count_if(~F.col("chunk")).alias("b"), F.max("size").alias("size"))
        hot = materialise(sizes.where((F.col("a") * F.col("b") > most_pairs) & (F.col("size") > 1)).select("ctx"), "spelling-hot")
        if hot.isEmpty():
            found.append(_met(signs))
            break
        found.append(_met(signs.join(hot, "ctx", "left_anti")))
        rows = signs.join(hot, "ctx", "left_semi").drop("place")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    # Below a hot key a pair may meet by its tails as well.
    return pairs if len(found) == 1 else pairs.dropDuplicates(["word_a", "word_b"])


def variants(words: DataFrame, ratio: int = 10, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Each word (word, n) with its form, root and near words: word, form, root, n, n_near, form_n.

    The form is the near word of largest n (ties: the smallest in code-point order) if that n is at least ``ratio``
    times the word's. The root is where following forms ends, the word itself without a form; as n grows by the ratio
    with each step, the logarithm of the largest n bounds the steps, which are taken by doubling. No words give no rows.
    """
    pairs = near_pairs(words, most_pairs)
    ways = pairs.select("word_a", "n_a", "word_b", "n_b").union(pairs.select("word_b", "n_b", "word_a", "n_a")).toDF("word", "n", "near", "near_n")
    top = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    best = ways.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), top.alias("top"))
    likely = -F.col("top.less") >= F.lit(ratio) * F.col("n")
    best = materialise(best.select("word", "n_near", F.when(likely, F.col("top.near")).alias("form"), F.when(likely, -F.col("top.less")).alias("form_n")), "spelling-forms")

    up = best.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    steps = math.floor(math.log(max(most, 1), max(ratio, 2)) + 1e-9)
    for _ in range(math.ceil(math.log2(max(steps, 1)))):
        then = up.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        up = materialise(up.join(then, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "spelling-roots")
    joined = words.join(best, "word", "left").join(up, "word", "left")
    zero = F.lit(0).cast("long")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", zero).alias("n_near"), "form_n")
