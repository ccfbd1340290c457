"""Shards of bounded size by extendible hashing. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from beaconry.llm.store import materialise, shared_folder

# Bits of a routing hash, the head of an MD5 sum.
BITS = 60
# Bits that one round of the directory looks ahead.
ROUND = 8


def routing(*parts: Column) -> Column:
    """A hash of BITS bits of texts."""
    return F.conv(F.substring(F.md5(F.concat_ws("\x00", *parts)), 1, BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, depth: Column | int) -> Column:
    if isinstance(depth, int):
        return F.shiftright(h, BITS - depth)
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def directory(sizes: DataFrame, limit: int, start_bits: int) -> tuple[DataFrame, DataFrame]:
    """Buckets of ``sizes`` (h, bytes): (bits, prefix, depth, shard_bytes, shard_rows, fits).

    A bucket splits on its next bit while it is over the limit and holds more than one row. One round sums the
    rows by a prefix of so many bits, sums these up for every shorter prefix, and takes each prefix's first
    ancestor that fits; only buckets over the limit at all bits go on to the next round, with ROUND bits more. Each
    entry serves the rows whose first ``bits`` bits are ``prefix``. Second: the entries that never fit.
    """
    bits, done, open_ = min(start_bits, BITS), None, None
    while True:
        rows = sizes if open_ is None else sizes.join(open_, _prefix(F.col("h"), before) == F.col("open"), "left_semi")
        cells = materialise(rows.groupBy(_prefix(F.col("h"), bits).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "shard-cells")
        low = 0 if open_ is None else before + 1
        levels = cells.select("prefix", "bytes", "rows", F.explode(F.sequence(F.lit(low), F.lit(bits))).alias("depth"))
        levels = levels.withColumn("at", F.call_function("shiftright", F.col("prefix"), (F.lit(bits) - F.col("depth")).cast("int")))
        sums = levels.groupBy("depth", "at").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        sums = sums.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
        first = levels.select("prefix", "depth", "at").join(sums, ["depth", "at"])
        best = first.groupBy("prefix").agg(F.min(F.when(F.col("fits"), F.struct("depth", "shard_bytes", "shard_rows"))).alias("best"), F.max(F.struct("depth", "shard_bytes", "shard_rows")).alias("deepest"))
        chosen = F.coalesce("best", "deepest")
        best = materialise(best.select(F.lit(bits).alias("bits"), "prefix", chosen.getField("depth").alias("depth"), chosen.getField("shard_bytes").alias("shard_bytes"), chosen.getField("shard_rows").alias("shard_rows"), F.col("best").isNotNull().alias("fits")), "shard-directory")
        over = best.where(~F.col("fits"))
        fit = best.where(F.col("fits"))
        done = fit if done is None else done.union(fit)
        if bits == BITS or over.isEmpty():
            return done, over
        open_, before = over.select(F.col("prefix").alias("open")), bits
        bits = min(bits + ROUND, BITS)


def shard_documents(docs: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """Deal documents to shards whose text bytes stay within ``limit``.

    Adds shard (text: the bits that its rows' hashes begin with, "" for an undivided table), shard_depth, n_bytes,
    shard_bytes and shard_rows; columns of these names are replaced. Documents of one key share a hash. Where they
    alone are over the limit, their shard goes on splitting by a hash of key and text (depth above BITS); equal
    rows, which no hash parts, are numbered and cut into chained shards ("bits+n"). A single document over the limit
    is a shard of its own. A null key is an empty text, a null text has no bytes; no rows give no rows.
    """
    names = [c for c in docs.columns if c not in ("shard", "shard_depth", "n_bytes", "shard_bytes", "shard_rows")]
    keyed = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    body = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.octet_length(body).cast("long").alias("bytes"), routing(keyed).alias("h"), F.md5(body).alias("twin"), keyed.alias("key"))
    narrow = materialise(rows.select("h", "bytes", "key", "twin"), "shard-sizes")
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    start = max(0, -(-total // limit) - 1).bit_length() + 2
    fit, over = directory(narrow, limit, start)
    dealt = _assign(rows, fit, "h", F.lit(""))
    if over.isEmpty():
        return _result(dealt, names)
    # Keys over the limit on their own: the same by a second hash, of key and text.
    second = routing(F.col("key"), F.col("twin")).alias("h")
    hot = over.select(F.col("prefix").alias("hot"))
    rest = rows.join(hot, F.col("h") == F.col("hot"), "left_semi").withColumn("lead", F.lpad(F.bin("h"), BITS, "0"))
    rest = rest.withColumn("h", second)
    tails = materialise(narrow.join(hot, F.col("h") == F.col("hot"), "left_semi").select(second, "bytes", "key", "twin"), "shard-tails")
    dealt = dealt.where(F.col("depth").isNotNull())
    # Rounds start at the first bit: hot keys are few, their rows many.
    fit2, over2 = directory(tails, limit, start)
    parted = _assign(rest, fit2, "h", F.col("lead")).withColumn("depth", F.col("depth") + BITS)
    dealt = dealt.unionByName(parted.where(F.col("depth").isNotNull()))
    if not over2.isEmpty():
        same = rest.join(over2.select(F.col("prefix").alias("hot")), F.col("h") == F.col("hot"), "left_semi")
        same = _numbered(same)
        per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes"))).cast("long")
        link = F.floor((F.col("n") - 1) / per)
        chained = same.withColumn("shard", F.concat("lead", F.lpad(F.bin("h"), BITS, "0"), F.lit("+"), link.cast("string")))
        held = chained.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
        chained = chained.drop("shard_bytes", "shard_rows").join(held, "shard").withColumn("depth", F.lit(2 * BITS))
        dealt = dealt.unionByName(chained.select(dealt.columns))
    return _result(dealt, names)


def _assign(rows: DataFrame, entries: DataFrame, h: str, lead: Column) -> DataFrame:
    """Each row's bucket: one join for each number of bits that the entries have."""
    out = None
    columns = [c for c in ("row", "bytes", h, "twin", "key", "lead") if c in rows.columns]
    for (bits,) in sorted(entries.select("bits").distinct().collect()):  # at most BITS / ROUND + 1 numbers
        mine = entries.where(F.col("bits") == bits).drop("bits", "fits")
        found = rows.join(mine, _prefix(F.col(h), bits) == F.col("prefix"))
        shard = F.concat(lead, F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr(f"lpad(bin(shiftright({h}, {BITS} - depth)), depth, '0')")))
        found = found.select(*columns, "depth", "shard_bytes", "shard_rows", shard.alias("shard"))
        out = found if out is None else out.union(found)
    if out is None:
        out = rows.select(*columns, F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("shard_bytes"), F.lit(None).cast("long").alias("shard_rows"), F.lit(None).cast("string").alias("shard")).where(F.lit(False))
    return out.select("row", "bytes", "depth", "shard_bytes", "shard_rows", "shard")


def _result(dealt: DataFrame, names: list[str]) -> DataFrame:
    kept = [F.col("row").getField(c).alias(c) for c in names]
    return dealt.select(*kept, "shard", F.col("depth").alias("shard_depth"), F.col("bytes").alias("n_bytes"), "shard_bytes", "shard_rows")


def _numbered(same: DataFrame) -> DataFrame:
    """Number the rows of each h from 1 as n, however many there are.

    The rows are written once with the number that the writing task gave them, so a retried task sees the same. They
    are counted within (h, writing task), and each such group starts where those of smaller tasks end.
    """
    same = materialise(same.withColumn("at", F.monotonically_increasing_id()), "shard-equals")
    same = same.withColumn("task", F.shiftright("at", 33))
    sizes = same.groupBy("h", "task").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("h").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("h", "task", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("h", "task").orderBy("at"))
    return same.withColumn("n", within).join(starts, ["h", "task"]).withColumn("n", F.col("n") + F.col("start")).drop("at", "task", "start")


# Folder names keep the bits apart from numbers, and from the empty text of an undivided table.
_FOLDER, _SCHEMA = "shard-", "_schema"


def write_shards(sharded: DataFrame, path: str | None = None) -> str:
    """Write each shard of :func:`shard_documents` as a Parquet folder of its own, by one task; the folder of all.

    A shard fits a task by its limit. ``path`` is by default a new folder below ``spark.checkpoint.dir``.
    """
    path = path or shared_folder(sharded.sparkSession, "shards")
    named = sharded.withColumn("shard", F.concat(F.lit(_FOLDER), "shard")).drop("shard_bytes", "shard_rows")
    named.repartition("shard").write.partitionBy("shard").parquet(path)
    # A table without rows has no shard that could tell its columns.
    named.limit(0).write.parquet(f"{path}/{_SCHEMA}")
    return path


def read_shards(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The rows of written shards with n_bytes, shard_bytes and shard_rows as the files hold them.

    ``columns``: those to return beside shard and the sizes (default all). A filter on shard reads its folder only.
    """
    rows = spark.read.schema(spark.read.parquet(f"{path}/{_SCHEMA}").schema).parquet(path)
    rows = rows.withColumn("shard", F.substr("shard", F.lit(len(_FOLDER) + 1)))
    rows = rows.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    own = [c for c in rows.columns if c not in ("shard", "shard_depth", "n_bytes") and (columns is None or c in columns)]
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    return rows.select(*[F.col(f"`{c}`") for c in own], "shard", "shard_depth", "n_bytes").join(sizes, "shard").select(*[F.col(f"`{c}`") for c in own], "shard", "shard_depth", "n_bytes", "shard_bytes", "shard_rows")
