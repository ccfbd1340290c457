"""Line deduplication against levelled sorted runs of line hashes. DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from beaconry.functions.text import let
from beaconry.llm.store import materialise

# What a line key is stripped of, and the letters it lower-cases.
STRIPPED = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A null doc_id counts as this smallest id.
SMALLEST = -(1 << 63)


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, A-Z lower-cased.

    The quick ``lower`` says the same unless the line has a letter beyond ASCII that case may change.
    """
    bare = F.btrim(line, F.lit(STRIPPED))
    return F.when(bare.rlike(r"[^\x00-\x7F\p{Ll}\p{Lo}\p{P}]"), F.translate(bare, UPPER, LOWER)).otherwise(F.lower(bare))


class LineRuns:
    """An index of line hashes (h1, h2) with the document that owns each, as runs on levels.

    A run is a table bucketed and sorted by its hash, so anti-joining it to a batch moves only the batch. Runs are
    disjoint: a batch adds what no run holds. When a level has ``fanout`` runs, they become one run of the level
    above, so a hash is rewritten once per level and a batch meets at most ``fanout - 1`` runs of each.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self.made = 0

    def write(self, run: DataFrame) -> str:
        name = f"{self.name}_{self.made}"
        self.made += 1
        dealt = run.select("h1", "h2", "owner").repartition(self.buckets, "h1", "h2")
        dealt.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        return name

    def unseen(self, owners: DataFrame) -> DataFrame:
        for level in self.levels:
            for name in level:
                owners = owners.join(self.spark.table(name).hint("merge"), ["h1", "h2"], "left_anti")
        return owners

    def add(self, owners: DataFrame) -> DataFrame:
        """Add the hashes that no run holds; the new run."""
        name = self.write(self.unseen(owners))
        self.levels[0].append(name)
        return self.spark.table(name)

    def compact(self) -> None:
        at = 0
        while at < len(self.levels) and len(self.levels[at]) >= self.fanout:
            runs = self.levels[at]
            merged = self.spark.table(runs[0])
            for name in runs[1:]:
                merged = merged.union(self.spark.table(name))
            if at + 1 == len(self.levels):
                self.levels.append([])
            self.levels[at + 1].append(self.write(merged))
            self.drop(runs)
            self.levels[at] = []
            at += 1

    def drop(self, names: list[str] | None = None) -> None:
        for name in [n for level in self.levels for n in level] if names is None else names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _cuts(docs: DataFrame, batches: int) -> list[float]:
    """Where ascending doc_ids are parted into batches of about equal numbers of documents."""
    shares = [i / batches for i in range(1, batches)]
    ids = docs.select(F.col("row.doc_id").cast("double").alias("id"))
    return sorted(set(ids.approxQuantile("id", shares, 0.2 / batches))) if shares else []


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2, report: bool = False) -> DataFrame:
    """Drop the lines that an earlier document holds already.

    Lines are parted at line feeds. Lines whose key (``line_key``) has at least ``min_chars`` code points and stands
    in several documents are dropped from all of them but that of the smallest doc_id, which keeps all its copies.
    The documents are taken in ``batches`` of ascending doc_id; each batch asks the runs of ``LineRuns`` for the
    hashes of earlier batches and adds its own. Keys are compared by 128-bit hashes.

    Returns the columns of ``docs`` with the lines that stay in text; ``report`` adds n_lines (before) and
    n_dropped, which replace columns of these names. A null text stays null and is one line; a null doc_id is
    smaller than every other; rows of equal doc_id are one document to each other, so none takes lines from the
    other; a document may lose all its lines and stays with an empty text. No rows give no rows.

    Only hashes, ids and line numbers are shuffled to find what goes, a hot line as one row per task; the texts are
    shuffled once, by document.
    """
    spark, names = docs.sparkSession, docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    packed = packed.withColumns({
        "doc": F.coalesce(F.col("row.doc_id").cast("long"), F.lit(SMALLEST)),
        "body": F.coalesce("row.text", F.lit("")),
    }).withColumn("twin", F.xxhash64("body"))
    batch = F.lit(0)
    for cut in _cuts(packed, batches):
        batch = batch + (F.col("doc").cast("double") > F.lit(cut)).cast("int")
    lines = packed.select("doc", "twin", batch.alias("batch"), F.posexplode(F.split("body", "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_chars)
    hashed = keyed.select("batch", "doc", "twin", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))
    hashed = materialise(hashed, "line-hashes")
    runs = LineRuns(spark, fanout)
    dropped = None
    try:
        for i in range(batches):
            mine = hashed.where(F.col("batch") == i)
            if i:
                runs.compact()
            run = runs.add(mine.groupBy("h1", "h2").agg(F.min("doc").alias("owner")))
            # A line stays where its document owns the key. Joining on both keeps a hot key spread over its documents.
            lost = mine.join(run.withColumnRenamed("owner", "doc"), ["h1", "h2", "doc"], "left_anti").select("doc", "twin", "pos")
            lost = materialise(lost, "lost-lines")
            dropped = lost if dropped is None else dropped.union(lost)
    finally:
        runs.drop()
    gone = dropped.groupBy("doc", "twin").agg(F.collect_set("pos").alias("gone"))
    split = F.split("body", "\n", -1)

    def rest(parts: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")

    # The text is split once, however many of its lines stay.
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(let(split, rest))
    out = [(text if c == "text" else F.col("row").getField(c)).alias(c) for c in names if not (report and c in ("n_lines", "n_dropped"))]
    if report:
        out += [F.size(split).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")]
    return packed.join(gone, ["doc", "twin"], "left").select(*out)
