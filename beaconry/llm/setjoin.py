"""N-gram Jaccard join by chosen paths: split sets on sampled shared tokens, compare small buckets, repeat."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from beaconry.llm.store import materialise
from beaconry.llm.words import shingle_sets, text_slices

# Tokens that are sampled from a set: its smallest under each of so many hash functions.
SAMPLES = 64
_RNG = np.random.default_rng(20240501)
_A = _RNG.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


@dataclass(frozen=True)
class ChosenPath:
    """``branches`` tokens are tried at each of ``depth`` levels; buckets of at most ``small`` sets are not split.

    A pair of sets of similarity s meets on at least one path of a run with the chance
    q(l) = 1 - (1 - s q(l - 1))^branches, q(0) = 1, at level l; ``runs`` makes the chance of never meeting at the
    deepest level less than 1 - ``recall`` for a pair of exactly the threshold. What is too large at the deepest
    level is compared in blocks, so no bucket is ever left out.
    """

    threshold: float = 0.8
    recall: float = 0.9999
    depth: int = 2
    branches: int = 2
    small: int = 512
    words: int = 5

    @property
    def runs(self) -> int:
        q = 1.0
        for _ in range(self.depth):
            q = 1 - (1 - self.threshold * q) ** self.branches
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - q)))

    @property
    def least_shared(self) -> int:
        """Sampled tokens that a pair must share to be compared exactly: four deviations below the expected number."""
        t = self.threshold
        return max(1, math.floor(SAMPLES * t - 4 * math.sqrt(SAMPLES * t * (1 - t))))


def sampled(sets: list[np.ndarray]) -> np.ndarray:
    """A row of SAMPLES 32-bit tokens for each non-empty set."""
    out = np.empty((len(sets), SAMPLES), dtype=np.uint32)
    if not sets:
        return out
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    tokens = np.concatenate(sets)
    for i in range(SAMPLES):
        hashed = ((tokens * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32)
        out[:, i] = np.minimum.reduceat(hashed, starts)
    return out


def set_keys(sets: list[np.ndarray], texts: list[str | None]) -> np.ndarray:
    """128 bits as two integers that equal sets share; for texts without words, equal texts."""
    data = [s.tobytes() if len(s) else b"\x00" + (t or "").encode("utf-8", "replace") for s, t in zip(sets, texts, strict=True)]
    halves = [divmod(xxhash.xxh3_128_intdigest(x), 1 << 64) for x in data]
    return np.array(halves, dtype=np.uint64).reshape(-1, 2).view(np.int64)


def describe(docs: DataFrame, words: int) -> DataFrame:
    """row, doc, k1, k2 (the set's key), n (its size), tokens (sampled, null for an empty set) of each (row, doc, text)."""
    schema = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())])

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = batch.column("text").to_pylist()
            sets = shingle_sets(texts, words)
            keys = set_keys(sets, texts)
            tokens = iter(sampled([s for s in sets if len(s)]))
            blobs = [next(tokens).tobytes() if len(s) else None for s in sets]
            columns = [batch.column("row"), batch.column("doc"), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array([len(s) for s in sets], pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return docs.mapInArrow(described, "row long, doc long, k1 long, k2 long, n long, tokens binary")


def _token(at: Column) -> Column:
    """One of the sampled tokens of a row."""
    return F.substring("tokens", (at * 4 + 1).cast("int"), F.lit(4))


def buckets(reps: DataFrame, plan: ChosenPath) -> DataFrame:
    """(bucket, rep): the final buckets of all runs that hold several sets.

    At each level every bucket over the small size is split: a hash of its path picks ``branches`` of the sampled
    positions, the same for all of its sets, and each set goes on to one bucket per position, named by its token
    there. The first level splits the whole table once per run.
    """
    positions = lambda path, level: [F.pmod(F.xxhash64(path, F.lit(level)) + F.lit(b), F.lit(SAMPLES)) for b in range(plan.branches)]
    # The first level of the runs takes positions of its own for each run.
    first = F.array(*[F.lit((r * plan.branches + b) % SAMPLES) for r in range(plan.runs) for b in range(plan.branches)])
    rows = reps.select("rep", "tokens", F.posexplode(first).alias("place", "at"))
    run = F.floor(F.col("place") / plan.branches)
    rows = rows.select("rep", F.xxhash64(run, "at", _token(F.col("at"))).alias("bucket"))
    final = None
    for level in range(1, plan.depth + 1):
        rows = materialise(rows, "paths")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        sized = rows.join(sizes, "bucket")
        ready = sized if level == plan.depth else sized.where(F.col("size") <= plan.small)
        ready = ready.select("bucket", "rep")
        final = ready if final is None else final.union(ready)
        if level < plan.depth:
            large = sized.where(F.col("size") > plan.small).select("bucket", "rep").join(reps.select("rep", "tokens"), "rep")
            split = large.select("rep", "tokens", "bucket", F.explode(F.array(*positions(F.col("bucket"), level))).alias("at"))
            rows = split.select("rep", F.xxhash64("bucket", "at", _token(F.col("at"))).alias("bucket"))
    return materialise(final, "buckets")


def _blocks(members: DataFrame, small: int) -> DataFrame:
    """Deal the members of each bucket to pairs of blocks of about ``small`` sets: task (bucket, a, b), side 0 or 1.

    A bucket of one block is one task. A set of a larger bucket goes to one task per block, so that any two sets
    meet in one task; a task never holds more than two blocks.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    dealt = members.join(sizes, "bucket").withColumn("n", F.ceil(F.col("size") / small).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return dealt.select("bucket", "rep", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own").drop("size", "n")


def _pairs_left(tokens: np.ndarray, sizes: np.ndarray, side_a: np.ndarray, side_b: np.ndarray, same: bool, plan: ChosenPath) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one of each side; i < j within one block) that share enough sampled tokens and could be similar by size."""
    left, right = [], []
    for x, i in enumerate(side_a):
        others = side_b[x + 1 :] if same else side_b
        if not len(others):
            continue
        n, m = sizes[i], sizes[others]
        fits = np.minimum(n, m) >= plan.threshold * np.maximum(n, m)
        others = others[fits]
        shared = (tokens[others] == tokens[i]).sum(axis=1)
        others = others[shared >= plan.least_shared]
        left.append(np.full(len(others), i))
        right.append(others)
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _met_before(left: np.ndarray, right: np.ndarray, bucket: int, lists: list[list[int]]) -> np.ndarray:
    """Has a pair a common bucket that comes before this one? It is then counted there."""
    places: dict[int, list[int]] = {}
    for i, own in enumerate(lists):
        for b in own:
            if b < bucket:
                places.setdefault(b, []).append(i)
    shared = [p for p in places.values() if len(p) > 1]
    if not shared or not len(left):
        return np.zeros(len(left), dtype=bool)
    member = np.zeros((len(lists), len(shared)), dtype=np.float32)
    for column, p in enumerate(shared):
        member[p, column] = 1
    met = np.zeros(len(left), dtype=bool)
    for i in range(0, len(left), 1 << 14):
        span = slice(i, i + (1 << 14))
        for c in range(0, len(shared), 256):
            met[span] |= (member[left[span], c : c + 256] * member[right[span], c : c + 256]).any(axis=1)
    return met


class _Task:
    """The sets of one task (bucket, a, b), each once."""

    def __init__(self, columns: dict[str, list]):
        self.bucket, self.a, self.b = columns["bucket"][0], columns["a"][0], columns["b"][0]
        once = list(dict(zip(columns["rep"], range(len(columns["rep"])), strict=True)).values())
        self.columns = columns if len(once) == len(columns["rep"]) else {k: [v[i] for i in once] for k, v in columns.items()}
        self.rep, self.own, self.n = (np.array(self.columns[c], dtype=np.int64) for c in ("rep", "own", "n"))
        self.tokens = np.frombuffer(b"".join(self.columns["tokens"]), dtype=np.uint32).reshape(-1, SAMPLES)

    def pairs(self, plan: ChosenPath) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that this task has to compare exactly."""
        left, right = _pairs_left(self.tokens, self.n, np.flatnonzero(self.own == self.a), np.flatnonzero(self.own == self.b), self.a == self.b, plan)
        fresh = ~_met_before(left, right, self.bucket, self.columns["lists"])
        return left[fresh], right[fresh]


def _in_tasks(batches: Iterable[pa.RecordBatch]) -> Iterator[_Task]:
    """Rows sorted by (bucket, a, b), as one task after the other."""
    held: dict[str, list] = {}
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        held = {k: held.get(k, []) + v for k, v in columns.items()}
        keys = np.array([held["bucket"], held["a"], held["b"]], dtype=np.int64)
        cuts = (np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()
        for start, end in zip([0, *cuts], cuts, strict=False):
            yield _Task({k: v[start:end] for k, v in held.items()})
        if cuts:
            held = {k: v[cuts[-1] :] for k, v in held.items()}
    if held.get("rep"):
        yield _Task(held)


def _together(rows: DataFrame) -> DataFrame:
    """The rows of a task follow each other in one partition."""
    return rows.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")


def _candidates(members: DataFrame, known: DataFrame, plan: ChosenPath) -> DataFrame:
    """(bucket, a, b, own, rep): the sets of each task that have a pair to be compared exactly there, and nowhere before.

    ``known`` has each set's rep, lists (of all its buckets), tokens and n.
    """
    dealt = _blocks(members, plan.small).join(known.select("rep", "lists", "tokens", "n"), "rep")
    schema = pa.schema([("bucket", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("own", pa.int32()), ("rep", pa.int64())])

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for task in _in_tasks(batches):
            for i in np.unique(np.concatenate(task.pairs(plan))):
                rows.append((task.bucket, task.a, task.b, int(task.own[i]), int(task.rep[i])))
            if len(rows) > 5_000:
                yield _batch(rows, schema)
        yield _batch(rows, schema)

    return _together(dealt).mapInArrow(compared, "bucket long, a int, b int, own int, rep long")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    rows.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets. Many pairs of few sets go through products of 0/1 matrices."""
    if len(left) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right, strict=True)], dtype=np.int64)
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    # Hashes are evenly spread, so ranges of them part the work evenly; each holds about a million at most.
    parts = 1 + sum(map(len, sets)) // 1_000_000
    for part in range(parts):
        edges = np.array([(part << 64) // parts, min(((part + 1) << 64) // parts, (1 << 64) - 1)], dtype=np.uint64)
        spans = [s[slice(*np.searchsorted(s, edges, side="left" if part + 1 < parts else "right"))] if parts > 1 else s for s in sets]
        _, place, counts = np.unique(np.concatenate(spans), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in spans])
        # A token of one set alone is in no intersection.
        number, shared = np.cumsum(counts > 1) - 1, counts[place] > 1
        row, place = row[shared], number[place[shared]]
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
            a, b = np.searchsorted(place, [low, low + 4096])
            held = np.zeros((len(sets), 4096), dtype=np.float32)
            held[row[a:b], place[a:b] - low] = 1
            total += held @ held.T
    return total[left, right].astype(np.int64)


def _links(tasks: DataFrame, plan: ChosenPath) -> DataFrame:
    """Exact comparison: (rep, to, links, copies) - per task and set its number of similar sets, the number of
    documents that have these, and the smallest set of its connected group in the task."""
    schema = pa.schema([("rep", pa.int64()), ("to", pa.int64()), ("links", pa.int64()), ("copies", pa.int64())])

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for task in _in_tasks(batches):
            left, right = task.pairs(plan)
            held = [np.frombuffer(x, dtype="<u8") for x in task.columns["shingles"]]
            both = intersections(held, left, right)
            similar = both >= plan.threshold * (task.n[left] + task.n[right] - both) - 1e-9
            left, right = left[similar], right[similar]
            if not len(left):
                continue
            copies, n, low = np.array(task.columns["copies"]), len(task.rep), task.rep.copy()
            links = np.bincount(left, minlength=n) + np.bincount(right, minlength=n)
            weight = np.bincount(left, weights=copies[right], minlength=n) + np.bincount(right, weights=copies[left], minlength=n)
            while True:
                before = low.copy()
                least = np.minimum(low[left], low[right])
                np.minimum.at(low, left, least)
                np.minimum.at(low, right, least)
                if (low == before).all():
                    break
            rows += [(int(task.rep[i]), int(low[i]), int(links[i]), int(weight[i])) for i in np.flatnonzero(links)]
            if len(rows) > 5_000:
                yield _batch(rows, schema)
        yield _batch(rows, schema)

    return _together(tasks).mapInArrow(linked, "rep long, to long, links long, copies long")


def _shingles(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, shingles) of the wanted sets (rep, set_row), each from the text of the one row that its number names."""
    schema = pa.schema([("rep", pa.int64()), ("shingles", pa.binary())])

    def made(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), words)
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    chosen = docs.join(wanted, F.col("row") == F.col("set_row")).select("rep", "text")
    return chosen.mapInArrow(made, "rep long, shingles binary")


def groups(edges: DataFrame) -> DataFrame:
    """(rep, label): the smallest set of each connected group of edges (rep, to), to <= rep.

    Each round every set takes the smallest label among its own and its neighbours', and then that label's label;
    the label tables are written, so a round does not lean on the rounds before it. Ends when nothing changes.
    """
    both = materialise(edges.select(F.col("rep").alias("x"), F.col("to").alias("y")).where("x <> y").union(edges.select(F.col("to").alias("x"), F.col("rep").alias("y")).where("x <> y")).distinct(), "edges")
    labels = materialise(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, "x").select("x", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("x").alias("label"), F.col("label").alias("up"))
        step = step.join(up, "label", "left").select("x", "old", F.least("label", F.coalesce("up", "label")).alias("label"))
        step = materialise(step, "labels")
        labels = step.select("x", "label")
        if step.where("label <> old").isEmpty():
            return labels.withColumnRenamed("x", "rep")


def _numbered(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` and ``_row``: a number that is written with its row, unique and the same at every reading."""
    return materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def _keyed(numbered: DataFrame) -> DataFrame:
    """(row, doc, text) of numbered rows; a null doc_id counts as -2^63."""
    return numbered.select(F.col("_row").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), "text")


def _linked_sets(docs: DataFrame, plan: ChosenPath) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The sets of (row, doc, text): ``known`` per row, ``reps`` per different set with the smallest (set_id, set_row) of
    its rows, ``links`` per set and task, and the ``labels`` of the sets that have links."""
    known = materialise(describe(docs, plan.words), "sets")
    reps = known.groupBy("k1", "k2").agg(F.min(F.struct("doc", "row")).alias("own"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    reps = reps.select("k1", "k2", F.col("own.doc").alias("set_id"), F.col("own.row").alias("set_row"), "copies", "n", "tokens")
    # Numbers that are written with their rows: unique, and the same at every reading.
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    worded = reps.where("n > 0")
    members = buckets(worded.select("rep", "tokens"), plan)
    lists = members.groupBy("rep").agg(F.collect_list("bucket").alias("lists"))  # at most runs * branches^depth
    joined = materialise(worded.select("rep", "tokens", "n", "copies").join(lists, "rep"), "bucket-lists")
    tasks = materialise(_candidates(members, joined, plan), "candidates")
    wanted = tasks.select("rep").distinct().join(reps.select("rep", "set_row"), "rep")
    full = tasks.join(joined, "rep").join(_shingles(docs, wanted, plan.words), "rep")
    links = materialise(_links(full, plan), "links")
    return known, reps, links, groups(links.select("rep", "to").distinct())


def similar_documents(docs: DataFrame, plan: ChosenPath = ChosenPath()) -> DataFrame:
    """Which documents have word-shingle sets of a Jaccard similarity of at least ``plan.threshold``?

    Returns one row per row of ``docs`` (doc_id, text): doc_id, set_id (the smallest doc_id of the documents with an
    equal set), class_id (the smallest set_id that links lead to), n_links (the other documents that it is similar
    to) and n_set_links (the different sets that its set is similar to).

    Equal sets are one before any comparison, so exact copies are counted and not paired. Candidate pairs come from
    ``buckets``; each is compared exactly in the first bucket that its sets share, inside one task, and only
    per-set sums and one edge per set leave the task: pairs are never rows. A text without words is similar only
    to equal texts. A null text is empty. A null doc_id counts as -2^63 and returns as null; rows of equal doc_id
    count as documents each, and share a class when one is their set's id. Extra columns are ignored; no rows give no rows.
    """
    known, reps, links, labels = _linked_sets(_keyed(_numbered(docs.select("doc_id", "text"))), plan)
    ends = reps.select("rep", "set_id").join(labels, "rep").groupBy("label").agg(F.min("set_id").alias("class_id"))
    classes = labels.join(ends, "label").select("rep", "class_id")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"), F.sum("copies").alias("linked"))
    out = reps.select("k1", "k2", "set_id", "rep", F.col("copies").alias("own")).join(counts, "rep", "left").join(classes, "rep", "left")
    out = out.select("k1", "k2", "set_id", F.coalesce("class_id", "set_id").alias("class_id"), (F.col("own") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("links", F.lit(0)).alias("n_set_links"))
    # A hot set is many rows of the left side to one of the right: a join that the runtime can split.
    named = known.select("doc", "k1", "k2").join(out, ["k1", "k2"])
    return named.select(F.when(F.col("doc") != -(1 << 63), F.col("doc")).alias("doc_id"), "set_id", "class_id", "n_links", "n_set_links")


def keep_one_each(docs: DataFrame, plan: ChosenPath = ChosenPath()) -> DataFrame:
    """The columns of ``docs``, of each connected group of similar rows only one row: that of the smallest doc_id.

    Rows are told apart by a number of their own, so of rows that repeat an id each goes by its text, and of rows that
    repeat id and text one stays. A null doc_id is the smallest. Columns of any name come back as they were.
    """
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given")
    numbered = materialise(docs.select(given, F.monotonically_increasing_id().alias("_row")), "numbered")
    _, reps, _, labels = _linked_sets(_keyed(numbered.select("_row", "given.doc_id", "given.text")), plan)
    classes = reps.select("rep", "set_id", "set_row").join(labels, "rep", "left")
    kept = classes.groupBy(F.coalesce("label", "rep")).agg(F.min(F.struct("set_id", "set_row")).alias("least"))
    return numbered.join(kept.select(F.col("least.set_row").alias("_row")), "_row", "left_semi").select(
        *[F.col("given").getField(c).alias(c) for c in docs.columns]
    )
