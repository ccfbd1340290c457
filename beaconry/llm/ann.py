"""Approximate nearest neighbours: a vantage-point tree per shard."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from beaconry.llm.store import materialise

LEAF = 64
# About so many vectors of a shard, queries of a block.
SHARD_ROWS, BLOCK_ROWS = 16_384, 1_024
# The part of the k-th distance that a lower bound may reach before its subtree is passed over; 1 is exact.
FACTOR = 0.5


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to those of ``b``, in double precision, by differences."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 20) // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None]) ** 2).sum(axis=-1))
    return out


class VantageTree:
    """Points by node: each inner node has a vantage point and two halves with the range of distances to it."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.nodes: list[tuple] = []
        self._build(np.arange(len(ids)))

    def _build(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(members) <= LEAF:
            self.nodes[at] = (members,)
            return at
        vantage, rest = members[len(members) // 2], np.delete(members, len(members) // 2)
        far = distances(self.points[vantage : vantage + 1], self.points[rest])[0]
        half = len(rest) // 2
        order = np.argpartition(far, half)
        inner, outer = order[:half], order[half:]
        ranges = (far[inner].min(), far[inner].max(), far[outer].min(), far[outer].max())
        self.nodes[at] = (vantage, ranges, self._build(rest[inner]), self._build(rest[outer]))
        return at

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest ids (-1: none) and distances of each query, nearest first, ties to the smaller id."""
        n = len(queries)
        found, near = np.full((n, k), -1, dtype=np.int64), np.full((n, k), np.inf)

        def offer(active: np.ndarray, members: np.ndarray, far: np.ndarray) -> None:
            ids = np.broadcast_to(self.ids[members], far.shape)
            # The query's own row takes no part.
            far = np.where(ids == query_ids[active, None], np.inf, far)
            d, i = np.concatenate([near[active], far], axis=1), np.concatenate([found[active], ids], axis=1)
            best = np.lexsort((i, d), axis=1)[:, :k]
            near[active] = np.take_along_axis(d, best, axis=1)
            found[active] = np.where(np.isinf(near[active]), -1, np.take_along_axis(i, best, axis=1))

        def visit(node: int, active: np.ndarray) -> None:
            if not len(active):
                return
            entry = self.nodes[node]
            if len(entry) == 1:
                if len(entry[0]):
                    offer(active, entry[0], distances(queries[active], self.points[entry[0]]))
                return
            vantage, (in_low, in_high, out_low, out_high), inner, outer = entry
            far = distances(queries[active], self.points[vantage : vantage + 1])
            offer(active, np.array([vantage]), far)
            far = far[:, 0]
            bounds = {inner: np.maximum(in_low - far, far - in_high), outer: np.maximum(out_low - far, far - out_high)}
            first_inner = bounds[inner] <= bounds[outer]
            # Each query goes to the nearer half first, then to the other if its bound still allows.
            for child, mine in ((inner, first_inner), (outer, ~first_inner), (outer, first_inner), (inner, ~first_inner)):
                open_ = mine & (bounds[child] <= factor * near[active, k - 1])
                visit(child, active[open_])

        visit(0, np.arange(n))
        return found, near


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles, dim) of the rows that take part: no null id, null, empty or zero vector, and no
    null or non-finite component. Equal rows count once."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~odd & F.exists("embedding", lambda x: x != 0))
    return rows.withColumn("dim", F.size("embedding")).dropDuplicates(["vec_id", "embedding"])


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A tree for each shard of about ``shard_rows`` vectors, all rows indexed: (dim, shard, tree)."""
    rows = usable(vectors)
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int"))

    def built(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        points = np.stack(group.column("embedding").to_numpy())
        tree = pickle.dumps(VantageTree(ids, points.astype(float)), protocol=5)
        return pa.table({"dim": [points.shape[1]], "shard": [group.column("shard")[0].as_py()], "tree": [tree]}, schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("tree", pa.binary())]))

    return materialise(dealt.groupBy("dim", "shard").applyInArrow(built, "dim int, shard int, tree binary"), "vantage-trees")


def search(index: DataFrame, queries: DataFrame, k: int = 10, factor: float = FACTOR, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` nearest indexed vectors of each query by Euclidean distance: query_id, rank (from 1), vec_id, score.

    Queries go in blocks to every tree of their dimension, and the best k of each tree are merged. A subtree is
    passed over when the triangle inequality says that all of it is farther than ``factor`` times the k-th distance
    found so far: 1 gives the exact answer, less prunes more and may lose neighbours. Rows with the query's own id
    are no candidates. Queries that ``usable`` leaves out have no rows. Two different vectors under one query id
    are searched apart and ranked together.
    """
    rows = usable(queries)
    blocks = max(1, -(-rows.count() // block_rows))
    held = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)))
    held = held.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    last = index.agg(F.max("shard")).first()[0] or 0
    sent = held.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    tasks = sent.join(index, ["dim", "shard"]).select("tree", "queries")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = pickle.loads(batch.column("tree")[i].as_py())
                items = batch.column("queries")[i].as_py()
                ids = np.array([q["vec_id"] for q in items], dtype=np.int64)
                found, near = tree.search(ids, np.array([q["embedding"] for q in items], dtype=float), k, factor)
                real = ~np.isinf(near)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, real.sum(axis=1))), pa.array(found[real]), pa.array(near[real])], schema=schema)

    answers = tasks.mapInArrow(searched, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
