"""A quality classifier by compression: which of two dictionaries, of good or of bad text, makes a text smaller?"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from beaconry.llm.words import text_slices

# Bytes of a text that are compressed at once, each time from the dictionary alone, so that a long text keeps its effect.
BLOCK = 1024
DICTIONARY = 1 << 17
LEVEL = 3
FEATURES = 6


def held_out(doc_id: Column) -> Column:
    """The rows whose labels are never learnt from: crc32 of the id as text, modulo 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class CompressionClassifier:
    """Two dictionaries and the weights that turn compressed sizes into a probability."""

    good: bytes
    bad: bytes
    weights: np.ndarray
    raw: bool

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_FULLDICT
        frame = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_dict_id=0, write_checksum=0)
        made = []
        for data in (self.good, self.bad):
            words = zstandard.ZstdCompressionDict(data, dict_type=kind)
            words.precompute_compress(compression_params=frame)
            made.append(zstandard.ZstdCompressor(dict_data=words, compression_params=frame))
        return made[0], made[1]

    @staticmethod
    def features(texts: list[str | None], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
        """Per text: 1, the normalised size difference, the share of its bytes that the good dictionary leaves, and
        their squares and product: repeated text shrinks to nothing under both, noise under neither."""
        out = np.zeros((len(texts), FEATURES))
        for i, text in enumerate(texts):
            data = (text or "").encode("utf-8", "replace")
            g = b = 0
            for start in range(0, len(data), BLOCK):
                block = data[start : start + BLOCK]
                g += len(good.compress(block))
                b += len(bad.compress(block))
            gap, left = (b - g) / max(g, b, 1), g / max(len(data), 1)
            out[i] = (1.0, gap, left, gap * gap, left * left, gap * left)
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -500, 500)))


def _calibrated(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps; the classes weigh as in all labels, of which ``share`` are good."""
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    scale = np.array([1.0, *np.maximum(x[:, 1:].std(axis=0), 1e-6)])
    z, w = x / scale, np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w / scale


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1500, longest: int = 1 << 15) -> CompressionClassifier:
    """Fit on a bounded sample of labelled documents.

    ``sample`` labelled documents of each class at most, those with the smallest hash of their id, of at most
    ``longest`` bytes each, come to the driver: 2 * sample * longest bytes bound what it holds. Half of each class
    makes its dictionary, the other half calibrates. ``labels`` (doc_id, quality 0 or 1): null ids, other values and
    documents labelled both ways are left out. Without a good or a bad text to learn from, every score is the share
    of good labels (0.5 without any).
    """
    clear = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id")
    clear = clear.agg(F.min("quality").alias("quality"), F.max("quality").alias("_most")).where("quality = _most").select("doc_id", "quality")
    usable = docs.where(F.octet_length("text").between(1, longest)).select(F.col("doc_id").alias("_id"))
    known = clear.join(usable, F.col("doc_id") == F.col("_id"), "left_semi")
    counts = {int(r.quality): r["count"] for r in clear.groupBy("quality").count().collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("quality = 0").orderBy(*order).limit(sample).union(known.where("quality = 1").orderBy(*order).limit(sample))
    picked = picked.select(F.col("doc_id").alias("_id"), "quality")
    # At most 2 * sample rows: the one table here that is broadcast.
    rows = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).where(F.octet_length("text").between(1, longest))
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(rows.select("doc_id", "text", "quality").distinct().collect(), key=lambda r: (r.doc_id, r.text)):
        texts[int(row.quality)].append(row.text.encode("utf-8", "replace"))
    empty = CompressionClassifier(b"x" * 16, b"x" * 16, np.array([np.log(max(share, 1e-3) / max(1 - share, 1e-3)), *[0.0] * (FEATURES - 1)]), True)
    if not texts[0] or not texts[1]:
        return empty
    halves = {c: (t[::2], t[1::2] or t) for c, t in texts.items()}
    try:
        # Dictionaries read best what their samples often share; too few samples have none.
        trained = [zstandard.train_dictionary(DICTIONARY, [t[i : i + BLOCK] for t in halves[c][0] for i in range(0, len(t), BLOCK)]).as_bytes() for c in (1, 0)]
        raw = False
    except zstandard.ZstdError:
        # Each text gives an equal part of the dictionary.
        part = lambda ts: b"".join(t[: max(8, DICTIONARY // len(ts))] for t in ts)[:DICTIONARY].ljust(16)
        trained, raw = [part(halves[c][0]) for c in (1, 0)], True
    model = CompressionClassifier(trained[0], trained[1], np.zeros(FEATURES), raw)
    y = np.repeat([1, 0], [len(halves[1][1]), len(halves[0][1])])
    x = model.features([t.decode() for c in (1, 0) for t in halves[c][1]], *model.compressors())
    model.weights = _calibrated(x, y, share)
    return model


def score(docs: DataFrame, model: CompressionClassifier) -> DataFrame:
    """The columns of ``docs`` and quality_score (0 to 1, higher: good likelier) of each whole text.

    A null text scores as an empty one, whose score is what the weights give for no evidence. A column named
    quality_score is replaced. Nothing but the text is looked at.
    """
    names = [c for c in docs.columns if c != "quality_score"]
    slim = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*slim.schema.fields, T.StructField("quality_score", T.DoubleType())])

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = model.compressors()
        for batch in text_slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            scores = pa.array(model.score(model.features(texts, good, bad)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "quality_score"])

    return slim.mapInArrow(scored, schema)
