"""Token ids in compressed files that answer access, count and occurrence queries: one wavelet matrix per shard."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from beaconry.llm.store import file_system, materialise, shared_folder, write_file
from beaconry.llm.words import large_slices, word_encoder

MAGIC = b"WMTOKEN1"
# Bits between two stored ranks of a plane.
BLOCK = 512
SHARD_TOKENS = 1 << 23
# Tokens that are parted at once: their positions stay in a core's cache.
STRETCH = 1 << 16
MANIFEST = "part int, seq int, file string, bytes long, n_docs long, n_tokens long"


class WaveletMatrix:
    """Bit-planes of a sequence, highest bit first, each stably parted by the plane above it."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.planes, self.ranks = n, planes, ranks

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        planes, ranks = [], []
        for level in range(bits - 1, -1, -1):
            ones = values & values.dtype.type(1 << level) != 0
            plane = np.packbits(ones)
            planes.append(plane)
            ranks.append(cls._ranks(plane))
            if level:
                values = cls._parted(values, ones, len(values) - int(ranks[-1][-1]))
        return cls(len(values), planes, ranks)

    @staticmethod
    def _parted(values: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
        """The values at zeros and then those at ones, both in order."""
        parted, low, high = np.empty_like(values), 0, zeros
        for at in range(0, len(values), STRETCH):
            some, here = values[at : at + STRETCH], ones[at : at + STRETCH]
            # Taking by positions is several times quicker than by a mask.
            a, b = np.flatnonzero(~here), np.flatnonzero(here)
            parted[low : low + len(a)], parted[high : high + len(b)] = some[a], some[b]
            low, high = low + len(a), high + len(b)
        return parted

    @staticmethod
    def _ranks(plane: np.ndarray) -> np.ndarray:
        """Ones before each block of a plane, and all ones."""
        padded = np.zeros(-(-len(plane) * 8 // BLOCK) * (BLOCK // 8), dtype=np.uint8)
        padded[: len(plane)] = plane
        counts = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
        return np.concatenate([[0], np.cumsum(counts)])

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, plane = i // BLOCK, self.planes[level]
        start, byte = block * (BLOCK // 8), i // 8
        ones = int(self.ranks[level][block]) + int(np.bitwise_count(plane[start:byte]).sum())
        return ones + (int(plane[byte]) >> (8 - i % 8)).bit_count() if i % 8 else ones

    def _zeros(self, level: int) -> int:
        return self.n - int(self.ranks[level][-1])

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit = int(self.planes[level][i // 8]) >> (7 - i % 8) & 1
            ones = self._rank1(level, i)
            i = self._zeros(level) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _interval(self, token: int, start: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token among positions [start, end) lie below the last plane."""
        bits = len(self.planes)
        if token < 0 or token >> bits:
            return 0, 0
        for level in range(bits):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if token >> (bits - 1 - level) & 1:
                zeros = self._zeros(level)
                start, end = zeros + a, zeros + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token among positions [start, end)."""
        a, b = self._interval(token, start, self.n if end is None else end)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The position of the k-th occurrence (from 0) of a token."""
        first, last = self._interval(token, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        i = first + k
        for level in range(len(self.planes) - 1, -1, -1):
            zeros = self._zeros(level)
            i = self._select_bit(level, i - zeros, 1) if i >= zeros else self._select_bit(level, i, 0)
        return i

    def _select_bit(self, level: int, k: int, bit: int) -> int:
        """The position of the k-th one or zero of a plane: find its block by rank, then look into the block."""
        ranks = self.ranks[level]
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        held = np.unpackbits(self.planes[level][block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)])
        return block * BLOCK + int(np.flatnonzero(held == bit)[k - int(before[block])])

    def occurrences(self, token: int) -> Iterator[int]:
        """All positions of a token, ascending."""
        return (self.select(token, k) for k in range(self.count(token)))

    def decode(self) -> np.ndarray:
        """All tokens in order: undo the parting from the last plane upwards."""
        values = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            low, high, above = 0, self._zeros(level), np.empty_like(values)
            values[high:] |= values.dtype.type(1 << (len(self.planes) - 1 - level))
            for at in range(0, self.n, STRETCH):
                some = above[at : at + STRETCH]
                ones = np.unpackbits(self.planes[level][at // 8 : (at + STRETCH) // 8], count=len(some)).view(bool)
                a, b = np.flatnonzero(~ones), np.flatnonzero(ones)
                some[a], some[b] = values[low : low + len(a)], values[high : high + len(b)]
                low, high = low + len(a), high + len(b)
            values = above
        return values


def dump_shard(doc_ids: list[int | None], lengths: list[int], ids: bytes, bits: int) -> list[bytes]:
    """The parts of one file: a header, document ids and lengths, bit-planes and their ranks, each part compressed."""
    whole = np.frombuffer(ids, dtype="<u4")
    if len(whole) and int(whole.max()) >> bits:
        raise ValueError(f"token id {whole.max()} does not fit {bits} bits")
    values = whole.astype(np.uint16 if bits <= 16 else np.uint32)
    matrix = WaveletMatrix.build(values, bits)
    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    parts = [known, numbers, np.array(lengths, dtype="<i8"), *matrix.planes, *(r.astype("<i8") for r in matrix.ranks)]
    packed = [pack(p.tobytes()) for p in parts]
    head = json.dumps({"n": len(values), "bits": bits, "block": BLOCK, "parts": [len(p) for p in packed]}).encode()
    return [MAGIC, struct.pack("<I", len(head)), head, *packed]


def load_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their numbers of tokens and the wavelet matrix of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    (size,) = struct.unpack("<I", data[8:12])
    head, at, parts = json.loads(data[12 : 12 + size]), 12 + size, []
    for length in head["parts"]:
        parts.append(zstandard.ZstdDecompressor().decompress(data[at : at + length]))
        at += length
    bits = head["bits"]
    known, numbers, lengths = np.frombuffer(parts[0], np.uint8), np.frombuffer(parts[1], "<i8"), np.frombuffer(parts[2], "<i8")
    planes = [np.frombuffer(p, np.uint8) for p in parts[3 : 3 + bits]]
    ranks = [np.frombuffer(p, "<i8") for p in parts[3 + bits :]]
    docs = [int(d) if k else None for k, d in zip(known, numbers, strict=True)]
    return docs, lengths, WaveletMatrix(head["n"], planes, ranks)


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, bits: int = 16,
    shard_tokens: int = SHARD_TOKENS, dropped_space: bool = False,
) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, and write the ids in ascending doc_id order as shard files.

    The documents are range-partitioned by doc_id; each task writes its range as files of about ``shard_tokens``
    tokens (a document is never split over files) and gives a manifest row for each. Only files that a manifest
    row names count: what a failed attempt wrote is ignored. ``bits`` must hold the largest id.

    Nulls: a null doc_id comes first, a null text is empty. Rows of equal doc_id are ordered by their texts' hash
    and all kept. No rows give no files. Extra columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "token-files")

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        attempt, end = TaskContext.get().taskAttemptId(), np.array([end_id], dtype="<u4").tobytes()
        encoder = word_encoder(tokenizer_path, dropped_space)
        held: list[bytes] = []
        numbers: list[int | None] = []
        lengths: list[int] = []

        def flush() -> pa.RecordBatch:
            nonlocal seq
            name = f"shard-{part:06d}-{seq:06d}-{attempt}.wm"
            size = write_file(folder, name, dump_shard(numbers, lengths, b"".join(held), bits))
            row = {"part": part, "seq": seq, "file": name, "bytes": size, "n_docs": len(numbers), "n_tokens": sum(lengths)}
            held.clear(), numbers.clear(), lengths.clear()
            seq += 1
            kinds = {"part": pa.int32(), "seq": pa.int32(), "file": pa.string()}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([(k, kinds.get(k, pa.int64())) for k in row]))

        tokens = 0
        for batch in large_slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                held.append(blob + end)
                numbers.append(doc_id)
                lengths.append(len(blob) // 4 + 1)
                tokens += lengths[-1]
                if tokens >= shard_tokens:
                    yield flush()
                    tokens = 0
        if numbers:
            yield flush()

    order = ["doc_id", "_tie"]
    ordered = docs.selectExpr("cast(doc_id as long) as doc_id", "text", "xxhash64(text) as _tie").repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = materialise(ordered.select("doc_id", "text").mapInArrow(written, MANIFEST), "token-manifest")
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    # One row per write task; the window over them in one task holds two numbers each.
    earlier = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    within = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq"))
    return (
        manifest.withColumn("_within", within - F.col("n_tokens")).join(earlier, "part")
        .select("part", "seq", F.lit(folder).alias("folder"), "file", "bytes", "n_docs", "n_tokens", (F.col("_before") + F.col("_within")).alias("start"))
    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """The documents of token files, one row each: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""

    def read(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                system, path = file_system(row.folder)
                with system.open_input_stream(f"{path}/{row.file}") as stream:
                    docs, lengths, matrix = load_shard(stream.read())
                ids, ends = matrix.decode().astype("<u4"), np.cumsum(lengths)
                for at in range(0, len(docs), 1024):
                    span = slice(at, at + 1024)
                    yield pd.DataFrame({
                        "doc_id": pd.array(docs[span], dtype="Int64"), "start": row.start + ends[span] - lengths[span], "n_tokens": lengths[span],
                        "ids": [ids[e - n : e].tobytes() for e, n in zip(ends[span], lengths[span], strict=True)],
                    })

    # A given number: the manifest is small, and the runtime would join its partitions to one.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = manifest.select("folder", "file", "start").repartition(tasks, "file")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")


def open_shard(folder: str, file: str) -> WaveletMatrix:
    """One shard for access, count, select and occurrence queries."""
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/{file}") as stream:
        return load_shard(stream.read())[2]


