"""Harmonic packing of tokenised documents into sequences."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from beaconry.llm.words import text_slices, word_encoder

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
# Sequences that one worker can number.
SEQUENCES = 1 << 36


class HarmonicBins:
    """The bins of one worker: class k takes documents of capacity / (k + 1) to capacity / k tokens, k to a bin.

    What k documents leave free of a bin is filled from the head of a spare document, so a bin cuts at most one.
    Spares are the documents longer than a bin, which no bin can hold whole; where they don't reach, a document that
    takes more than half a bin, or any document once ``waiting`` bins want filling (2 * capacity more at most). Spares over ``spare_bins``
    bins of tokens leave as full sequences. ``add`` and ``close`` give finished sequences as lists of
    (document, start, size).
    """

    def __init__(self, capacity: int, spare_bins: int = 256, waiting: int = 256):
        if capacity < 1:
            raise ValueError("capacity must be positive")
        self.capacity, self.limit, self.waiting = capacity, spare_bins * capacity, waiting
        self.open: dict[int, list] = {}
        self.full: deque[tuple[int, list]] = deque()  # (free tokens, pieces) of bins that have their k documents
        self.free = 0
        self.spare: deque[tuple[object, int, int]] = deque()  # (document, start, tokens left)
        self.spared = 0

    def add(self, doc: object, length: int) -> Iterator[list]:
        if length > self.capacity or self._wanted(length):
            self._put_spare((doc, 0, length))
        else:
            k = self.capacity // length
            held = self.open.setdefault(k, [])
            held.append((doc, 0, length))
            if len(held) == k:
                free = self.capacity - sum(size for _, _, size in self.open.pop(k))
                if free:
                    self.full.append((free, held))
                    self.free += free
                else:
                    yield held
        while self.full and self.spared >= self.full[0][0]:
            free, held = self.full.popleft()
            self.free -= free
            yield held + self._take(free)
        while self.spared > self.limit:
            yield self._take(self.capacity)

    def close(self) -> Iterator[list]:
        """Bins without their k documents are joined where they fit together; those freest become spares until the
        others are full. What is left at last is cut by the binary digits of its length, so nothing needs padding."""
        rest = sorted((piece for held in self.open.values() for piece in held), key=lambda piece: -piece[2])
        bins: list[list] = []
        for piece in rest:
            for held in bins:
                if held[0] >= piece[2]:
                    break
            else:
                bins.append(held := [self.capacity, []])
            held[0] -= piece[2]
            held[1].append(piece)
        ready = deque(sorted([*self.full, *map(tuple, bins)], key=lambda b: b[0]))
        self.open, self.full, self.free = {}, deque(), 0
        while ready:
            free, held = ready.popleft()
            if self.spared >= free:
                yield held + self._take(free)
                continue
            ready.appendleft((free, held))
            for piece in ready.pop()[1]:
                self._put_spare(piece)
        while self.spared:
            yield self._take(self.capacity if self.spared >= self.capacity else 1 << (self.spared.bit_length() - 1))

    def _wanted(self, length: int) -> bool:
        """Is this document to be cut, though it fits, for the bins that wait?"""
        return self.spared + length <= self.free and (2 * length > self.capacity or len(self.full) >= self.waiting)

    def _put_spare(self, piece: tuple[object, int, int]) -> None:
        self.spare.append(piece)
        self.spared += piece[2]

    def _take(self, wanted: int) -> list:
        taken = []
        self.spared -= wanted
        while wanted:
            doc, start, left = self.spare[0]
            size = min(wanted, left)
            taken.append((doc, start, size))
            wanted -= size
            if size < left:
                self.spare[0] = (doc, start + size, left - size)
            else:
                self.spare.popleft()
        return taken


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, dropped_space: bool = True,
) -> DataFrame:
    """Pack every whole text of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Documents that fit are parted by length into reciprocal-capacity classes, k documents of class k to a bin, and
    the rest of a bin is filled from one other document, first of those longer than a bin. Bins are filled
    independently by each task, without a shuffle; a task holds at most some thousand open bins. Every token is
    in exactly one piece and no sequence is padded: all have ``capacity`` tokens but a task's last ones, whose
    lengths are powers of two.

    Returns one row per piece: ids (little-endian unsigned 32-bit), where it starts in its document (start) and in
    its sequence (offset), doc_tokens with the end id. A null text is empty: one piece with the end id. Rows with
    equal or null doc_id are documents of their own; extra columns are ignored; no rows give no rows.
    """

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, end = HarmonicBins(capacity), np.array([end_id], dtype="<u4").tobytes()
        encoder = word_encoder(tokenizer_path, dropped_space)
        sequence = TaskContext.get().partitionId() * SEQUENCES
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
        rows: list[tuple] = []

        def finished(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for (doc_id, blob), start, size in pieces:
                rows.append((doc_id, start, size, blob[4 * start : 4 * (start + size)], len(blob) // 4, sequence, offset))
                offset += size
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            rows.clear()
            return batch

        for batch in text_slices(batches):
            ids = batch.column("doc_id").to_pylist()
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc_id, blob in zip(ids, encoder.encode(texts), strict=True):
                blob += end
                for pieces in bins.add((doc_id, blob), len(blob) // 4):
                    finished(pieces)
            yield flush()
        for pieces in bins.close():
            finished(pieces)
        yield flush()

    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(packed, PIECES)
