"""Keyed state held by buckets of keys: one call of Python and one state row for many keys.

A call of Python per key costs milliseconds whatever it does. Here a group is a bucket of keys by hash, its rows and
its state are tables, and all keys of a bucket are worked on at once. The state of a bucket is written whole when the
bucket is touched, so choose the number of buckets by the keys that the state holds: some thousands to a bucket are
good. The number must stay the same for a checkpoint.

A bucket with more rows than a task should hold as a table is worked on by parts of its keys (:func:`parted`), which
wait packed; so is its state (:class:`Packed`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F

BUCKETS = 1_024
STATE = "held BINARY"
# Rows of a bucket that are one table; the parts of a bucket that has more, and how often a part is cut again.
PART, FAN, LEVELS = 1 << 15, 16, 8
_PACKED = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 1))


def bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def pack(table: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.Table.from_pandas(table, schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _nullable(kind: pa.DataType) -> pd.api.extensions.ExtensionDtype | None:
    return {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype(), pa.bool_(): pd.BooleanDtype()}.get(kind)


def unpack(held: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(held).read_all().to_pandas(types_mapper=_nullable)


def gather(batches: Iterator[pd.DataFrame], schema: pa.Schema, held: bytes | None = None) -> pd.DataFrame:
    """The state's rows and then the new ones, with the columns and types of the schema."""
    parts = [] if held is None else [unpack(held)]
    for batch in batches:
        kinds = {f.name: k for f in schema if (k := _nullable(f.type)) is not None}
        parts.append(batch[schema.names].astype(kinds))
    return pd.concat(parts, ignore_index=True) if parts else schema.empty_table().to_pandas(types_mapper=_nullable)


def codes(keys: pd.Series) -> np.ndarray:
    """Equal numbers for equal keys; missing keys are equal."""
    return pd.factorize(keys, use_na_sentinel=False)[0]


def firsts(key: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """Places of the first row of each key by ``order``, of ties the one that came first."""
    places = np.lexsort((*reversed(order), key))
    key = key[places]
    return places[np.r_[True, key[1:] != key[:-1]]] if len(key) else places


class Packed:
    """Rows put away bit by bit, compressed, as :func:`unpacked` reads them."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, 0
        self.sink = pa.BufferOutputStream()
        self.out = pa.ipc.new_stream(self.sink, schema, options=_PACKED)

    def add(self, table: pd.DataFrame) -> None:
        if len(table):
            self.rows += len(table)
            self.out.write_table(pa.Table.from_pandas(table, self.schema, preserve_index=False), PART)

    def value(self) -> bytes:
        self.out.close()
        return self.sink.getvalue().to_pybytes()


def unpacked(held: bytes | None) -> Iterator[pd.DataFrame]:
    """What was packed, table by table."""
    if held is not None:
        for batch in pa.ipc.open_stream(bytes(held)):
            yield batch.to_pandas(types_mapper=_nullable)


def parted(sources: Sequence[tuple[pa.Schema, Iterator[pd.DataFrame]]], key: str, level: int = 0) -> Iterator[list[pd.DataFrame]]:
    """The rows of some tables by parts of their keys, in their order: few rows are one part, of many the parts wait packed."""
    waiting: list[list[pd.DataFrame]] = [[] for _ in sources]
    parts: list[list[Packed]] = []
    rows = 0

    def put_away() -> None:
        if not parts:
            parts.extend([Packed(schema) for schema, _ in sources] for _ in range(FAN))
        for i, (schema, _) in enumerate(sources):
            table = gather(iter(waiting[i]), schema)
            waiting[i].clear()
            hashed = pd.util.hash_array(table[key].to_numpy(object), categorize=False)
            part = (hashed >> np.uint64(4 * level)).astype("int64") % FAN
            places = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[places], np.arange(FAN + 1))
            for p in range(FAN):
                parts[p][i].add(table.iloc[places[cuts[p] : cuts[p + 1]]])

    for i, (_, tables) in enumerate(sources):
        for table in tables:
            waiting[i].append(table)
            rows += len(table)
            if rows > PART and level < LEVELS:
                put_away()
                rows = 0
    if not parts:
        yield [gather(iter(tables), schema) for tables, (schema, _) in zip(waiting, sources, strict=True)]
        return
    put_away()
    while parts:
        part = parts.pop(0)
        yield from parted([(x.schema, unpacked(x.value())) for x in part], key, level + 1)
