"""Folders with one envelope per file, as a data source: batch reader, ordered stream and writer.

File names in text order are age order. A read lists the folder once and packs many small files into a partition by
bytes; filters on ``file_name`` reach the listing. The stream takes files by name, not by file time: what a
micro-batch delivers is written down as a manifest before it is planned, and its files leave the folder only after
the batch is done.

The driver never holds the names of a folder: they are sorted in runs on its disk and written to a list, a line for
each partition, and a partition is a place in that list.
"""

from __future__ import annotations

import heapq
import io
import json
import os
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import chain, islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan,
    GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage,
)

FORMAT = "envelope_files"
# Fixed value: names of envelope files.
NAME = re.compile(r"[0-9]+-[0-9a-z]+\.json", re.IGNORECASE)
# Bytes of a partition, what opening a file counts as, files that a task reads at the same time, rows of an Arrow batch.
PARTITION_BYTES, OPEN_BYTES, THREADS, ROWS = 32 << 20, 64 << 10, 8, 1024
# Names that are sorted at once.
RUN = 1 << 17
READ = "file_name string, value string, size bigint"
PROGRESS, SETTLED = "_progress", "_settled"


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    uri = folder if re.match(r"[a-z][a-z0-9+.-]*:", folder) else f"file://{folder}"
    return fs.FileSystem.from_uri(uri)


def _text(system: fs.FileSystem, path: str) -> str:
    with system.open_input_stream(path) as file:
        return file.read().decode("utf-8")


def _write(system: fs.FileSystem, folder: str, name: str, data: bytes) -> None:
    """The file is there whole or not at all; of several that write it at the same time the last one stays."""
    part = f"{folder}/.{name}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as out:
        out.write(data)
    system.move(part, f"{folder}/{name}")


def _entries(system: fs.FileSystem, folder: str) -> Iterator[tuple[str, int]]:
    """Names and sizes of the envelope files of a folder in no order; a local folder is gone through entry by entry."""
    if not isinstance(system, fs.LocalFileSystem):
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        yield from ((f.base_name, f.size or 0) for f in found if f.type == fs.FileType.File and NAME.fullmatch(f.base_name))
        return
    try:
        entries = os.scandir(folder)
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            if NAME.fullmatch(entry.name):
                try:
                    if entry.is_file():
                        yield entry.name, entry.stat().st_size
                except FileNotFoundError:
                    pass  # gone meanwhile


def _lines(run: Iterable[str]) -> Iterator[tuple[str, int]]:
    for line in run:
        name, size = line.split()
        yield name, int(size)


def _listed(system: fs.FileSystem, folder: str, keep: Callable[[str], bool] = lambda name: True) -> Iterator[tuple[str, int]]:
    """Names and sizes of the envelope files of a folder, oldest first. Sorted runs of names wait in files."""
    found = (f for f in _entries(system, folder) if keep(f[0]))
    runs: list[Iterable[tuple[str, int]]] = []
    while len(run := sorted(islice(found, RUN))) == RUN:
        file = tempfile.TemporaryFile("w+", encoding="utf-8")
        file.writelines(f"{name} {size}\n" for name, size in run)
        file.seek(0)
        runs.append(_lines(file))
    return heapq.merge(*runs, run)


def _packed(files: Iterable[tuple[str, int]], most: int) -> Iterator[list[tuple[str, int]]]:
    """Neighbouring files, so many that a partition has ``most`` bytes at most (or one file)."""
    part: list[tuple[str, int]] = []
    room = most
    for name, size in files:
        cost = size + OPEN_BYTES
        if part and room < cost:
            yield part
            part, room = [], most
        part.append((name, size))
        room -= cost
    if part:
        yield part


def _line(files: Sequence[tuple[str, int]]) -> bytes:
    return json.dumps(files).encode() + b"\n"


class Files(InputPartition):
    """Names and sizes of files that one task reads: a line of a list, or the line itself."""

    def __init__(self, path: str = "", start: int = 0, length: int = 0, held: bytes = b""):
        super().__init__(None)
        self.path, self.start, self.length, self.held = path, start, length, held

    def files(self) -> list[tuple[str, int]]:
        if not self.path:
            return json.loads(zlib.decompress(self.held)) if self.held else []
        system, path = _system(self.path)
        with system.open_input_file(path) as file:
            file.seek(self.start)
            return json.loads(file.read(self.length))


def _written(system: fs.FileSystem, folder: str, name: str, parts: Iterable[Sequence[tuple[str, int]]]) -> Iterator[tuple[int, int]]:
    """Write a list, which is there whole or not at all; where its lines are."""
    part, start = f"{folder}/.{name}.{uuid.uuid4().hex}.part", 0
    with system.open_output_stream(part) as out:
        for files in parts:
            out.write(line := _line(files))
            yield start, len(line)
            start += len(line)
    system.move(part, f"{folder}/{name}")


def _read(folder: str, files: Sequence[tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """Whole files; a file that is gone or is no UTF-8 has no value. Other faults fail the task, which is tried again."""
    system, path = _system(folder)

    def text(file: tuple[str, int]) -> str | None:
        try:
            return _text(system, f"{path}/{file[0]}")
        except (FileNotFoundError, UnicodeDecodeError):
            return None

    schema = pa.schema([("file_name", pa.string()), ("value", pa.string()), ("size", pa.int64())])
    with ThreadPoolExecutor(THREADS) as pool:
        for start in range(0, len(files), ROWS):
            some = files[start : start + ROWS]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in some]), pa.array(pool.map(text, some), pa.string()), pa.array([s for _, s in some], pa.int64())], schema=schema)


# How a filter on the name is tested; all of them are taken over whole.
_TESTS: dict[type, Callable[[str, object], bool]] = {
    EqualTo: lambda name, v: name == v, In: lambda name, v: name in v, StringStartsWith: lambda name, v: name.startswith(v),
    GreaterThan: lambda name, v: name > v, GreaterThanOrEqual: lambda name, v: name >= v,
    LessThan: lambda name, v: name < v, LessThanOrEqual: lambda name, v: name <= v,
}


@dataclass
class EnvelopeReader(DataSourceReader):
    folder: str
    partition_bytes: int
    lists: str

    def __post_init__(self) -> None:
        self.tests: list[tuple[type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if type(f) in _TESTS and f.attribute == ("file_name",) and f.value is not None:
                self.tests.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        files = _listed(*_system(self.folder), lambda name: all(_TESTS[kind](name, v) for kind, v in self.tests))
        parts = _packed(files, self.partition_bytes)
        if not self.lists:
            return [Files(held=zlib.compress(_line(part))) for part in parts] or [Files()]
        system, path = _system(self.lists)
        system.create_dir(path, recursive=True)
        name = uuid.uuid4().hex
        return [Files(f"{self.lists}/{name}", *place) for place in _written(system, path, name, parts)] or [Files()]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition.files())


def _without(files: Iterable[tuple[str, int]], names: Iterator[str]) -> Iterator[tuple[str, int]]:
    """The files without those of the names; both in order."""
    other = next(names, None)
    for file in files:
        while other is not None and other < file[0]:
            other = next(names, None)
        if other != file[0]:
            yield file


class EnvelopeStream(DataSourceStreamReader):
    """Files by name, each once. The offset is the number of the last manifest.

    A manifest lists the files that are new to the stream, oldest first, at most ``max_files``. It is written before
    its number is known to the query, so a repeated batch delivers the same files; a file that comes late, with a
    name before others, is in a later manifest. A committed batch's files move to the folder ``_settled`` (or are
    deleted) when the query plans the next one, then its manifest goes. One stream at a time may drain a folder.
    """

    def __init__(self, folder: str, partition_bytes: int, max_files: int, delete: bool):
        self.folder, self.partition_bytes, self.max_files, self.delete = folder.rstrip("/"), partition_bytes, max_files, delete
        self.system, self.path = _system(folder)
        self.progress = f"{self.path}/{PROGRESS}"
        self.system.create_dir(self.progress, recursive=True)

    def _manifests(self) -> list[int]:
        names = [f.base_name for f in self.system.get_file_info(fs.FileSelector(self.progress))]
        return sorted(int(n) for n in names if n.isdecimal())

    def _lines(self, number: int) -> Iterator[bytes]:
        with self.system.open_input_stream(f"{self.progress}/{number}") as file, io.BufferedReader(file) as lines:
            yield from lines

    def _names(self, number: int) -> Iterator[str]:
        return (name for line in self._lines(number) for name, _ in json.loads(line))

    def _last_settled(self) -> int:
        try:
            return int(_text(self.system, f"{self.progress}/settled"))
        except FileNotFoundError:
            return 0

    def initialOffset(self) -> dict:
        return {"manifest": 0}

    def latestOffset(self) -> dict:
        numbers, settled = self._manifests(), self._last_settled()
        last = max([settled, *numbers])
        waiting = heapq.merge(*(self._names(n) for n in numbers if n > settled))
        new = _packed(islice(_without(_listed(self.system, self.path), waiting), self.max_files or None), self.partition_bytes)
        first = next(new, None)
        if first:
            last += 1
            for _ in _written(self.system, self.progress, str(last), chain([first], new)):
                pass
        return {"manifest": last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        there = set(self._manifests())
        parts = []
        for n in (n for n in range(start["manifest"] + 1, end["manifest"] + 1) if n in there):
            at = 0
            for line in self._lines(n):
                parts.append(Files(f"{self.folder}/{PROGRESS}/{n}", at, len(line)))
                at += len(line)
        return parts or [Files()]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition.files())

    def _settle(self, name: str) -> None:
        try:
            if self.delete:
                self.system.delete_file(f"{self.path}/{name}")
            else:
                self.system.move(f"{self.path}/{name}", f"{self.path}/{SETTLED}/{name}")
        except FileNotFoundError:
            pass  # settled before the last stop

    def commit(self, end: dict) -> None:
        numbers = [n for n in self._manifests() if n <= end["manifest"]]
        if not numbers:
            return
        if not self.delete:
            self.system.create_dir(f"{self.path}/{SETTLED}", recursive=True)
        with ThreadPoolExecutor(THREADS) as pool:
            for n in numbers:
                names = self._names(n)
                while some := list(islice(names, ROWS)):
                    list(pool.map(self._settle, some))
        _write(self.system, self.progress, "settled", str(numbers[-1]).encode())
        for n in numbers:
            self.system.delete_file(f"{self.progress}/{n}")


@dataclass
class EnvelopeWriter(DataSourceArrowWriter):
    """One file per row (file_name, value), the last one of a name; a repeated task writes the same files again."""

    folder: str

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, path = _system(self.folder)
        system.create_dir(path, recursive=True)
        with ThreadPoolExecutor(THREADS) as pool:
            for batch in iterator:
                names, values = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file_name", "value"))
                last = dict(zip(names, values, strict=True))
                list(pool.map(lambda n: _write(system, path, n, (last[n] or "").encode()), last))
        return WriterCommitMessage()


class EnvelopeFiles(DataSource):
    """Options: ``path``, ``partition_bytes``; for reads ``lists``, a folder that every task can reach, for the list of
    files (without it the names travel in the partitions); for streams ``max_files`` a micro-batch (0: all) and
    ``settled`` (``archive`` or ``delete``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return READ

    def _bytes(self) -> int:
        return int(self.options.get("partition_bytes", PARTITION_BYTES))

    def reader(self, schema) -> EnvelopeReader:
        return EnvelopeReader(self.options["path"], self._bytes(), self.options.get("lists", "").rstrip("/"))

    def streamReader(self, schema) -> EnvelopeStream:
        return EnvelopeStream(self.options["path"], self._bytes(), int(self.options.get("max_files", 0)), self.options.get("settled", "archive") == "delete")

    def writer(self, schema, overwrite: bool) -> EnvelopeWriter:
        return EnvelopeWriter(self.options["path"])


def register(spark: SparkSession) -> SparkSession:
    """Make the source known to the session, and let filters reach sources written in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EnvelopeFiles)
    return spark


def files(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The envelope files of a folder: file_name, value (null: gone or no UTF-8), size. Other files don't appear.

    The list of files goes to ``spark.checkpoint.dir`` where there is one (option ``lists``).
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        options.setdefault("lists", f"{shared.rstrip('/')}/beaconry-lists")
    return register(spark).read.format(FORMAT).options(**options).load(folder)


def file_stream(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same as a stream in the order of file names."""
    return register(spark).readStream.format(FORMAT).options(**options).load(folder)


def write_files(rows: DataFrame, folder: str) -> None:
    """One file per row (file_name, value), each there whole or not at all; rows of one name are one file."""
    register(rows.sparkSession)
    rows.select("file_name", "value").write.format(FORMAT).mode("append").save(folder)
