"""WARC archives with an index: write records and where they lie, then read selected ones by few byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from beaconry.llm.store import file_system, materialise, shared_folder

INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("folder", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
RECORDS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
# Fixed values of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
FILE_BYTES = 256 << 20
# Records of one file whose gap is at most GAP are read together, up to SPAN bytes.
SPAN, GAP = 8 << 20, 64 << 10


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)


def _urn(page_id: int | None) -> str:
    return f"<urn:beaconry:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member. With ``refers_to`` a revisit, which holds the HTTP header alone."""
    # White space and control characters end a header or a URI; they are escaped.
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "urn:beaconry:no-url")
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {_urn(refers_to)}", f"X-Payload-Length: {len(payload)}"]
    block = HTTP if refers_to is not None else HTTP + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"
    return gzip.compress(data, compresslevel=6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload of one record."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    names = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(names["content-length"])]
    return names, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, folder: str | None = None, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) as .warc.gz files; returns the index.

    Of the rows with equal payloads, that with the largest page_id is the response and the others revisit it; rows
    that share that page_id too are each a response, and so are rows of a payload whose ids are all null. A null
    html is an empty payload. Equal payloads are found by their SHA-1; owners are summed up before they are shuffled,
    and a payload of a third of all rows meets its owner in a join of ids alone, which the runtime can split.

    Each task writes files of its own, of about ``file_bytes``; a file of a failed attempt is in no index row. The
    index (page_id, url, digest, record_type, folder, file, offset, length) is itself written before it is used.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("html"), F.sha1(body).alias("sha"))
    ids = rows.select("page_id", "sha")
    owners = ids.groupBy("sha").agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1 AND owner IS NOT NULL")
    revisits = ids.distinct().join(owners.select("sha", "owner"), "sha").where(~F.col("page_id").eqNullSafe(F.col("owner")))
    revisits = revisits.select(F.coalesce("page_id", F.lit(-(1 << 63))).alias("at"), F.col("sha").alias("same"), "owner")
    dealt = rows.join(revisits, (F.coalesce("page_id", F.lit(-(1 << 63))) == F.col("at")) & (F.col("sha") == F.col("same")), "left")

    def written(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get(), 0
        system, path = file_system(folder)
        system.create_dir(path, recursive=True)
        out, offset, name = None, 0, ""
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    entries = []
                    for row in batch.slice(start, 1024).to_pylist():
                        if out is None or offset >= file_bytes:
                            if out:
                                out.close()
                            name = f"pages-{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.warc.gz"
                            out, offset, number = system.open_output_stream(f"{path}/{name}", compression=None), 0, number + 1
                        payload = row["html"].encode("utf-8", "replace")
                        digest = base64.b32encode(bytes.fromhex(row["sha"])).decode()
                        data = record(row["page_id"], row["url"], payload, digest, row["owner"], date)
                        out.write(data)
                        kind = "response" if row["owner"] is None else "revisit"
                        entries.append({"page_id": row["page_id"], "url": row["url"], "digest": digest, "record_type": kind, "folder": folder, "file": name, "offset": offset, "length": len(data)})
                        offset += len(data)
                    yield pa.RecordBatch.from_pylist(entries, schema=INDEX)
        finally:
            if out:
                out.close()

    return materialise(dealt.select("page_id", "url", "html", "sha", "owner").mapInArrow(written, _ddl(INDEX)), "warc-index")


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of (a selection of) index rows: page_id, url, record_type, refers_to, payload_digest,
    payload_bytes, payload.

    Index rows are dealt by file and region of it and sorted by offset, so that each task reads few ranges that hold
    many records. The digest of a response is worked out from what was read and must be that of the header; digest
    and size of a revisit are those of the payload that it refers to. ``payloads=False`` leaves the payload null.
    """

    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held:
                    last, first = held[-1], held[0]
                    same = (row["folder"], row["file"]) == (last["folder"], last["file"])
                    near = row["offset"] - last["offset"] - last["length"] <= GAP
                    if not (same and near and row["offset"] + row["length"] - first["offset"] <= SPAN):
                        yield held
                        held = []
                held.append(row)
        if held:
            yield held

    def number(urn: str | None) -> int | None:
        tail = (urn or "none").strip("<>").rpartition(":")[2]
        return None if tail == "none" else int(tail)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in ranges(batches):
            system, path = file_system(held[0]["folder"])
            first, rows = held[0]["offset"], []
            with system.open_input_file(f"{path}/{held[0]['file']}") as file:
                data = file.read_at(held[-1]["offset"] + held[-1]["length"] - first, first)
            for row in held:
                names, payload = parse(data[row["offset"] - first : row["offset"] - first + row["length"]])
                digest = names["warc-payload-digest"].removeprefix("sha1:")
                size = int(names["x-payload-length"]) if names["warc-type"] == "revisit" else len(payload)
                if names["warc-type"] == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"damaged record at {row['offset']} of {row['file']}")
                rows.append({"page_id": number(names["warc-record-id"]), "url": row["url"], "record_type": names["warc-type"], "refers_to": number(names.get("warc-refers-to")), "payload_digest": digest, "payload_bytes": size, "payload": payload if payloads else None})
                if len(rows) == 1024:
                    yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=RECORDS)

    regions = index.withColumn("region", F.floor(F.col("offset") / SPAN))
    dealt = regions.repartition("folder", "file", "region").sortWithinPartitions("folder", "file", "offset")
    return dealt.select("folder", "file", "offset", "length", "url").mapInArrow(read, _ddl(RECORDS))
