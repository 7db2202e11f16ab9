"""WARC archives: written with an index first, read back by coalesced byte ranges.

Writing makes one gzip member per record and an index row (file, offset, length, url, digest, type, ...) per member. The
index is a table of its own: a reader selects records there, and only then opens archives, in sorted ranges that join
neighbouring records. Files are named by task attempt, so a lost executor's half-written file is never indexed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_path, slices

RANGE_BYTES = 8 << 20
GAP_BYTES = 64 << 10
FILE_BYTES = 256 << 20
INDEX = "file string, offset long, length long, url string, digest string, record_type string, page_id {kind}, refers_to {kind}"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """The bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(kind: str, page_id, url: str | None, digest: str, size: int, payload: bytes, refers_to, date: str) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head, with the full payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{_name(page_id, digest)}>", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {quote(url, safe=_URI)}"] if url else []), f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"] if kind == "revisit" else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}",
    ]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n") + pack.flush()


def _name(page_id, digest: str) -> str:
    """A record's name. Pages without an id are told apart by their payload; rows that repeat both are copies of one record."""
    return f"null:{digest}" if page_id is None else str(page_id)


def _info(file: str, date: str) -> bytes:
    """The record that says what a file is."""
    body = b"software: tapewright\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, file)}>", f"WARC-Date: {date}", f"WARC-Filename: {file}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


_URI = "!#$%&'()*+,/:;=?@[]~"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0, date: str = "2026-01-01T00:00:00Z") -> DataFrame:
    """Writes one record per row below `folder`, behind a warcinfo record in each file, and returns the index, which is itself stored as `folder`/index.

    Of rows with equal payloads of at least min_revisit_bytes bytes, the one with the largest id becomes a response
    record, the others revisit it. A null payload is an empty one; a null url leaves the target out. A row with a null
    id is a response if no row with an id has its payload. Rows that repeat an id with the same payload get the same
    type. An empty table gives an empty index. Other columns are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                ids, urls, texts = (part.column(k).to_pylist() for k in range(3))
                rows = []
                for i, u, t in zip(ids, urls, texts):
                    body = (t or "").encode("utf-8", "surrogatepass")
                    digest = payload_digest(body)
                    rows.append((len(body), digest, _member("response", i, u, digest, len(body), body, None, date)))
                size, digest, member = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(size, pa.int64()), pa.array(digest), pa.array(member, pa.binary())], names=["id", "url", "size", "digest", "member"])

    texts = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    packed = texts.mapInArrow(pack, f"id {kind}, url string, size long, digest string, member binary")
    binary = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sums = texts.filter(F.octet_length(binary) >= min_revisit_bytes).groupBy(F.sha1(binary).alias("sha"), F.octet_length(binary).cast("long").alias("size")).agg(F.max("id").alias("first"), F.count("*").alias("n"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column(0).to_pylist()], pa.string()), *batch.columns[1:]], names=["digest", "size", "first"])

    firsts = sums.filter("n > 1 and first is not null").select("sha", "size", "first").mapInArrow(name, f"digest string, size long, first {kind}")
    planned = packed.join(firsts, ["digest", "size"], "left").select("id", "url", "size", "digest", "first", F.when(F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first")), F.col("member")).alias("member"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        store.create_dir(base, recursive=True)
        part, out, at = 0, None, 0
        for batch in batches:
            rows = []
            for i, url, size, digest, first, member in zip(*(c.to_pylist() for c in batch.columns)):
                type_ = "revisit" if member is None else "response"
                member = member or _member(type_, i, url, digest, size, b"", first, date)
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    file = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{part:03d}.warc.gz"
                    out, part = store.open_output_stream(f"{base}/{file}", compression=None), part + 1
                    out.write(info := _info(file, date))
                    at = len(info)
                out.write(member)
                rows.append((file, at, len(member), url, digest, type_, i, first if type_ == "revisit" else None))
                at += len(member)
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), batch.column(0).type, batch.column(0).type])]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "offset", "length", "url", "digest", "record_type", "page_id", "refers_to"])
        if out is not None:
            out.close()

    index = planned.mapInArrow(write, INDEX.format(kind=kind))
    index.write.option("compression", "zstd").parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX.format(kind=kind)).parquet(f"{folder}/index")


def _parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The WARC head's fields, with the HTTP head's length as http-length, and the payload."""
    text = zlib.decompress(raw, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where its head says")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http-length"] = re.search(rb"(?i)content-length: (\d+)", http)[1].decode()
    return fields, payload


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The indexed records: page_id, url, record_type, refers_to, payload_bytes, payload_digest and the payload.

    Any selection of index rows may be given. Their ranges are sorted by file and offset and read in stretches that
    skip gaps of up to GAP_BYTES and hold up to RANGE_BYTES. Bytes and digest are those of the full payload: measured on
    response records, whose digest must match their head, and taken from the head of revisit records, whose payload is
    null. A record that doesn't match its index row is an error.
    """
    kind = index.schema["page_id"].dataType.simpleString()

    def stretches(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for r in rows:
            if held and (r[0] != held[0][0] or r[1] > held[-1][1] + held[-1][2] + GAP_BYTES or r[1] + r[2] - held[0][1] > RANGE_BYTES):
                yield held
                held = []
            held.append(r)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        name, file = None, None
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for held in stretches(rows):
            if held[0][0] != name:
                name, file = held[0][0], store.open_input_file(f"{base}/{held[0][0]}")
            first = held[0][1]
            raw = file.read_at(held[-1][1] + held[-1][2] - first, first)
            out = []
            for _, offset, length, url, digest, type_, page, _ in held:
                fields, payload = _parse(raw[offset - first : offset - first + length])
                said = fields["warc-payload-digest"].removeprefix("sha1:")
                measured = payload_digest(payload) if fields["warc-type"] == "response" else said
                if (said, type_, f"<urn:page:{_name(page, digest)}>") != (digest, fields["warc-type"], fields["warc-record-id"]) or measured != digest:
                    raise ValueError(f"{name} at {offset}: the record isn't the one in the index")
                to = fields.get("warc-refers-to", "")[10:-1]
                out.append((page, url, type_, to or None, len(payload) if type_ == "response" else int(fields["http-length"]), measured, payload.decode("utf-8", "replace") if with_payload and type_ == "response" else None))
            types = [page_type, pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    page_type = to_arrow_type(index.schema["page_id"].dataType)
    names = ["page_id", "url", "record_type", "to", "payload_bytes", "payload_digest", "payload"]
    ordered = index.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    read = ordered.mapInArrow(run, f"page_id {kind}, url string, record_type string, to string, payload_bytes long, payload_digest string, payload string")
    return read.withColumn("refers_to", F.col("to").cast(kind)).drop("to")


def archive_and_read(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Writes all pages to a new folder in the shared space and reads every record back."""
    folder = new_path(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder), folder, with_payload)
