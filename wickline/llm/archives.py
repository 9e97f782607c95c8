"""WARC records in ZIP-packaged web archives: written by Spark, read back by byte ranges.

An archive is a ZIP file with stored members only: ``archive/data.warc.gz`` (one gzip member a
record) and ``indexes/index.cdxj`` (one line a record: id, offset, length). Spark's own file writer
and commit protocol put the archives into the folder, one file an archive, so a lost executor leaves
nothing half written and any file system serves. The reader looks up the central directory (ZIP64
too), finds the members where they lie, and reads the index and then each record as a range.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import os
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import map_arrow, prepared, table
from wickline.session import fresh_folder, staged

# Record bytes after which an archive is closed; a single longer record is still written whole.
ARCHIVE_BYTES = 8 << 20
# Payloads of at least so many bytes are written once, later equal ones as revisits.
LEAST_BYTES = 0
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END_SIGNATURE, END_SIZE = b"PK\x05\x06", 22
LOCATOR_SIGNATURE, LOCATOR_SIZE = b"PK\x06\x07", 20
END64_SIGNATURE, END64_SIZE = b"PK\x06\x06", 56
ENTRY_SIGNATURE, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL_SIGNATURE, LOCAL_SIZE = b"PK\x03\x04", 30
EXTRA64 = 1
ALL16, ALL32 = 0xFFFF, 0xFFFFFFFF


class Ranges(Protocol):
    size: int

    def read(self, offset: int, size: int) -> bytes: ...


class FileRanges:
    """Ranges of a file in a shared folder."""

    def __init__(self, path: str):
        self.file = os.open(path, os.O_RDONLY)
        self.size = os.fstat(self.file).st_size

    def read(self, offset: int, size: int) -> bytes:
        return os.pread(self.file, size, offset)

    def close(self) -> None:
        os.close(self.file)


class BytesRanges:
    """Ranges of bytes that Spark has read from a store without a mounted folder."""

    def __init__(self, content: bytes):
        self.content, self.size = memoryview(content), len(content)

    def read(self, offset: int, size: int) -> bytes:
        return bytes(self.content[offset : offset + size])

    def close(self) -> None:
        self.content.release()


@dataclass(frozen=True)
class Member:
    name: str
    offset: int
    size: int


def _directory(source: Ranges) -> tuple[int, int, int]:
    """(offset, size, entries) of the central directory."""
    tail_at = max(0, source.size - END_SIZE - ALL16)
    tail = source.read(tail_at, source.size - tail_at)
    at = tail.rfind(END_SIGNATURE)
    while at >= 0:
        if len(tail) - at >= END_SIZE:
            fields = struct.unpack("<4s4H2LH", tail[at : at + END_SIZE])
            if at + END_SIZE + fields[7] == len(tail):
                break
        at = tail.rfind(END_SIGNATURE, 0, at)
    if at < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    entries, size, offset = fields[4], fields[5], fields[6]
    if ALL16 in fields[1:5] or ALL32 in (size, offset):
        locator_at = tail_at + at - LOCATOR_SIZE
        locator = source.read(locator_at, LOCATOR_SIZE) if locator_at >= 0 else b""
        if locator[:4] == LOCATOR_SIGNATURE:
            end_at = struct.unpack("<4sLQL", locator)[2]
            end = struct.unpack("<4sQ2H2L4Q", source.read(end_at, END64_SIZE))
            if end[0] != END64_SIGNATURE:
                raise ValueError("the ZIP64 locator points to no ZIP64 end of central directory")
            entries, size, offset = end[7], end[8], end[9]
    return offset, size, entries


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Replace the fields that are all ones by the ZIP64 extra field's, in their order."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack("<2H", extra[at : at + 4])
        if kind == EXTRA64:
            body, place, out = extra[at + 4 : at + 4 + size], 0, []
            for value in values:
                if value == ALL32 and place + 8 <= len(body):
                    value = struct.unpack("<Q", body[place : place + 8])[0]
                    place += 8
                out.append(value)
            return out
        at += 4 + size
    return values


def members(source: Ranges) -> dict[str, Member]:
    """The stored members of an archive and where their bytes lie."""
    offset, size, entries = _directory(source)
    directory = source.read(offset, size)
    out, at = {}, 0
    for _ in range(entries):
        f = struct.unpack("<4s6H3L5H2L", directory[at : at + ENTRY_SIZE])
        if f[0] != ENTRY_SIGNATURE:
            raise ValueError("broken central directory")
        method, packed, full, name, extra, note, start = f[4], f[8], f[9], f[10], f[11], f[12], f[16]
        name_at = at + ENTRY_SIZE
        full, packed, start = _wide(directory[name_at + name : name_at + name + extra], [full, packed, start])
        text = directory[name_at : name_at + name].decode()
        at = name_at + name + extra + note
        if method == 0:
            local = struct.unpack("<4s5H3L2H", source.read(start, LOCAL_SIZE))
            if local[0] != LOCAL_SIGNATURE:
                raise ValueError(f"no local header for {text}")
            out[text] = Member(text, start + LOCAL_SIZE + local[9] + local[10], packed)
    return out


def _record(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None) -> bytes:
    named = "none" if page is None else str(page)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{named}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _packed(record: bytes) -> bytes:
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress(record) + squeeze.flush()


class _Archive:
    """An archive that is being filled."""

    def __init__(self) -> None:
        self.records, self.index = io.BytesIO(), []

    def add(self, page: int | None, record: bytes) -> None:
        packed = _packed(record)
        self.index.append(json.dumps({"id": page, "offset": self.records.tell(), "length": len(packed)}))
        self.records.write(packed)

    def content(self) -> bytes:
        """The ZIP file. Its comment is one line feed: the one that Spark's writer puts after a row."""
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as packed:
            packed.writestr(zipfile.ZipInfo(RECORDS), self.records.getvalue())
            packed.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index) + "\n")
            packed.comment = b"\n"
        return out.getvalue()[:-1]


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def closed(archive: _Archive) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([archive.content()], pa.binary())], names=["content"])

    archive = _Archive()
    for batch in batches:
        for page, url, html, sha1, refers in zip(*(c.to_pylist() for c in batch.columns)):
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            archive.add(page, _record(page, url, (html or "").encode(errors="replace"), digest, refers))
            if archive.records.tell() >= ARCHIVE_BYTES:
                yield closed(archive)
                archive = _Archive()
    if archive.index:
        yield closed(archive)


def write_archives(
    pages: DataFrame, page: str, url: str, html: str, folder: str, least_bytes: int = LEAST_BYTES
) -> None:
    """Write every row as a WARC record into archives in ``folder``.

    Of equal payloads (SHA-1 and length) of at least ``least_bytes`` bytes, the rows with the smallest
    page id are responses and the others revisits of it; where all their ids are NULL, and below
    ``least_bytes``, all are responses. A NULL payload is empty, a NULL url is left out. Only digests
    are grouped; the list of repeated payloads is joined back, by broadcast where its size allows.
    """
    rows = pages.select(F.col(page).cast("bigint").alias("page"), F.col(url).cast("string").alias("url"),
                        F.col(html).alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.withColumns({"sha1": F.sha1(payload), "_size": F.octet_length(payload)})
    same = rows.where(F.col("_size") >= least_bytes).groupBy("sha1", "_size").agg(
        F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    same = staged(same.drop("n"), "payloads")
    told = rows.join(same, ["sha1", "_size"], "left")
    refers = F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first"))
    packed = map_arrow(told.select("page", "url", "html", "sha1", refers.alias("refers")), _archives, "content binary")
    packed.select(F.col("content").cast("string").alias("content")).write.option(
        "maxRecordsPerFile", 1).text(folder)


def records(source: Ranges) -> Iterator[tuple[int | None, int, str, str, int | None]]:
    """(page, payload bytes, digest, type, refers to) of every record, each read as one range."""
    found = members(source)
    index = source.read(found[INDEX].offset, found[INDEX].size)
    for line in index.decode().splitlines():
        place = json.loads(line)
        record = zlib.decompress(source.read(found[RECORDS].offset + place["offset"], place["length"]), 31)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and (
                len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        named = fields["WARC-Record-ID"][len("<urn:page:") : -1]
        refers = fields.get("WARC-Refers-To")
        yield (None if named == "none" else int(named), size, digest, kind,
               refers and int(refers[len("<urn:page:") : -1]))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(*(c.to_pylist() for c in batch.columns)):
            source = FileRanges(path) if content is None else BytesRanges(content)
            try:
                rows = list(zip(*records(source)))
            finally:
                source.close()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(r, k) for r, k in zip(rows or [[]] * 5, kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of all records in ``folder``.

    Files of a mounted folder are read by ranges where they lie; those of other stores come through
    Spark's binary file source, one archive at a time, and are read by ranges of that. Size and digest
    of a response are those of the payload read; a revisit's are in its headers.
    """
    files = spark.read.format("binaryFile").load(folder).where("length > 0")
    mounted = F.col("path").startswith("file:")
    local = folder.startswith(("file:", "/")) and not files.where(~mounted).select("path").head(1)
    content = F.lit(None).cast("binary") if local else F.col("content")
    path = F.regexp_replace("path", "^file:/*", "/")
    return map_arrow(
        files.select(path.alias("path"), content.alias("content")), _read,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def query(spark: SparkSession, folder: str) -> DataFrame:
    prepared(spark)
    archives = fresh_folder(spark, "archives")
    write_archives(table(spark, folder, "pages"), "page_id", "url", "html", archives)
    return read_archives(spark, archives)


CHECK = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
told AS (
  SELECT page_id, h, sha1(h) AS s,
    CASE WHEN strlen(h) >= {LEAST_BYTES} THEN min(page_id) OVER (PARTITION BY h) END AS first FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(s, (1 + 10 * (i // 8))::INT, 10))::UBIGINT >> (35 - 5 * (i % 8))::UBIGINT) & 31)::INT, 1)), '')
    AS payload_digest,
  CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM told
"""
