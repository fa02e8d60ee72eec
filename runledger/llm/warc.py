"""Operator 13, WARC archives: a writer and a salvage reader.

The writer puts each page into a gzip member of its own. Pages with equal payloads are stored once, as a
response; the others are revisit records that keep the HTTP header and refer to it. The reader checks every
record (member checksum, lengths, digests). Where a check fails it searches for the next gzip member or
version line that opens a valid record, goes on from there, and logs the bytes between as a quarantined gap,
so the records and gaps of a file cover it without overlap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small

ARCHIVE_BYTES = 16 << 20  # record bytes after which a task starts its next archive
HEADER_BYTES = 1 << 20    # longest header that is looked for
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
END = b"\r\n\r\n"
MANDATORY = {"warc-record-id", "content-length", "warc-date", "warc-type"}

RECORD_SCHEMA = ("file string, offset long, length long, kind string, record_type string, record_id string, target_uri string, "
                 "payload_bytes long, payload_digest string, refers_to string, reason string, payload binary")


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"Content-Length: %d\r\n\r\n" % len(block) + block + END


def member(data: bytes) -> bytes:
    """One gzip member (no time stamp, so equal input gives equal bytes)."""
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record_id(ident: str, payload_digest: str) -> str:
    return f"<urn:page:{ident}:{payload_digest}>"


def page_record(ident: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool, date: str) -> bytes:
    """A page as a response record, or as a revisit of the page ``first``, which has the same payload."""
    d = digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = "" if ident is None else str(ident)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(name, d)), ("WARC-Date", date)]
    if url is not None:  # white space and controls would end the header line
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("" if first is None else str(first), d))]
    fields += [("WARC-Payload-Digest", "sha1:" + d), ("WARC-Block-Digest", "sha1:" + digest(block)),
               ("Content-Type", "application/http; msgtype=response")]
    return record(fields, block)


def parse_record(buf: bytes, at: int) -> tuple[dict, bytes, int] | str:
    """(fields, block, end) of the record that starts at ``at``, or why there is no valid one."""
    if not START.match(buf, at) or buf[at:at + 1] == b"\x1f":
        return "no version line"
    stop = buf.find(END, at, at + HEADER_BYTES)
    if stop < 0:
        return "no end of header"
    fields = {}
    for line in buf[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "header line without colon"
        key = name.strip().lower().decode("latin-1")
        if key in fields and key != "warc-concurrent-to":
            return "header field repeated"
        fields[key] = value.strip().decode("utf-8", "replace")
    if not MANDATORY <= fields.keys():
        return "mandatory field missing"
    size = fields["content-length"]
    if not re.fullmatch(r"\d{1,18}", size, re.ASCII):
        return "content length is no number"
    body, end = stop + 4, stop + 4 + int(size)
    if buf[end:end + 4] != END:
        return "record end not where its length says"
    block = buf[body:end]
    told = fields.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != digest(block):
        return "block digest differs"
    if fields.get("warc-type") == "response" and fields.get("warc-payload-digest", "").startswith("sha1:"):
        if fields["warc-payload-digest"][5:] != digest(payload_of(fields, block)):
            return "payload digest differs"
    return fields, block, end + 4


def payload_of(fields: dict, block: bytes) -> bytes:
    """What follows the HTTP header of an HTTP message; else the whole block."""
    if fields.get("content-type", "").replace(" ", "").startswith("application/http"):
        head, _, rest = block.partition(END)
        return rest
    return block


def open_at(buf: bytes, at: int) -> tuple[dict, bytes, int] | str:
    """As parse_record, for a plain record or a gzip member that holds exactly one."""
    if buf[at:at + 2] != b"\x1f\x8b":
        return parse_record(buf, at)
    z = zlib.decompressobj(31)
    view = memoryview(buf)[at:]
    try:
        data = z.decompress(view)
    except zlib.error:
        return "member does not decompress"
    if not z.eof:
        return "member is cut off"
    got = parse_record(data, 0)
    if isinstance(got, str):
        return got
    return (*got[:2], len(buf) - len(z.unused_data)) if got[2] == len(data) else "member holds more than a record"


def salvage(buf: bytes) -> Iterator[tuple]:
    """("record", offset, length, fields, block) and ("gap", offset, length, reason), in order, covering ``buf``."""
    at = 0
    while at < len(buf):
        got = open_at(buf, at)
        if not isinstance(got, str):
            yield "record", at, got[2] - at, got[0], got[1]
            at = got[2]
            continue
        reason, gap = got, at
        while True:
            near = START.search(buf, at + 1)
            at = near.start() if near else len(buf)
            if not near or not isinstance(open_at(buf, at), str):
                break
        yield "gap", gap, at - gap, reason


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                min_revisit: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write every row of ``pages`` as a record of gzip-member archives under ``path``.

    Of rows with equal payloads of at least ``min_revisit`` bytes, the one with the largest id is the
    response and the others revisit it; rows that repeat the largest id are responses each, and so are
    all where no row has an id. A null html is an empty payload, a null url gives no target field, a null
    id an empty one. An archive ends with a metadata record that counts its records, and holds about
    ARCHIVE_BYTES of record bytes (more where one record is larger). An empty table writes no record.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("same", F.sha2("payload", 256))
    copies = (rows.where(F.octet_length("payload") >= min_revisit).groupBy("same")
              .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "first"))
    rows = rows.join(small(copies), "same", "left")
    rows = rows.select("id", "url", "payload", "first", F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def close() -> pa.RecordBatch:
            n = str(len(parts)).encode()
            parts.append(member(record([("WARC-Type", "metadata"), ("WARC-Record-ID", "<urn:archive:end>"), ("WARC-Date", date),
                                        ("Content-Type", "application/warc-fields")], b"records: " + n + b"\r\n")))
            # the text sink ends a row with one separator byte: the last byte of the last, short member, which is 0
            return pa.record_batch([pa.array([b"".join(parts)[:-1]], pa.binary())], names=["archive"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                parts.append(member(page_record(*row, date)))
                size += len(row[2])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    parts, size = [], 0
        if parts:
            yield close()

    (rows.mapInArrow(archives, "archive binary").select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path))


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every record and every quarantined gap of the archives under ``path``.

    Columns: file, offset, length (bytes of the file), kind (``record`` or ``gap``); for records their
    type, id, target, payload length and digest and what they refer to (of a revisit, the length and
    digest of the payload that it stands for), with ``payload`` (binary) if asked; for gaps the reason
    why the first check failed. Files of gzip members, plain records or both are read. One file is one
    task's row, so a task's memory is bounded by the largest archive. Empty files give no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    names = [x.split(" ")[0] for x in RECORD_SCHEMA.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(x.split(" ")[0], types[x.split(" ")[1]]) for x in RECORD_SCHEMA.split(", ")])

    def rows(file: str, buf: bytes) -> Iterator[dict]:
        for kind, at, n, *rest in salvage(buf):
            row = dict.fromkeys(names) | {"file": file, "offset": at, "length": n, "kind": kind}
            if kind == "gap":
                yield row | {"reason": rest[0]}
                continue
            fields, block = rest
            row |= {"record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
                    "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to")}
            if row["record_type"] == "revisit":
                told = re.search(rb"\r\n[Cc]ontent-[Ll]ength: *(\d{1,18})\r\n", block)
                payload, row["payload_bytes"] = None, int(told[1]) if told else None
                row["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            else:
                payload = payload_of(fields, block)
                row |= {"payload_bytes": len(payload), "payload_digest": digest(payload)}
            yield row | ({"payload": payload} if with_payload else {})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0), b.column(1)):
                out, size = [], 0
                for row in rows(file.as_py(), content.as_py()):
                    out.append(row)
                    size += len(row["payload"] or b"") + 200
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return files.mapInArrow(read, RECORD_SCHEMA)


def page_id(record_id_col: str) -> F.Column:
    """The page id within a record id of :func:`page_record`; null where it has none."""
    got = F.regexp_extract(F.col(record_id_col), r"^<urn:page:(-?\d+):", 1)
    return F.when(got != "", got.cast("long"))
