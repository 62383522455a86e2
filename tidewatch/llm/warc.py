"""WARC archives: one gzip member per record, written and read sequentially.

Pages with equal payloads are stored once: the row with the largest page id is the response, the
others are revisits that name it. The reader inflates one member at a time from a stream, takes as
many bytes as Content-Length says, and verifies block and payload digests; it holds one record.

Nulls and edge cases: a null html is an empty payload; a null url leaves the target out, control
characters in one are percent-encoded; rows without a page id get a record id from their contents,
are never named by others, and are responses where their group has no id at all; rows that repeat
the largest id are each responses. An empty table gives no archive. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.folders import create, open_stream, shared_folder, written

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, digests_ok boolean"
)
CHUNK = 1 << 16
CONTROL = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:sha1:{payload_digest}>"


def format_record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str
) -> bytes:
    """A response, or a revisit of the page ``refers_to``, as the bytes of one record."""
    digest = sha1_base32(payload)
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to, digest)}"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes
    digests_ok: bool

    def header(self, name: str) -> str | None:
        return self.headers.get(name.lower())


class _Member:
    """The inflated bytes of one gzip member, as they are asked for."""

    def __init__(self, stream, left: bytes) -> None:
        self.stream, self.raw, self.inflater, self.held = stream, left, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        if self.inflater.eof:
            return False
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
            if not self.raw:
                raise EOFError("the archive ends within a record")
        self.held += self.inflater.decompress(self.raw, CHUNK)
        self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        at = self.held.find(mark)
        while at < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self._more():
                raise ValueError("a record's header doesn't end")
            at = self.held.find(mark, seen)
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def take(self, count: int) -> bytes:
        while len(self.held) < count:
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length")
        out = bytes(self.held[:count])
        del self.held[:count]
        return out

    def end(self) -> bytes:
        """Check that the member ends with the record; the raw bytes behind it."""
        while self._more():
            pass
        if self.held != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        return self.raw


def _headers(lines: bytes) -> dict[str, str]:
    out = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def read_records(stream) -> Iterator[Record]:
    """The records of an archive in order; holds one at a time."""
    left = stream.read(CHUNK)
    while left:
        member = _Member(stream, left)
        headers = _headers(member.until(b"\r\n\r\n"))
        block = member.take(int(headers["content-length"]))
        left = member.end() or stream.read(CHUNK)
        good = headers.get("warc-block-digest") == f"sha1:{sha1_base32(block)}"
        if headers.get("warc-type") == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            good &= headers.get("warc-payload-digest") == f"sha1:{sha1_base32(payload)}"
        yield Record(headers, block, good)


# ---------------------------------------------------------------- archives of a table


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = 1 << 30,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives; the manifest (``MANIFEST``) of those that count.

    Payloads shorter than ``least_bytes`` are always responses. Only hashes and ids are grouped to
    find equal payloads; the html moves at most once, to meet its group's largest id, and a frequent
    payload's rows can be split over tasks, as the other side has one row for it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, done = TaskContext.get().partitionId(), None, []

        def close():
            out.close()
            done.append((uri, records, size))

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    uri, records, size = f"{folder}/pages-{task:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = create(uri)
                data = gzip_member(format_record(page_id, url, html.encode(), refers_to, date))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        for path, records, size in done:
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.sha2(F.encode(html, "utf-8"), 256).alias("key"),
    )
    groups = rows.where(F.octet_length("html") >= least_bytes).groupBy("key").agg(
        F.max("page_id").alias("response"), F.count("*").alias("n")
    ).where("n > 1").drop("n")
    revisits = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    typed = rows.join(groups, "key", "left").select(
        "page_id", "url", "html", F.when(revisits, F.col("response")).alias("refers_to")
    )
    return written(typed.mapInArrow(write, MANIFEST), "warc-manifest")


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives (``RECORDS``), with the response's payload if asked for."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
            ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("digests_ok", pa.bool_()), *([("payload", pa.binary())] if payload else []),
        ])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held, size = [], 0
                with open_stream(path) as stream:
                    for record in read_records(stream):
                        held.append(_row(record, payload))
                        size += len(record.block) if payload else 200
                        if size >= 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = manifest.select("path").repartition(max(1, manifest.count()))
    return files.mapInArrow(read, RECORDS + (", payload binary" if payload else ""))


def _row(record: Record, payload: bool) -> dict:
    http, _, body = record.block.partition(b"\r\n\r\n")
    response = record.header("WARC-Type") == "response"
    row = {
        "page_id": _page(record.header("WARC-Record-ID")),
        "url": record.header("WARC-Target-URI"),
        "record_type": record.header("WARC-Type"),
        "refers_to": _page(record.header("WARC-Refers-To")),
        "payload_bytes": int(_headers(http)["content-length"]),
        "payload_digest": record.header("WARC-Payload-Digest").removeprefix("sha1:"),
        "digests_ok": record.digests_ok,
    }
    return row | {"payload": body if response else None} if payload else row


def warc_round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), payload)
