"""WARC archives as seekable Zstandard bundles.

``write_archives`` turns pages into WARC records and groups them into bundles. In a bundle,
records fill independent Zstandard frames (a record never spans two), a skippable frame
holds the record index (identifier -> frame, offset inside the frame, length), and a
footer in the Zstandard seekable format lists the frame sizes. One record is read by
decompressing one frame. Whole archives are read through the same index: each frame is
decompressed once and every record is taken from its offset. A frame or record of 4 GiB or
more has no place in that format and is refused.

Of pages with equal payloads of at least ``min_revisit`` bytes, those with the largest id
are responses and the others are revisits without payload. Bundles are rows (name,
content) so that Spark writes them to any store; ``bundle.content`` is a complete file.

Null html counts as an empty payload, a null url leaves its header out, a null id reads
back as null and never becomes the response that others refer to. Repeated rows give
repeated records. Tables without rows give no bundle. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

INDEX_MAGIC = 0x184D2A50  # skippable frame
SEEK_MAGIC = 0x184D2A5E  # skippable frame of the seek table
SEEKABLE = 0x8F92EAB1  # last four bytes of a seekable file
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BUNDLES = "name string, content binary, records bigint"
_RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
)


def _name(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _id(name: str | None) -> int | None:
    return None if name is None or name == "<urn:page:none>" else int(name[len("<urn:page:") : -1])


def build_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; ``payload`` is None for a revisit, whose block has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if payload is None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    block = http + (payload or b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at ``at`` and the position behind it."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start, stop = end + 4, end + 4 + int(head["Content-Length"])
    body = data.index(b"\r\n\r\n", start, stop) + 4
    http = dict(x.split(": ", 1) for x in data[start : body - 4].decode().split("\r\n")[1:])
    response = head["WARC-Type"] == "response"
    payload = data[body:stop] if response else None
    size = int(http["Content-Length"])  # a revisit's own statement: it carries no payload
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if response and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest or length")
    return {
        "page_id": _id(head["WARC-Record-ID"]), "url": head.get("WARC-Target-URI"), "payload_bytes": len(payload) if response else size,
        "payload_digest": digest, "record_type": head["WARC-Type"], "refers_to": _id(head.get("WARC-Refers-To")), "payload": payload,
    }, stop + 4


class BundleWriter:
    """Collects records into frames and frames into one bundle."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes = frame_bytes
        self.codec = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.size = 0

    def add(self, name: str, record: bytes) -> None:
        if len(record) >= 1 << 32:
            raise ValueError(f"record {name} has {len(record)} bytes: the seek table holds 32-bit sizes")
        if self.open and self.open_bytes + len(record) > self.frame_bytes:
            self._close_frame()
        self.index.append((name, len(self.frames), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)

    def _close_frame(self) -> None:
        frame = self.codec.compress(b"".join(self.open))
        self.frames.append(frame)
        self.sizes.append((len(frame), self.open_bytes))
        self.size += len(frame)
        self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        if self.open:
            self._close_frame()
        index = self.codec.compress(json.dumps(self.index).encode())
        index = struct.pack("<II", INDEX_MAGIC, len(index)) + index
        entries = [*self.sizes, (len(index), 0)]
        table = b"".join(struct.pack("<II", a, b) for a, b in entries) + struct.pack("<IBI", len(entries), 0, SEEKABLE)
        return b"".join([*self.frames, index, struct.pack("<II", SEEK_MAGIC, len(table)), table])


class BundleReader:
    """Random access to the records of a bundle."""

    def __init__(self, content: bytes):
        count, flags, magic = struct.unpack("<IBI", content[-9:])
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        width = 12 if flags & 0x80 else 8
        table = content[-9 - count * width : -9]
        self.content = content
        self.spans, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", table, i * width)
            self.spans.append((at, packed, plain))
            at += packed
        start, packed, _ = self.spans.pop()  # the index is the last entry
        self.codec = zstandard.ZstdDecompressor()
        self.index = json.loads(self.codec.decompress(content[start + 8 : start + packed]))

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.spans[number]
        return self.codec.decompress(self.content[at : at + packed], max_output_size=plain)

    def records(self) -> Iterator[dict]:
        """Every record, by the index."""
        yield from self._at(self.index)

    def find(self, names: set[str]) -> Iterator[dict]:
        """The named records."""
        yield from self._at(entry for entry in self.index if entry[0] in names)

    def _at(self, entries: Iterable[tuple[str, int, int, int]]) -> Iterator[dict]:
        """The records of index entries, which come by frame: each frame is decompressed once."""
        open_frame, data = -1, b""
        for name, number, offset, length in entries:
            if number != open_frame:
                open_frame, data = number, self.frame(number)
            record, end = parse_record(data, offset)
            if _name(record["page_id"]) != name or end != offset + length:
                raise ValueError(f"the index is wrong about {name}")
            yield record


def plan_records(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """Payload, digest and record type of every page; revisits carry no payload."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", F.encode(html, "UTF-8").alias("payload")).withColumns(
        {"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    # only payload groups of two or more rows travel to the join; they are written first, so
    # that both sides of the join are plain exchanges, whose hot digests are split
    copies = (
        rows.where(F.col("payload_bytes") >= min_revisit)
        .groupBy("payload_digest").agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND newest IS NOT NULL").drop("n")
    )
    copies = stage(copies, "copies")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(copies, "payload_digest", "left").select(
        "page_id", "url", "payload_bytes", "payload_digest",
        F.when(revisit, F.col("newest")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(pages: DataFrame, min_revisit: int = 1000, frame_bytes: int = 256 << 10, bundle_bytes: int = 4 << 20, level: int = 3) -> DataFrame:
    """Bundles (name, content, records) holding a record of every page.

    A task keeps one open bundle of about ``bundle_bytes``; nothing is collected.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer = TaskContext.get().partitionId(), 0, None

        def done() -> pa.RecordBatch:
            name, content = f"pages-{part:06d}-{number:05d}.warc.zst", writer.finish()
            return pa.RecordBatch.from_pydict({"name": [name], "content": pa.array([content], pa.binary()), "records": pa.array([len(writer.index)], pa.int64())})

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")]
            for i in range(batch.num_rows):
                page, url, payload, size, digest, refers = (c[i].as_py() for c in columns)
                writer = writer or BundleWriter(frame_bytes, level)
                writer.add(_name(page), build_record(page, url, payload, size, digest, refers))
                if writer.size >= bundle_bytes:
                    yield done()
                    writer, number = None, number + 1
        if writer:
            yield done()

    return plan_records(pages, min_revisit).mapInArrow(bundle, _BUNDLES)


def _rows(records: list[dict]) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in records], k) for c, k in kinds], [c for c, _ in kinds])


def read_archives(bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles, by the index of each; digests and lengths are checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                reader, found = BundleReader(content.as_py()), []
                for record in reader.records():
                    found.append(record if payloads else record | {"payload": None})
                    if len(found) == 256:
                        yield _rows(found)
                        found = []
                if found:
                    yield _rows(found)

    return bundles.select("content").mapInArrow(read, _RECORDS)


def fetch_records(bundles: DataFrame, wanted: list[int]) -> DataFrame:
    """The records of a stated list of page ids, reading only the frames that hold them."""
    names = {_name(i) for i in wanted}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                if found := list(BundleReader(content.as_py()).find(names)):
                    yield _rows(found)

    return bundles.select("content").mapInArrow(read, _RECORDS)
