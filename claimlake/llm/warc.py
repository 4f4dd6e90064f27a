"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each holding whole WARC records of about
``frame_bytes``, followed by a seek table in a skippable frame (the public "seekable format":
per frame its compressed and uncompressed size, then a footer). The index that writing returns maps every
record id to its bundle, frame and offset inside the uncompressed frame, so one record costs
one range read. Tasks write bundles straight to shared storage (any file system that
pyarrow knows) under names of their own; a lost or repeated attempt leaves a file that no index
row names.

Duplicates are found on digests only; the pages are shuffled once, by row, so equal payloads
do not meet in one task.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, shared_path, stash

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FRAME_BYTES, BUNDLE_BYTES, LEAST_SHARED = 1 << 20, 256 << 20, 1000
#: Records that a reading task holds at a time.
READ_BYTES = 1 << 20
INDEX = "record_id string, page string, bundle string, frame int, offset long, length long"
RECORD = ("page string, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to string, payload binary")


def record_uri(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def _line(value: str) -> str:
    return "".join(c if c not in "\r\n" else f"%{ord(c):02X}" for c in value)


def build_record(page: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool,
                 date: str) -> tuple[str, bytes]:
    """(record id, record): a response with the payload, or a revisit without it."""
    sha = hashlib.sha1(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not revisit:
        block += payload
    ident = record_uri(page, sha.hexdigest())
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {ident}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if page is not None:
        head.append(f"Page-Id: {_line(page)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_uri(refers_to, sha.hexdigest())}",
                 f"Refers-To-Page-Id: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ident, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes, start: int) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n", start)
    lines = data[start:end].decode("utf-8").split("\r\n")
    return dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:]), end + 4


def parse_record(record: bytes) -> dict:
    """The columns of RECORD; a revisit's payload is null, its size and digest those recorded."""
    head, at = _headers(record, 0)
    block = record[at:at + int(head["Content-Length"])]
    http, body = _headers(block, 0)
    payload = block[body:] if head["WARC-Type"] == "response" else None
    stated = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(http["Content-Length"])
    if payload is not None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != stated):
        raise ValueError(f"damaged record {head['WARC-Record-ID']}")
    return {"page": head.get("Page-Id"), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"],
            "payload_bytes": size, "payload_digest": stated, "refers_to": head.get("Refers-To-Page-Id"),
            "payload": payload}


def open_shared(uri: str):
    """(file system, path) of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(uri)


class BundleWriter:
    """Writes one bundle; ``add`` returns (frame, offset, length) of the record."""

    def __init__(self, uri: str, frame_bytes: int = FRAME_BYTES, level: int = 3):
        fs, path = open_shared(uri)
        self.out = fs.open_output_stream(path, compression=None)
        self.codec = zstandard.ZstdCompressor(level=level)
        self.frame_bytes, self.frames, self.buffer, self.written = frame_bytes, [], bytearray(), 0

    def add(self, record: bytes) -> tuple[int, int, int]:
        if self.buffer and len(self.buffer) + len(record) > self.frame_bytes:
            self._end_frame()
        at = (len(self.frames), len(self.buffer), len(record))
        self.buffer += record
        return at

    def _end_frame(self) -> None:
        packed = self.codec.compress(bytes(self.buffer))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.buffer)))
        self.written += len(self.buffer)
        self.buffer = bytearray()

    def close(self) -> None:
        if self.buffer:
            self._end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()


class BundleReader:
    """Random access to the frames of a bundle by its seek table."""

    def __init__(self, uri: str):
        fs, path = open_shared(uri)
        self.file, size = fs.open_input_file(path), fs.get_file_info(path).size
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{uri} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.frames, at = [], 0
        for i in range(count):
            packed, whole = struct.unpack_from("<II", table, 8 * i)
            self.frames.append((at, packed, whole))
            at += packed
        self.codec, self.now, self.data = zstandard.ZstdDecompressor(), -1, b""

    def record(self, frame: int, offset: int, length: int) -> bytes:
        if frame != self.now:
            at, packed, whole = self.frames[frame]
            self.data, self.now = self.codec.decompress(self.file.read_at(packed, at), max_output_size=whole), frame
        return self.data[offset:offset + length]


def one_by_one(payloads: pa.Array) -> Iterator[bytes]:
    """The values of a column, each copied out of its batch when it is due; no list of all of them is made."""
    return (x.as_py() for x in payloads)


def revisits(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """(``row_key``, ``refers_to``) of pages whose payload, of ``least`` bytes or more, belongs to
    a page with a larger id. Only digests are shuffled; their maxima are summed up map-side."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    narrow = stash(pages.select(F.col(id_col).alias("id"), F.sha1(html).alias("digest"),
                                F.octet_length(html).alias("bytes"), row_key(id_col, html_col).alias("row_key"))
                   .filter(F.col("bytes") >= least), "payloads")
    last = (narrow.groupBy("digest", "bytes").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1 and last is not null"))
    return (narrow.join(last, ["digest", "bytes"]).filter("id is null or id <> last")
            .select("row_key", F.col("last").cast("string").alias("refers_to")).distinct())


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", least: int = LEAST_SHARED, frame_bytes: int = FRAME_BYTES,
               bundle_bytes: int = BUNDLE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write one record per row of ``pages`` into bundles under ``folder`` (the shared folder unless
    given) and return the index (``INDEX``; ``page`` is the id as text), itself written to the shared folder.

    Of equal payloads of ``least`` bytes or more, the page with the largest id is a response and the
    others revisit it; smaller payloads are all responses. Null html is empty, a null url is left
    out, a null id loses to any other and is left out of the record. Rows repeating a response's
    page are responses too. An empty table writes nothing and gives an empty index.
    """
    folder = folder or shared_path(pages.sparkSession, "warc")
    fs, path = open_shared(folder)
    fs.create_dir(path, recursive=True)
    keyed = pages.select(F.col(id_col).cast("string").alias("page"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("html"), row_key(id_col, html_col).alias("row_key"))
    rows = keyed.join(revisits(pages, id_col, html_col, least), "row_key", "left").drop("row_key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("record_id", pa.string()), ("page", pa.string()), ("bundle", pa.string()),
                            ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])
        bundle, name = None, ""
        for b in batches:
            index = []
            for page, url, html, to in zip(b.column("page").to_pylist(), b.column("url").to_pylist(), one_by_one(b.column("html")),
                                           b.column("refers_to").to_pylist()):
                if bundle is None:
                    name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                    bundle = BundleWriter(name, frame_bytes)
                ident, record = build_record(page, url, html, to, to is not None, date)
                index.append((ident, page, name, *bundle.add(record)))
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    bundle = None
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*index), schema)], schema=schema) \
                if index else pa.RecordBatch.from_pylist([], schema)
        if bundle is not None:
            bundle.close()
    return stash(rows.mapInArrow(write, INDEX), "warc-index")


def read_warc(index: DataFrame) -> DataFrame:
    """The records (``RECORD``) that the rows of an index name, each read by its frame and offset.
    Rows of a frame are read together; a frame holds about ``frame_bytes`` whatever the bundle's size."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("refers_to", pa.string()), ("payload", pa.binary())])
        name, bundle, rows, size = None, None, [], 0
        for b in batches:
            for n, frame, offset, length in zip(*(b.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length"))):
                if n != name:
                    name, bundle = n, BundleReader(n)
                rows.append(parse_record(bundle.record(frame, offset, length)))
                size += length
                if size >= READ_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)
    places = index.select("bundle", "frame", "offset", "length")
    return (places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset")
            .mapInArrow(read, RECORD))
