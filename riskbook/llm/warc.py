"""WARC records in seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames of about `FRAME_BYTES` of records each, then a
skippable frame that maps record identifiers to (frame, offset in the frame, length), then the seek table:
a skippable frame with the compressed and plain size of every frame.  A plain Zstandard reader reads
the bundle as one WARC file; `Bundle` reads any record by its identifier, decompressing one frame.

Of records with equal payloads the one of the smallest page_id (the first of equal rows) is a response
with the payload, the others are revisits that name it; payloads under `least` bytes are all responses.

Tasks write bundles under passing names and rename them, so a task that runs again leaves the same.

Defined cases: a null html is an empty payload; a null url becomes ``urn:page:<page_id>``; null page_ids come
after all others; equal rows are separate records; an empty table gives no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.storage import get_file, get_range, put_file, scratch, store

#: Fixed values of the seekable Zstandard format, and the skippable frame used for the record index.
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 32 * 1024 * 1024
ENTRY = "<16sIIQ"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # of all records, so that a rerun writes the same bytes


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, nth: int) -> bytes:
    """16 bytes, written as a UUID."""
    return hashlib.md5(f"{page_id}/{digest}/{nth}".encode()).digest()


def urn(identifier: bytes) -> str:
    h = identifier.hex()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, nth: int, first: tuple | None) -> tuple[bytes, bytes]:
    """Identifier and bytes of a record; `first` is (page_id,) of the response that a revisit names."""
    identifier = record_id(page_id, digest, nth)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first else http + payload
    target = (url or f"urn:page:{page_id}").replace("\r", "%0D").replace("\n", "%0A")
    fields = {
        "WARC-Type": "revisit" if first else "response",
        "WARC-Record-ID": urn(identifier),
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
    }
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    if first:
        fields |= {"WARC-Profile": REVISIT, "WARC-Refers-To": urn(record_id(first[0], digest, 1))}
        if first[0] is not None:
            fields["Refers-To-Page-ID"] = str(first[0])
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return identifier, head.encode() + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record that begins at a place, and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(fields["Content-Length"])
    return fields, data[start:stop], stop + 4


# -- bundles -----------------------------------------------------------------------


class BundleWriter:
    """Collects records into frames; `finish` gives the parts of the file."""

    def __init__(self, level: int = 3):
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[tuple[bytes, int]] = []
        self.index: list[tuple[bytes, int, int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = 0
        self.total = 0

    def add(self, identifier: bytes, data: bytes) -> None:
        self.index.append((identifier, len(self.frames), self.open_bytes, len(data)))
        self.open.append(data)
        self.open_bytes += len(data)
        self.total += len(data)
        if self.open_bytes >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.open:
            self.frames.append((self.compressor.compress(b"".join(self.open)), self.open_bytes))
            self.open, self.open_bytes = [], 0

    def finish(self) -> list[bytes]:
        self.close_frame()
        entries = b"".join(struct.pack(ENTRY, *entry) for entry in sorted(self.index))
        index = struct.pack("<II", SKIPPABLE, len(entries)) + entries
        frames = [*self.frames, (index, 0)]
        table = b"".join(struct.pack("<II", len(data), plain) for data, plain in frames)
        foot = struct.pack("<IBI", len(frames), 0, SEEKABLE)
        return [*(data for data, _ in frames), struct.pack("<II", SEEK_TABLE, len(table) + len(foot)), table, foot]


class Bundle:
    """Reads parts of a bundle through `read(start, length)`, where a negative start counts from the end."""

    FOOT = 9

    def __init__(self, read):
        self.read = read
        frames, _, magic = struct.unpack("<IBI", read(-self.FOOT, self.FOOT))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end")
        size = 8 * frames
        raw = read(-self.FOOT - size, size)
        self.frames, at = [], 0
        for i in range(frames):
            packed, plain = struct.unpack_from("<II", raw, 8 * i)
            self.frames.append((at, packed, plain))
            at += packed

    def index(self) -> dict[bytes, tuple[int, int, int]]:
        """Frame, offset in the frame and length of every record."""
        at, packed, _ = self.frames[-1]
        raw = self.read(at + 8, packed - 8)
        return {i: place for i, *place in struct.iter_unpack(ENTRY, raw)}

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.read(at, packed), max_output_size=plain)

    def record(self, identifier: bytes) -> tuple[dict[str, str], bytes]:
        frame, offset, _ = self.index()[identifier]
        return parse(self.frame(frame), offset)[:2]

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for number in range(len(self.frames) - 1):
            data, at = self.frame(number), 0
            while at < len(data):
                fields, block, at = parse(data, at)
                yield fields, block


def open_bundle(folder: str, file: str) -> Bundle:
    return Bundle(lambda start, length: get_range(folder, file, start, length))


# -- Spark -----------------------------------------------------------------------------


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per (page_id, payload digest): key, and the page_id of the payload's response.

    Only identifiers and digests move; a payload's smallest page_id is found by a sum in each task
    first.  `named` is false where all records of the payload are responses.
    """
    html = F.coalesce("html", F.lit(""))
    pairs = store(
        pages.select("page_id", F.unhex(F.sha1(html.cast("binary"))).alias("digest"), F.octet_length(html).alias("bytes")).distinct(),
        "payloads",
    )
    order = F.struct(F.col("page_id").isNull(), "page_id")
    first = pairs.groupBy("digest").agg(F.min(order).alias("first")).select(F.col("digest").alias("d"), F.col("first.page_id").alias("first"))
    return pairs.join(first, F.col("digest") == F.col("d")).select(
        _key(F.col("page_id"), F.col("digest")).alias("key"), "first", (F.col("bytes") >= least).alias("named")
    )


def _key(page_id: Column, digest: Column) -> Column:
    return F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), F.hex(digest)))


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer = TaskContext.get().partitionId(), 0, BundleWriter()

        def flush() -> pa.RecordBatch:
            nonlocal number, writer
            name = f"{part:07d}-{number:07d}.warc.zst"
            parts = writer.finish()
            put_file(folder, name, parts)
            row = {"file": [name], "records": [len(writer.index)], "bytes": [sum(map(len, parts))]}
            number, writer = number + 1, BundleWriter()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("page_id", "url", "nth", "first", "named"))
            for i, (page_id, url, nth, first, named) in enumerate(zip(*columns, strict=True)):
                payload = (batch.column("html")[i].as_py() or "").encode()
                again = named and not (page_id == first and nth == 1)
                writer.add(*record(page_id, url, payload, payload_digest(payload), nth, (first,) if again else None))
                if writer.total >= BUNDLE_BYTES:
                    yield flush()
        if writer.index:
            yield flush()

    return run


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write `pages` (page_id, url, html) as bundles into a folder; rows: file, records, bytes."""
    html = F.unhex(F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    rows = pages.select("page_id", "url", "html").withColumn("key", _key(F.col("page_id"), html))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("url")))
    placed = rows.join(roles(pages, least), "key").select("page_id", "url", "html", "nth", "first", "named")
    return store(placed.mapInArrow(_written(folder), "file string, records long, bytes long"), "bundles")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                data = get_file(folder, file)
                bundle = Bundle(lambda start, length, data=data: data[start:][:length])
                rows = []
                for fields, block in bundle.records():
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.decode().split("Content-Length: ")[1].split("\r\n")[0])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = fields["WARC-Type"]
                    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
                        raise ValueError(f"{file}: damaged record {fields['WARC-Record-ID']}")
                    page, first = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                    rows.append((page and int(page), size, digest, kind, first and int(first), fields["WARC-Record-ID"]))
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read(bundles: DataFrame, folder: str) -> DataFrame:
    """One row per record of the bundles, payloads held against their digests."""
    spread = bundles.select("file").repartition(max(1, bundles.count()), "file")
    return spread.mapInArrow(
        _read(folder),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string",
    )


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write bundles into a new folder of the cluster's shared one, and read them back."""
    folder = f"{scratch(pages.sparkSession)}/warc"
    return read(write(pages, folder, least), folder)
