"""Web archives in seekable Zstandard bundles: written by tasks, read back frame by frame."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from hashlib import sha256

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlake.llm.common import map_batches, shared_folder, written

#: Bytes of records after which a frame ends; a longer single record is a frame of its own.
FRAME_BYTES = 1 << 20
#: Bytes of records after which a bundle ends.
BUNDLE_BYTES = 64 << 20
LEVEL = 3
#: Shorter payloads are kept in full wherever they come.
LEAST_REVISIT = 100
# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
FOOTER, ENTRY, HEADER = "<IBI", "<III", "<II"
# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

_INDEX = "record_id string, bundle string, frame int, offset bigint, length bigint"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, from inside a task."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def record_id(page: int | None, digest: str) -> str:
    """The identifier of a page's record, known before it is written."""
    return str(uuid.UUID(bytes=sha256(f"{page}:{digest}".encode()).digest()[:16]))


def _target(url: str) -> str:
    """A URL without characters that end a header line or its value."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _record(kind: str, fields: dict[str, object], block: bytes) -> bytes:
    lines = [f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in fields.items() if value is not None)]
    lines.append(f"Content-Length: {len(block)}")
    return b"\r\n".join([VERSION, "\r\n".join(lines).encode(), b"", block, b"", b""])


def page_record(
    page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, date: str
) -> bytes:
    """A response with its payload or, if ``refers`` names a page with the same payload, a revisit without."""
    fields = {
        "WARC-Record-ID": f"<urn:uuid:{record_id(page, digest)}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else _target(url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Page-Id": page,
        "Payload-Length": len(payload),
        "Content-Type": HTTP_TYPE,
    }
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers is None:
        return _record("response", fields, head + payload)
    fields["WARC-Profile"] = REVISIT_PROFILE
    fields["WARC-Refers-To"] = f"<urn:uuid:{record_id(refers, digest)}>"
    fields["Refers-To-Page-Id"] = refers
    return _record("revisit", fields, head)


@dataclass
class Bundle:
    """An archive file being written: frames of whole records, then a table of the frames."""

    folder: str
    date: str
    name: str = field(default_factory=lambda: f"pages-{uuid.uuid4().hex}.warc.zst")

    def __post_init__(self) -> None:
        system, root = opened(self.folder)
        self.out = system.open_output_stream(f"{root}/{self.name}", compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[str, str, int, int, int]] = []
        self.size = 0
        info = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": self.date, "WARC-Filename": self.name}
        first = _record("warcinfo", info | {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
        self.frame = [first]
        self.held = len(first)

    def add(self, identifier: str, record: bytes) -> None:
        if self.held and self.held + len(record) > FRAME_BYTES:
            self._end_frame()
        self.index.append((identifier, self.name, len(self.frames), self.held, len(record)))
        self.frame.append(record)
        self.held += len(record)
        self.size += len(record)

    def _end_frame(self) -> None:
        data = b"".join(self.frame)
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.frame, self.held = [], 0

    def close(self) -> list[tuple[str, str, int, int, int]]:
        """End the file; the index rows of its records."""
        self._end_frame()
        table = b"".join(struct.pack(ENTRY, *frame) for frame in self.frames)
        table += struct.pack(FOOTER, len(self.frames), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack(HEADER, SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        return self.index


def _first_pages(pages: DataFrame, least: int) -> DataFrame:
    """(digest, first) of payloads that several pages share; one row for each such payload."""
    long = pages.filter(F.col("bytes") >= least).groupBy("digest")
    shared = long.agg(F.min("page").alias("first"), F.count("*").alias("n"))
    return shared.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first")


def write(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = LEAST_REVISIT,
    date: str | None = None,
) -> DataFrame:
    """Write a record for every page into bundles below ``folder``; the index of the records.

    Of pages with equal payloads of at least ``least`` bytes that with the smallest key holds the payload
    and the others revisit it. Pages of that same smallest key (repeated rows) all hold it; pages without a key
    refer to it as others do, and hold the payload if none of the payload's pages has a key. A null
    payload is an empty one, a null URL is left out; other columns are ignored.

    A task writes its pages in the order it reads them, one frame in memory. Index rows (record_id,
    bundle, frame, offset, length) follow once their bundle is closed, and are written as the Parquet table
    ``folder/index``. Bundle names are new at every attempt, so one that a lost
    executor left is never in the index. An empty table gives an empty index.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    digested = pages.select(
        F.col(key).cast("long").alias("page"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    sized = digested.select("page", "digest", F.octet_length("payload").alias("bytes"))
    # Written, so that Spark knows its size: small ones are broadcast, others joined by digest.
    first = written(_first_pages(sized, least))
    refers = F.when(F.col("page").isNull() | (F.col("page") > F.col("first")), F.col("first"))
    records = digested.join(first, "digest", "left").select("page", "url", "payload", "digest", refers.alias("refers"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                bundle = bundle or Bundle(folder, date)
                bundle.add(record_id(row[0], row[3]), page_record(*row, date))
                if bundle.size >= BUNDLE_BYTES:
                    yield _index_batch(bundle.close())
                    bundle = None
        if bundle:
            yield _index_batch(bundle.close())

    path = f"{folder}/index"
    map_batches(records, run, _INDEX).write.parquet(path)
    return pages.sparkSession.read.parquet(path)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, ["record_id", "bundle", "frame", "offset", "length"])


def seek_table(file: pa.NativeFile, size: int) -> list[tuple[int, int, int, int]]:
    """(start, packed, size, checksum) of every frame, from the end of the file alone."""
    footer, entry = struct.calcsize(FOOTER), struct.calcsize(ENTRY)
    file.seek(size - footer)
    count, flags, magic = struct.unpack(FOOTER, file.read(footer))
    if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
        raise ValueError("no seek table with checksums at the end of the file")
    file.seek(size - footer - count * entry)
    frames, start = [], 0
    for packed, plain, checksum in struct.iter_unpack(ENTRY, file.read(count * entry)):
        frames.append((start, packed, plain, checksum))
        start += packed
    return frames


def read_frame(file: pa.NativeFile, start: int, packed: int, size: int, checksum: int) -> bytes:
    file.seek(start)
    data = zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=size)
    if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
        raise ValueError("a frame differs from its seek table")
    return data


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of a frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise ValueError("no record where one should begin")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def page_of(fields: dict[str, str], block: bytes) -> tuple:
    """(record_id, page_id, record_type, refers_to, payload_bytes, payload_digest, payload) of a page's record.

    A response's payload is measured and must be what its header says; a revisit has none, so its header counts.
    """
    number = lambda name: int(fields[name]) if name in fields else None
    digest, size, payload = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["Payload-Length"]), None
    if fields["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if (len(payload), sha256(payload).hexdigest()) != (size, digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its header")
    identifier = fields["WARC-Record-ID"].removeprefix("<urn:uuid:").removesuffix(">")
    return identifier, number("Page-Id"), fields["WARC-Type"], number("Refers-To-Page-Id"), size, digest, payload


def _dealt(rows: DataFrame, *by: str) -> DataFrame:
    """Few small rows that stand for much work, spread over all tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def frames(index: DataFrame, folder: str) -> DataFrame:
    """(bundle, frame, start, packed, size, checksum) of the bundles in an index, from their seek tables."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_file(f"{root}/{name}") as file:
                    table = seek_table(file, file.size())
                columns = [pa.array([name] * len(table)), pa.array(range(len(table)), pa.int32())]
                columns += [pa.array(values, pa.int64()) for values in zip(*table)]
                yield pa.RecordBatch.from_arrays(columns, ["bundle", "frame", "start", "packed", "size", "checksum"])

    schema = "bundle string, frame int, start bigint, packed bigint, size bigint, checksum bigint"
    return map_batches(_dealt(index.select("bundle").distinct(), "bundle"), run, schema)


_PAGE = "record_id string, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
_KINDS = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def _pages_batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    names = [part.split()[0] for part in _PAGE.split(", ")] + ["payload"]
    kept = len(names) if payloads else len(names) - 1
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)][:kept], names[:kept])


def read(index: DataFrame, folder: str) -> DataFrame:
    """(record_id, page_id, record_type, refers_to, payload_bytes, payload_digest) of every page's record.

    Frames are dealt over all tasks, so one bundle is read by many; a task holds one frame. Checksums of frames and
    digests of payloads are verified.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for batch in batches:
            for name, _, *place in zip(*(column.to_pylist() for column in batch.columns)):
                with system.open_input_file(f"{root}/{name}") as file:
                    data = read_frame(file, *place)
                found = [page_of(*record) for record in records(data) if record[0]["WARC-Type"] != "warcinfo"]
                yield _pages_batch([row[:-1] + (None,) for row in found], False)

    return map_batches(_dealt(frames(index, folder), "bundle", "frame"), run, _PAGE)


def lookup(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """As :func:`read` with ``payload``, of the records whose ``record_id`` is in ``wanted``, null if revisited.

    Only the frames that hold them are read, each once, and records are cut out at their offsets.
    """
    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    cuts = F.collect_list(F.struct("offset", "length")).alias("cuts")
    asked = places.groupBy("bundle", "frame").agg(cuts)
    held = frames(places, folder).join(asked, ["bundle", "frame"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        for batch in batches:
            for name, _, start, packed, size, checksum, cuts in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{root}/{name}") as file:
                    data = read_frame(file, start, packed, size, checksum)
                cut = (data[c["offset"] : c["offset"] + c["length"]] for c in cuts)
                yield _pages_batch([page_of(*record) for part in cut for record in records(part)], True)

    return map_batches(_dealt(held, "bundle", "frame"), run, f"{_PAGE}, payload binary")


def round_trip(spark: SparkSession, pages: DataFrame, key: str = "page_id", **columns: str) -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of every page, from archives written and read back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    found = read(write(pages, folder, key, **columns), folder)
    return found.select(
        F.col("page_id").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"
    )
