"""WARC archives in seekable Zstandard bundles.

Each writing task puts its records into bundle files: some records to an independent frame, frames one
after another, and at the end a skippable frame with the seek table (compressed and full size of each
frame). An index maps every record to its bundle, frame and offset within the frame. Reading takes the
index, fetches only the frames it needs and cuts the records out of them.

Payloads seen before are not stored again: of records with equal payloads of at least ``LEAST`` bytes
the one with the largest id is a response, the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 1000
FRAME_BYTES = 256 << 10  # a frame is closed once it holds as much
BUNDLE_BYTES = 64 << 20  # and a bundle, in compressed bytes
# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
CRLF = b"\r\n"
ID = "urn:page:"
INDEX = "page_id long, bundle string, frame int, frame_start long, frame_size long, record_start long, record_size long"
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def with_roles(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: the page each revisit refers to, null for responses.

    Only digests that occur more than once are joined back; counting them combines before the shuffle,
    and the joined side has one row per digest, so Spark can split a digest with very many pages."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    first = (
        rows.where((F.octet_length("payload") >= least) & F.col("page_id").isNotNull())
        .groupBy(F.col("digest").alias("_digest")).agg(F.max("page_id").alias("_kept"), F.count("*").alias("_n"))
        .where("_n > 1")
    )
    again = F.when(F.col("page_id") != F.col("_kept"), F.col("_kept"))
    return rows.join(first, rows.digest == first._digest, "left").select(
        "page_id", "url", F.when(again.isNull(), F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("size"), "digest", again.alias("refers_to"),
    )


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no block."""
    block = b"" if refers_to is not None else payload
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID}{'' if page_id is None else page_id}>",
        "WARC-Target-URI": None if url is None else url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{sha1}",
        "WARC-Payload-Length": str(size),
        "WARC-Refers-To": None if refers_to is None else f"<{ID}{refers_to}>",
        "WARC-Profile": None if refers_to is None else "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        "Content-Type": "text/html",
        "Content-Length": str(len(block)),
    }
    lines = [f"{name}: {value}".encode() for name, value in head.items() if value is not None]
    return CRLF.join([b"WARC/1.1", *lines, b"", b""]) + block + CRLF + CRLF


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    at = raw.index(CRLF + CRLF)
    lines = raw[:at].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record begins here: {lines[0][:40]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    return head, raw[at + 4 : at + 4 + int(head["Content-Length"])]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, full) sizes."""
    body = b"".join(struct.pack("<II", *frame) for frame in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed size, full size) of each frame, from the end of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * n)
    sizes = list(struct.iter_unpack("<II", file.read(8 * n)))
    starts = [0]
    for compressed, _ in sizes:
        starts.append(starts[-1] + compressed)
    return [(start, *both) for start, both in zip(starts, sizes)]


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; paths without a scheme are local."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class Bundles:
    """Writes records into bundles of a folder. Names are new for each attempt of a task, and only those
    the index names count, so an attempt that is lost leaves files that nothing refers to."""

    def __init__(self, folder: str):
        self.system, self.root = place(folder)
        self.name, self.out = "", None
        self.frames, self.size = [], 0
        self.held, self.rows = bytearray(), []
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, page_id: int | None, raw: bytes) -> list[tuple]:
        self.rows.append((page_id, len(self.held), len(raw)))
        self.held += raw
        return self.frame() if len(self.held) >= FRAME_BYTES else []

    def frame(self) -> list[tuple]:
        """Close the frame; index rows of its records."""
        if not self.rows:
            return []
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.zst"
            self.out = self.system.open_output_stream(f"{self.root}/{self.name}", compression=None)
        packed = self.compressor.compress(bytes(self.held))
        self.out.write(packed)
        rows = [
            (page_id, self.name, len(self.frames), self.size, len(packed), start, size)
            for page_id, start, size in self.rows
        ]
        self.frames.append((len(packed), len(self.held)))
        self.size += len(packed)
        self.held, self.rows = bytearray(), []
        if self.size >= BUNDLE_BYTES:
            self.close()
        return rows

    def close(self) -> None:
        if self.out is not None:
            self.out.write(seek_table(self.frames))
            self.out.close()
        self.out, self.frames, self.size = None, [], 0


def write(pages: DataFrame, folder: str, least: int = LEAST) -> DataFrame:
    """Write one record per row of ``pages`` under ``folder`` and return the index (stored beside the
    bundles), one row per record.

    Null html is an empty payload, a null url gives no target, a page without an id is always a
    response. Equal ids stay records of their own; other columns are ignored; an empty table writes no
    bundle. ``folder`` must be one all executors share."""
    index = f"{folder}/index"
    made = with_roles(pages, least).mapInArrow(_writer(f"{folder}/bundles"), INDEX)
    made.write.parquet(index)
    return pages.sparkSession.read.schema(INDEX).parquet(index)


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        system.create_dir(root, recursive=True)
        bundles = Bundles(folder)
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(i) for i in range(6))):
                values = [value.as_py() for value in row]
                rows += bundles.add(values[0], record(*values))
            if rows:
                yield _rows(rows, INDEX)
        rows = bundles.frame()
        bundles.close()
        if rows:
            yield _rows(rows, INDEX)

    return run


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records the index names, from their frames: ``page_id, url, payload_bytes, payload_digest,
    record_type, refers_to, payload`` (null for revisits). Frames are fetched whole, each by one task;
    index rows of a frame are few, whatever the payloads."""
    frames = index.groupBy("bundle", "frame").agg(
        F.collect_list(F.struct("record_start", "record_size")).alias("records")
    )
    return frames.mapInArrow(_reader(f"{folder}/bundles"), READ)


def _reader(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        decompressor = zstandard.ZstdDecompressor()
        for batch in batches:
            for frame in sorted(batch.to_pylist(), key=lambda f: (f["bundle"], f["frame"])):
                with system.open_input_file(f"{root}/{frame['bundle']}") as file:
                    start, packed, full = read_seek_table(file)[frame["frame"]]
                    file.seek(start)
                    raw = decompressor.decompress(file.read(packed), max_output_size=full)
                yield _rows([found(raw[r["record_start"] : r["record_start"] + r["record_size"]]) for r in frame["records"]], READ)

    return run


def number(urn: str) -> int | None:
    """The page id of ``<urn:page:...>``."""
    bare = urn.strip("<>").removeprefix(ID)
    return int(bare) if bare else None


def found(raw: bytes) -> tuple:
    head, block = parsed(raw)
    kind = head["WARC-Type"]
    url = head.get("WARC-Target-URI")
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if kind == "response" and hashlib.sha1(block).hexdigest() != digest:
        raise ValueError(f"record {head['WARC-Record-ID']} is damaged")
    return (
        number(head["WARC-Record-ID"]),
        None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        int(head["WARC-Payload-Length"]), digest, kind,
        number(head["WARC-Refers-To"]) if kind == "revisit" else None,
        block if kind == "response" else None,
    )


ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(column.strip().split(" ") for column in schema.split(",")))
    columns = [pa.array(values, ARROW[kind]) for values, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=list(names))
