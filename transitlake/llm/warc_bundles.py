"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC records,
followed by a skippable frame with the seek table (compressed and raw size of every
frame), as the public seekable format lays it out. Any Zstandard reader
can read the file from the start; with the table one record costs one frame.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored
from transitlake.session import shared_folder

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CUT = b"\r\n\r\n"

INDEX = (
    "page_id bigint, record_type string, bundle string, frame int, frame_start bigint, "
    "frame_bytes bigint, record_start bigint, record_bytes bigint"
)
RECORDS = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, url string, payload binary"
)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path on it."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


# --- writing ------------------------------------------------------------------


def with_record_types(pages: DataFrame, shortest: int) -> DataFrame:
    """Each page with its payload, digest, and the page that it revisits, if any.

    The first of equal payloads is found on digests and ids alone, combined on the
    map side; the join on the digest splits where one digest is hot.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string"), payload.alias("payload")
    ).withColumn("payload_digest", F.sha2("payload", 256))
    firsts = (
        pages.where(F.octet_length("payload") >= shortest)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1 and first_id is not null")
        .drop("__n")
    )
    again: Column = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return pages.join(firsts, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"),
        "payload_digest",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        # a revisit has no body
        F.when(~again, F.col("payload")).alias("payload"),
    )


def record_bytes(
    page_id: int | None,
    url: str | None,
    kind: str,
    refers_to: int | None,
    digest: str,
    length: int,
    payload: bytes | None,
) -> bytes:
    """One WARC record; control characters of the url are percent-encoded."""
    body = payload or b""
    target = "".join(c if c >= " " else f"%{ord(c):02X}" for c in url) if url is not None else None
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {length}",
    ]
    if target is not None:
        head.append(f"WARC-Target-URI: {target}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    else:
        head.append("Content-Type: text/html")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + CUT + body + CUT


def _seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", packed, raw) for packed, raw in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        fs, root = filesystem(folder)
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        schema = pa.schema(
            [(n, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[k])
             for n, k in (c.split() for c in INDEX.split(", "))]
        )
        out, name, frames, at, written = None, "", [], 0, 0
        held: list[bytes] = []
        waiting: list[tuple] = []
        rows: list[tuple] = []

        def flush() -> None:
            nonlocal at, written, held, waiting
            raw = b"".join(held)
            packed = packer.compress(raw)
            out.write(packed)
            for page_id, kind, start, length in waiting:
                rows.append(
                    (page_id, kind, f"{folder}/{name}", len(frames), at, len(packed), start, length)
                )
            frames.append((len(packed), len(raw)))
            at += len(packed)
            written += len(raw)
            held, waiting = [], []

        def close() -> pa.RecordBatch:
            nonlocal out, frames, at, written, rows
            out.write(_seek_table(frames))
            out.close()
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema
            )
            out, frames, at, written, rows = None, [], 0, 0, []
            return batch

        size = 0
        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "record_type", "refers_to",
                                              "payload_digest", "payload_bytes", "payload")]
            for i in range(batch.num_rows):
                page_id, url, kind, refers, digest, length, payload = (c[i].as_py() for c in cols)
                if out is None:
                    # a name of this attempt: what a lost attempt wrote is in no index
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                record = record_bytes(page_id, url, kind, refers, digest, length, payload)
                waiting.append((page_id, kind, size, len(record)))
                held.append(record)
                size += len(record)
                if size >= frame_bytes:
                    flush()
                    size = 0
                    if written >= bundle_bytes:
                        yield close()
        if out is not None:
            if held:
                flush()
            yield close()

    return write


def write_bundles(
    pages: DataFrame,
    folder: str,
    shortest_revisited: int = 100,
    frame_bytes: int = 1 << 18,
    bundle_bytes: int = 1 << 26,
    level: int = 3,
) -> DataFrame:
    """Write a WARC record per page; returns the index, one row per record.

    ``folder`` is a path or URI that all executors share. The index maps a page_id to
    its bundle, its frame (number, first byte, bytes) and its place in the raw frame.
    Each task writes bundles of its own and closes one after ``bundle_bytes`` of raw
    records; a frame closes after ``frame_bytes``, so a longer payload has a frame for
    itself. The index is written once and then read, so each bundle it names is
    whole, also after lost executors.

    A null html is an empty payload, a null url leaves out the target header. Of equal
    payloads of at least ``shortest_revisited`` bytes, the record with the smallest
    page_id is the response (all rows that repeat it, too); rows without a page_id
    revisit it; where no row has an id, all are responses. An empty table writes no
    bundle.
    """
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    typed = with_record_types(pages, shortest_revisited)
    return stored(
        typed.mapInArrow(_writer(folder, frame_bytes, bundle_bytes, level), INDEX), "warc-index"
    )


# --- reading ------------------------------------------------------------------


def frames_of(stream) -> list[tuple[int, int, int]]:
    """(first byte, packed bytes, raw bytes) of each frame, from the seek table."""
    size = stream.size()
    stream.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    stream.seek(size - 9 - 8 * n)
    table = struct.unpack(f"<{2 * n}I", stream.read(8 * n))
    out, at = [], 0
    for packed, raw in zip(table[::2], table[1::2], strict=True):
        out.append((at, packed, raw))
        at += packed
    return out


def parse_record(raw: bytes, start: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, body, and where the next record starts."""
    end = raw.index(CUT, start)
    lines = raw[start:end].decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    body = end + 4
    after = body + int(head["Content-Length"])
    if raw[after : after + 4] != CUT:
        raise ValueError("a record is cut short")
    return head, raw[body:after], after + 4


def _page(urn: str | None) -> int | None:
    number = urn[len("<urn:page:") : -1] if urn else ""
    return int(number) if number else None


def _row(head: dict[str, str], body: bytes) -> tuple:
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(head["WARC-Payload-Length"])
    kind = head["WARC-Type"]
    if kind == "response" and (len(body) != length or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
    return (
        _page(head["WARC-Record-ID"]),
        length,
        digest,
        kind,
        _page(head.get("WARC-Refers-To")),
        head.get("WARC-Target-URI"),
        body if kind == "response" else None,
    )


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
_NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _TYPES]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES
    )


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for bundle in batch.column("bundle").to_pylist():
            fs, path = filesystem(bundle)
            with fs.open_input_file(path) as f:
                for start, packed, raw_bytes in frames_of(f):
                    f.seek(start)
                    raw = unpack.decompress(f.read(packed), max_output_size=raw_bytes)
                    rows, at = [], 0
                    while at < len(raw):
                        head, body, at = parse_record(raw, at)
                        rows.append(_row(head, body))
                    yield _batch(rows)


def _read_some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    bundle, stream, frame, raw = None, None, None, b""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if r["bundle"] != bundle:
                fs, path = filesystem(r["bundle"])
                bundle, stream, frame = r["bundle"], fs.open_input_file(path), None
            if r["frame"] != frame:
                stream.seek(r["frame_start"])
                raw = unpack.decompress(stream.read(r["frame_bytes"]))
                frame = r["frame"]
            head, body, _ = parse_record(raw, r["record_start"])
            rows.append(_row(head, body))
        yield _batch(rows)


def read_bundles(index: DataFrame) -> DataFrame:
    """All records of the bundles in an index, frame by frame.

    The bundles are dealt over as many tasks as there are bundles (their paths are a
    few bytes, and would otherwise be merged into one task).
    """
    bundles = index.select("bundle").distinct()
    n = max(1, min(bundles.count(), 20_000))
    return bundles.repartition(n, "bundle").mapInArrow(_read_whole, RECORDS)


def read_records(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of the wanted page_ids, each read by seeking to its frame."""
    places = index.join(wanted.select("page_id").distinct(), "page_id", "left_semi")
    return (
        places.repartition("bundle", "frame")
        .sortWithinPartitions("bundle", "frame", "record_start")
        .mapInArrow(_read_some, RECORDS)
    )


def archive_query(pages: DataFrame) -> DataFrame:
    """Write archives of all pages in the shared folder and read them back."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_bundles(write_bundles(pages, folder)).drop("payload", "url")
