"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some whole WARC records,
and a seek table in a skippable frame at its end (the public seekable format), so any
Zstandard tool can read a bundle as a whole and a reader can open one frame alone. An
index maps every record identifier to its bundle, frame and offset inside the frame.

Tasks write bundles side by side below a folder that all executors share. A file name
holds the task attempt; the index, written by Spark's committer, names the files that
count, so a lost or repeated attempt leaves nothing behind that is read.

Of equal payloads the one with the smallest page id is stored; the others become revisit
records that refer to it.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.shared import slices
from riskloom.operators.durable import durable, scratch_path
from riskloom.operators.joins import hot_keys_from_counts, spread_left_join

FRAME_BYTES = 1 << 20  # a frame closes when its records reach this size
BUNDLE_BYTES = 64 << 20  # a bundle closes when its frames reach this size
LEVEL = 3
LEAST_REVISIT = 100  # smaller payloads are always stored
HOT_ROWS = 10_000
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the seekable format and of WARC.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, frame_start long, frame_size long, offset long, length long"
READ_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string"
)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, or of a plain path."""
    if uri.startswith("file:/"):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:page:unnumbered:{digest}"


def _header_text(value: str) -> str:
    """A header value may hold no line breaks or other controls."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def build_record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """A response record with its payload, or a revisit record without (``refers_to`` set)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id, digest)}>"]
    lines.append(f"WARC-Date: {DATE}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"WARC-Profile: {PROFILE}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""])
    return head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record that starts at ``at``."""
    if not data.startswith(b"WARC/1.1\r\n", at):
        raise ValueError(f"no WARC record at offset {at}")
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode("utf-8", "surrogatepass").split("\r\n")[1:]
    headers = dict(line.split(": ", 1) for line in lines)
    begin, size = stop + 4, int(headers["Content-Length"])
    block, end = data[begin : begin + size], begin + size + 4
    if len(block) != size or data[end - 4 : end] != b"\r\n\r\n":
        raise ValueError(f"cut WARC record at offset {at}")
    return headers, block, end


def read_row(headers: dict[str, str], block: bytes) -> tuple:
    """Row of ``READ_SCHEMA``; the digest of a stored payload is computed again and compared."""
    http, payload = block.split(b"\r\n\r\n", 1)
    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
    page, other = headers.get("X-Page-ID"), headers.get("WARC-Refers-To")
    refers_to = int(other.strip("<>").rsplit(":", 1)[1]) if other else None
    own = headers["WARC-Record-ID"].strip("<>")
    return (int(page) if page is not None else None, size, digest, kind, refers_to, headers.get("WARC-Target-URI"), own)


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, stream):
        self.stream, self.frames, self.at = stream, [], 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add_frame(self, records: list[bytes]) -> tuple[int, int]:
        """(start, size) of the frame in the file."""
        data = b"".join(records)
        packed = self.compressor.compress(data)
        self.stream.write(packed)
        self.frames.append((len(packed), len(data)))
        self.at += len(packed)
        return self.at - len(packed), len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)
        self.stream.close()


def seek_table(stream) -> list[tuple[int, int, int]]:
    """(start, packed size, plain size) of every frame, from the end of a bundle."""
    size = stream.size()
    stream.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", stream.read(9))
    entry = 12 if flags & 0x80 else 8
    if magic != SEEKABLE or 17 + entry * count > size:
        raise ValueError("no seek table at the end of the bundle")
    stream.seek(size - 9 - entry * count)
    table, frames, at = stream.read(entry * count), [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", table, entry * i)
        frames.append((at, packed, plain))
        at += packed
    return frames


def read_frame(stream, start: int, packed: int, plain: int) -> bytes:
    stream.seek(start)
    return zstandard.ZstdDecompressor().decompress(stream.read(packed), max_output_size=plain)


def with_revisits(pages: DataFrame, id_column: str, url: str, html: str) -> DataFrame:
    """(page_id, url, payload, size, digest, refers_to): ``refers_to`` is set for revisits,
    whose payload is empty from here on."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    large = F.col("size") >= LEAST_REVISIT
    firsts = rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = durable(firsts.where(F.col("n") > 1), "firsts")
    hot = hot_keys_from_counts(firsts, ["digest"], 2, min_rows=HOT_ROWS)
    joined = spread_left_join(rows, [firsts.select("digest", "first")], ["digest"], hot=hot)
    later = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    joined = joined.withColumn("refers_to", later)
    stored = F.when(F.col("refers_to").isNull(), F.col("payload"))
    return joined.select("page_id", "url", stored.alias("payload"), "size", "digest", "refers_to")


def write_bundles(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``with_revisits`` rows below ``folder`` and return the index, itself stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        writer, bundle, number, waiting, held, index = None, "", 0, [], 0, []

        def flush() -> None:
            nonlocal waiting, held
            start, size = writer.add_frame([data for _, data in waiting])
            offset = 0
            for (own, page_id), data in waiting:
                index.append((own, page_id, bundle, len(writer.frames) - 1, start, size, offset, len(data)))
                offset += len(data)
            waiting, held = [], 0

        for batch in slices(batches, "payload"):
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                page_id, url, payload, size, digest, refers_to = row
                if writer is None:
                    bundle = f"{root}/bundle-{task.partitionId():05d}-{task.taskAttemptId()}-{number:04d}.warc.zst"
                    writer, number = BundleWriter(store.open_output_stream(bundle, compression=None)), number + 1
                data = build_record(page_id, url, payload or b"", size, digest, refers_to)
                waiting.append(((record_id(page_id, digest), page_id), data))
                held += len(data)
                if held >= FRAME_BYTES:
                    flush()
                if writer.at >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
                    yield _rows(index, INDEX_ARROW)
                    index = []
        if waiting:
            flush()
        if writer is not None:
            writer.close()
        if index:
            yield _rows(index, INDEX_ARROW)

    return durable(rows.mapInArrow(run, INDEX_SCHEMA), "warc-index")


INDEX_ARROW = pa.schema(
    [
        ("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()),
        ("frame_start", pa.int64()), ("frame_size", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
    ]
)
READ_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
        ("refers_to", pa.int64()), ("url", pa.string()), ("record_id", pa.string()),
    ]
)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, read frame by frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for bundle in batch.column(0).to_pylist():
                with store.open_input_file(bundle) as stream:
                    for frame in seek_table(stream):
                        data, at, rows = read_frame(stream, *frame), 0, []
                        while at < len(data):
                            headers, block, at = parse_record(data, at)
                            rows.append(read_row(headers, block))
                        yield _rows(rows, READ_ARROW)

    bundles = index.select("bundle").distinct()
    count = bundles.count()
    return bundles.repartition(max(1, count), "bundle").mapInArrow(run, READ_SCHEMA)


def fetch_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of some index rows alone: one frame is opened for each, by its offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        names = ("bundle", "frame_start", "frame_size", "offset", "length")
        for batch in batches:
            rows = []
            for bundle, start, size, offset, length in zip(*[batch.column(n).to_pylist() for n in names]):
                with store.open_input_file(bundle) as stream:
                    plain = next(p for s, _, p in seek_table(stream) if s == start)
                    data = read_frame(stream, start, size, plain)[offset : offset + length]
                    rows.append(read_row(*parse_record(data)[:2]))
            yield _rows(rows, READ_ARROW)

    return index.mapInArrow(run, READ_SCHEMA)


def archive_pages(
    pages: DataFrame, folder: str | None = None, id_column: str = "page_id", url: str = "url", html: str = "html"
) -> tuple[DataFrame, DataFrame]:
    """Write all pages and return (records read back, index).

    ``folder`` is a URI all executors can write, by default in the shared folder. A NULL html
    is an empty payload. Payloads of at least 100 bytes are stored once, under the smallest
    page id; rows with that very id, or without any id among their copies, are all stored. A
    NULL page id or url stays NULL. No rows give no bundles and no records.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    index = write_bundles(with_revisits(pages, id_column, url, html), folder)
    return read_bundles(index, folder), index
