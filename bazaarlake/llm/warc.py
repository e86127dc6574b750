"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames of whole records, followed by a skippable frame with the seek
table (sizes of all frames) as its footer. An index table maps record identifiers to the bundle, the frame and the
offset inside the frame, so one record is read by decompressing one frame.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm.storage import shared_folder, write_table

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
# Equal payloads from this size on are written once; later records revisit the first.
REVISIT_BYTES = 100
# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
# Fixed: the date of the records, so that reruns give equal archives.
DATE = "2026-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "record_id string, bundle string, frame long, offset long, length long"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def encode_record(page_id, url, payload, payload_bytes, digest, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has no block. Control characters and spaces of the url are escaped."""
    revisit = refers_to is not None
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {payload_bytes}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        head += [f"WARC-Refers-To: {record_id(refers_to)}"]
    block = b"" if revisit else HTTP + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(data: memoryview, start: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, payload and end of the record at ``start``."""
    end = bytes(data[start : start + 65536]).find(b"\r\n\r\n")
    if end < 0:
        end = bytes(data[start:]).index(b"\r\n\r\n")
    lines = bytes(data[start : start + end]).decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = start + end + 4
    stop = body + int(fields["Content-Length"])
    block = bytes(data[body:stop])
    return fields, block.partition(b"\r\n\r\n")[2], stop + 4


def _page(identifier: str | None) -> int | None:
    number = identifier[len("<urn:page:") : -1] if identifier else "none"
    return None if number == "none" else int(number)


def page_of_record(fields: dict[str, str], payload: bytes) -> tuple:
    """A record as a row of RECORDS. A response's size and digest are taken from the payload that was read."""
    revisit = fields["WARC-Type"] == "revisit"
    url = fields.get("WARC-Target-URI")
    return (
        _page(fields["WARC-Record-ID"]),
        None if url is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        None if revisit else payload,
        int(fields["Payload-Length"]) if revisit else len(payload),
        fields["WARC-Payload-Digest"].partition(":")[2] if revisit else hashlib.sha256(payload).hexdigest(),
        fields["WARC-Type"],
        _page(fields.get("WARC-Refers-To")),
    )


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: compressed and plain size of each frame."""
    body = b"".join(struct.pack("<II", *sizes) for sizes in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(path: str) -> list[tuple[int, int]]:
    """Offset and compressed size of each frame, from the footer alone."""
    system, name = pafs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        size = file.size()
        count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        table = file.read_at(8 * count, size - 9 - 8 * count)
    frames, offset = [], 0
    for compressed, _ in struct.iter_unpack("<II", table):
        frames.append((offset, compressed))
        offset += compressed
    return frames


class BundleWriter:
    """Writes the records of one task; a full frame is compressed and written at once."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int):
        context = TaskContext.get()
        self.prefix = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}"
        self.system, _ = pafs.FileSystem.from_uri(folder)
        self.frame_bytes, self.bundle_bytes, self.bundles = frame_bytes, bundle_bytes, 0
        self.file, self.compressor = None, zstandard.ZstdCompressor(level=3)
        self.records: list[bytes] = []
        self.filled = 0

    def add(self, identifier: str, record: bytes) -> tuple:
        """Place a record; returns its row of the index."""
        if self.file is None:
            self.path = f"{self.prefix}-{self.bundles:04d}.warc.zst"
            name = pafs.FileSystem.from_uri(self.path)[1]
            self.system.create_dir(name.rpartition("/")[0], recursive=True)
            self.file, self.frames = self.system.open_output_stream(name, compression=None), []
        place = (identifier, self.path, len(self.frames), self.filled, len(record))
        self.records.append(record)
        self.filled += len(record)
        if self.filled >= self.frame_bytes:
            self.end_frame()
            if sum(f[0] for f in self.frames) >= self.bundle_bytes:
                self.close()
        return place

    def end_frame(self) -> None:
        if self.records:
            frame = self.compressor.compress(b"".join(self.records))
            self.file.write(frame)
            self.frames.append((len(frame), self.filled))
            self.records, self.filled = [], 0

    def close(self) -> None:
        if self.file is not None:
            self.end_frame()
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.file, self.bundles = None, self.bundles + 1


def mark_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """Payload, its size and SHA-256, and refers_to for every row of pages (page_id, url, html).

    Of rows with equal payloads of at least ``least`` bytes the one with the smallest page_id is kept, the others
    refer to it; rows that share that page_id are all kept, and so are rows without a page_id that no other row
    precedes. Only page_ids and digests are compared, with a combining aggregation: payloads are moved once, by
    page_id and digest, so copies of one payload are spread over all tasks.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    full = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    narrow = write_table(full.filter(F.col("payload_bytes") >= least).select("page_id", "payload_digest"), "digests")
    firsts = narrow.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("_n"))
    firsts = write_table(firsts.filter("_n > 1 AND refers_to IS NOT NULL").drop("_n"), "first-pages")
    revisits = (
        narrow.join(firsts, "payload_digest").filter("NOT page_id <=> refers_to").distinct().withColumnRenamed("page_id", "_page")
    )
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    found = write_table(revisits.withColumnRenamed("payload_digest", "_digest"), "revisits")
    return full.join(found, same, "left").drop("_page", "_digest")


def write_bundles(
    pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write every page as a WARC record below ``folder``; returns the index (record_id, bundle, frame, offset, length).

    Null html is an empty payload; a null url leaves its field out. Repeated page_ids give records with the same
    identifier, each with its own row in the index. A task writes files under names of its own attempt and the
    index names only those of the attempts that Spark committed, so a lost executor leaves no half-written bundle in it.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes, bundle_bytes)
        names = ["record_id", "bundle", "frame", "offset", "length"]
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")]
            rows = []
            for i in range(batch.num_rows):
                values = [c[i].as_py() for c in columns]
                if values[5] is not None:
                    values[2] = b""
                rows.append(writer.add(record_id(values[0]), encode_record(*values)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names)
        writer.close()

    return write_table(mark_revisits(pages).mapInArrow(write, INDEX), "warc-index")


def _read_frame(path: str, offset: int, size: int) -> memoryview:
    system, name = pafs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        return memoryview(zstandard.ZstdDecompressor().decompress(file.read_at(size, offset)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [part.split()[0] for part in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_bundles(index: DataFrame) -> DataFrame:
    """Every record of the bundles that an index names: seek tables first, then each frame on its own."""

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("bundle").to_pylist():
                places = read_seek_table(path)
                columns = [[path] * len(places), [p[0] for p in places], [p[1] for p in places]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bundle", "start", "size"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("bundle", "start", "size")), strict=True):
                data, at, rows = _read_frame(path, start, size), 0, []
                while at < len(data):
                    fields, payload, at = decode_record(data, at)
                    rows.append(page_of_record(fields, payload))
                yield _batch(rows)

    places = index.select("bundle").distinct().mapInArrow(frames, "bundle string, start long, size long")
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return places.repartition(tasks, "bundle", "start").mapInArrow(records, RECORDS)


def lookup(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of some identifiers (column record_id): only the frames that hold them are read."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, tables = [], {}
            for path, frame, offset in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset")), strict=True):
                if path not in tables:
                    tables = {path: read_seek_table(path)}
                fields, payload, _ = decode_record(_read_frame(path, *tables[path][frame]), offset)
                rows.append(page_of_record(fields, payload))
            if rows:
                yield _batch(rows)

    return index.join(wanted.distinct(), "record_id", "left_semi").mapInArrow(fetch, RECORDS)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages to bundles in a new shared folder and read all records back."""
    return read_bundles(write_bundles(pages, shared_folder(spark, "warc")))


SQL = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""
