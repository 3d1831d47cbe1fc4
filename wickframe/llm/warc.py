"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME`` bytes, each compressed on its own. A bundle ends with a
skippable frame that lists the sizes of all frames (the public seekable format), so a reader finds any
frame from the end of the file. The index maps each record to its bundle, its frame and its offset in the
unpacked frame: one record costs one seek and one frame.

Of records with equal payloads of at least ``min_bytes`` bytes, the one with the largest id is a response, the
others are revisits that refer to it and carry no payload. Digests are computed and compared
by Spark; only the writing and reading of bytes is Python. Bundles go to a folder that driver and executors
share, under names that no second attempt of a task uses again; only files in the index count.

Nulls, ties and edge cases: null html is an empty payload, a null URL an empty one; a null id counts as smallest; rows that
share the largest id of a payload are all responses; an empty table writes nothing. Columns
besides page_id, url and html are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickframe.llm.common import arrow_schema, cut, shared_folder, table

FRAME = 256 * 1024  # bytes of records in a frame, at least
BUNDLE = 64 * 1024 * 1024  # compressed bytes of a bundle, about
STRIDE = 32  # frames of a bundle that one task reads together
PARTS = 8  # such parts that a task reads, about, where there are many
# Fixed values of the seekable format: magic of skippable frames used for the table, and of the footer.
TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own
NO_ID = 1 << 127


def record_id(page_id: int | None) -> str:
    number = NO_ID if page_id is None else page_id + (1 << 64)
    return f"<urn:uuid:{uuid.UUID(int=number)}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record.strip("<>")).int
    return None if number == NO_ID else number - (1 << 64)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """Headers, block and end of the record at ``at``."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:])}
    start = stop + 4
    end = start + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    return headers, data[start:end], end + 4


def read_record(headers: dict, block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload bytes, digest, type and refers_to; a response's digest is computed anew."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    named = headers["warc-payload-digest"].removeprefix("sha1:")
    page_id, kind = page_of(headers["warc-record-id"]), headers["warc-type"]
    if kind == "revisit":
        return page_id, length, named, kind, page_of(headers["warc-refers-to"])
    if len(payload) != length or payload_digest(payload) != named:
        raise ValueError(f"payload of page {page_id} is damaged")
    return page_id, length, named, kind, None


class BundleWriter:
    """Appends records to frames; ``close`` returns the bytes of the bundle."""

    def __init__(self, frame: int = FRAME, level: int = 3):
        self.frame, self.compressor = frame, zstandard.ZstdCompressor(level=level)
        self.parts: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.filled = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset in it."""
        place = len(self.sizes), self.filled
        self.open.append(record)
        self.filled += len(record)
        if self.filled >= self.frame:
            self._end_frame()
        return place

    def _end_frame(self) -> None:
        packed = self.compressor.compress(b"".join(self.open))
        self.parts.append(packed)
        self.sizes.append((len(packed), self.filled))
        self.open, self.filled = [], 0

    def size(self) -> int:
        return sum(len(p) for p in self.parts) + self.filled

    def close(self) -> bytes:
        if self.open:
            self._end_frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, FOOTER_MAGIC)
        return b"".join(self.parts) + struct.pack("<II", TABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start, compressed bytes, unpacked bytes) of every frame; ``file`` has size, seek and read."""
    size = file.size()
    file.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != FOOTER_MAGIC:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * n)
    out, start = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * n)):
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(file, frame: tuple[int, int, int]) -> bytes:
    file.seek(frame[0])
    data = zstandard.ZstdDecompressor().decompress(file.read(frame[1]))
    if len(data) != frame[2]:
        raise ValueError("frame is damaged")
    return data


def _open_fs(uri: str):
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


INDEX = "page_id bigint, bundle string, frame int, offset bigint, length bigint"


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to, revisit. The texts are shuffled once, by digest."""
    rows = pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_digest", F.sha1(F.encode("html", "utf-8")))
    firsts = rows.groupBy("_digest").agg(F.max("page_id").alias("_first"))
    joined = rows.join(firsts, "_digest")
    revisit = (F.octet_length("html") >= min_bytes) & F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("_first")).alias("refers_to"), revisit.alias("revisit"))


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 0, frame: int = FRAME, bundle: int = BUNDLE, rows: int = 64) -> DataFrame:
    """Write all pages into bundles in ``folder`` (a shared one) and return the index."""
    fields = arrow_schema(INDEX)

    def run(batches):
        context = TaskContext.get()
        system, path = _open_fs(folder)
        system.create_dir(path, recursive=True)
        count = 0

        def store(writer, index):
            nonlocal count
            name = f"{path}/part-{context.partitionId():05d}-{context.taskAttemptId()}-{count}.warc.zst"
            count += 1
            with system.open_output_stream(name, compression=None) as out:
                out.write(writer.close())
            for at in range(0, len(index), 10_000):
                part = [(p, name, *rest) for p, *rest in index[at : at + 10_000]]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*part), fields)], schema=fields)

        writer, index = BundleWriter(frame), []
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                columns = [c.to_pylist() for c in batch.slice(at, rows).columns]
                for page_id, url, html, refers_to, revisit in zip(*columns):
                    record = warc_record(page_id, url, html.encode("utf-8", "replace"), refers_to, revisit)
                    index.append((page_id, *writer.add(record), len(record)))
                if writer.size() >= bundle:
                    yield from store(writer, index)
                    writer, index = BundleWriter(frame), []
        if index:
            yield from store(writer, index)

    return cut(plan_records(pages, min_bytes).mapInArrow(run, INDEX))


RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _dealt(wanted: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with (bundle, part), all of one part in one task; tasks get about ``PARTS`` parts, and all cores some.

    The hash keeps the exchange apart from one by the columns themselves, which the planner would drop or shrink to one
    task, since index rows are few bytes however much they stand for.
    """
    cores = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = groups.count()
    return wanted.repartition(max(min(n, cores), n // PARTS, 1), F.xxhash64("bundle", "part")).sortWithinPartitions("bundle", "part")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles named in the index, read frame by frame through their seek tables.

    A bundle is read in parts of ``STRIDE`` frames by different tasks.
    """
    fields = arrow_schema(RECORDS)

    def run(batches):
        system, _ = _open_fs(folder)
        for batch in batches:
            for name, part in zip(*[c.to_pylist() for c in batch.columns]):
                with system.open_input_file(name) as file:
                    for frame in seek_table(file)[part * STRIDE : (part + 1) * STRIDE]:
                        data, at, out = read_frame(file, frame), 0, []
                        while at < len(data):
                            headers, block, at = parse_record(data, at)
                            out.append(read_record(headers, block))
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), fields)], schema=fields)

    parts = index.select("bundle", F.floor(F.col("frame") / STRIDE).cast("int").alias("part")).distinct()
    return _dealt(parts, parts).mapInArrow(run, RECORDS)


def fetch_records(wanted: DataFrame, folder: str) -> DataFrame:
    """Single records by their index rows: page_id and the record's bytes.

    Rows are grouped by bundle and part, so a task opens a bundle, reads its seek table and unpacks each frame once.
    """

    def run(batches):
        system, _ = _open_fs(folder)
        file = opened = unpacked = None
        try:
            for batch in batches:
                for page_id, name, frame, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                    if name != opened:
                        if file is not None:
                            file.close()
                        file, opened, unpacked = system.open_input_file(name), name, None
                        frames = seek_table(file)
                    if unpacked != frame:
                        data, unpacked = read_frame(file, frames[frame]), frame
                    yield pa.RecordBatch.from_pydict({"page_id": [page_id], "record": [data[offset : offset + length]]})
        finally:
            if file is not None:
                file.close()

    rows = wanted.select("page_id", "bundle", "frame", "offset", "length", F.floor(F.col("frame") / STRIDE).cast("int").alias("part"))
    dealt = _dealt(rows, rows.select("bundle", "part").distinct()).sortWithinPartitions("bundle", "part", "frame", "offset")
    return dealt.drop("part").mapInArrow(run, "page_id bigint, record binary")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def op8_warc(spark, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    return read_bundles(write_bundles(table(spark, sf_dir, "pages"), folder), folder)
