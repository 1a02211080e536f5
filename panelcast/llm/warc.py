"""WARC archives in seekable Zstandard bundles.

A bundle file is a row of independent Zstandard frames, each with some whole
records, and a skippable frame at the end with the seek table (the published
seekable format: compressed and decompressed size of each frame, then the number
of frames, a flag byte and a magic number). An index table maps each record to
its file, frame and offset within the decompressed frame, so that one record is
read by decompressing one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import BINARY, LONG, STRING, arrow_schema, open_uri, schema, slices, stored, task_file
from panelcast.session import scratch_path, ship_package

#: Seekable format: skippable frame magic, seek table magic. Fixed values.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, LEVEL = 256 << 10, 3
#: Payloads smaller than this are never revisits.
MIN_REVISIT = 0
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")      # RFC 4122 URL name space


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}')}>"


def _header_value(text: str) -> str:
    """A header line holds no control characters and nothing outside ASCII."""
    from urllib.parse import quote
    return quote(text, safe="!#$%&'()*+,/:;=?@[]~-._")


def write_record(page_id, url, payload: bytes, sha1: bytes, refers_to) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(data: bytes, at: int = 0) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """(headers, HTTP head, payload) of the records in a decompressed frame from ``at`` on."""
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        start, size = stop + 4, int(head["Content-Length"])
        block = data[start:start + size]
        if data[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} is cut")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield head, http, payload
        at = start + size + 4


class BundleWriter:
    def __init__(self, out):
        import zstandard
        self.out, self.at, self.pending, self.size, self.frames = out, 0, [], 0, []
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in it) of the record."""
        place = len(self.frames), self.size
        self.pending.append(record)
        self.size += len(record)
        if self.size >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if self.pending:
            done = self.compress(b"".join(self.pending))
            self.out.write(done)
            self.frames.append((len(done), self.size))
            self.pending, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed, decompressed size) of each frame of an open bundle."""
    end = f.size()
    n, flags, magic = struct.unpack("<IBI", f.read_at(9, end - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    entry = 12 if flags & 0x80 else 8
    data = f.read_at(n * entry, end - 9 - n * entry)
    out, at = [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", data, i * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(f, frame: tuple[int, int, int]) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(f.read_at(frame[1], frame[0]), max_output_size=frame[2])


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, sha1, refers_to (null: a response).

    Of rows with equal payloads of at least ``min_revisit`` bytes, those with the
    largest page_id are responses and the others revisit it; a row that repeats the
    largest page_id is a response too. Rows without page_id revisit a row that has
    one; if none has, all are responses. Payloads are told apart by SHA-1.
    """
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    src = src.withColumn("sha1", F.unhex(F.sha1("payload")))
    last = src.groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).filter("n > 1")
    refers = F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
                    & (F.octet_length("payload") >= min_revisit), F.col("last"))
    return src.join(last.drop("n"), "sha1", "left").select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def write_archives(pages: DataFrame, base: str | None = None) -> DataFrame:
    """Write bundles under ``base``; the stored index: page_id, record_id, file, frame, offset, length.

    Null html is an empty payload; a null url is left out of the record. Other
    columns are ignored; an empty table writes no bundle and gives an empty index.
    """
    spark = pages.sparkSession
    base = base or scratch_path(spark, "warc")
    ship_package(spark)
    out = schema(page_id=LONG, record_id=STRING, file=STRING, frame=LONG, offset=LONG, length=LONG)

    def run(batches):
        arrow, name = arrow_schema(out), task_file(base, ".warc.zst")
        fs, path = open_uri(name)
        bundle = None
        for batch in batches:
            for piece in slices(batch):
                if bundle is None:
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    bundle = BundleWriter(fs.open_output_stream(path, compression=None))
                rows = []
                for page_id, url, payload, sha1, refers in zip(*(c.to_pylist() for c in piece.columns)):
                    record = write_record(page_id, url, payload, sha1, refers)
                    rows.append((page_id, record_id(page_id), name, *bundle.add(record), len(record)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)
        if bundle is not None:
            bundle.close()

    return stored(plan_records(pages).mapInArrow(run, out), "warc-index")


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the bundles the index names, frame by frame through the seek tables:
    page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    ship_package(index.sparkSession)
    out = schema(page_id=LONG, url=STRING, payload_bytes=LONG, payload_digest=STRING, record_type=STRING, refers_to=LONG)
    files = index.select("file").distinct()

    def run(batches):
        arrow = arrow_schema(out)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = open_uri(name)
                with fs.open_input_file(path) as f:
                    for frame in seek_table(f):
                        rows = [_row(*r) for r in read_records(read_frame(f, frame))]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)

    return files.mapInArrow(run, out)


def _row(head: dict[str, str], http: bytes, payload: bytes) -> tuple:
    digest, page, refers = head["WARC-Payload-Digest"].removeprefix("sha1:"), head.get("X-Page-ID"), head.get("X-Refers-To-Page-ID")
    if head["WARC-Type"] == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of page {page} doesn't match its digest")
    else:           # the full payload's length, as the server gave it
        size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    return (int(page) if page is not None else None, head.get("WARC-Target-URI"), size, digest, head["WARC-Type"],
            int(refers) if refers is not None else None)


def read_pages(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """Random access: page_id, record (bytes) of the asked pages, one frame read for each."""
    ship_package(index.sparkSession)
    asked = index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi").select("page_id", "file", "frame", "offset", "length")
    out = schema(page_id=LONG, record=BINARY)

    def run(batches):
        for batch in batches:
            for page_id, name, frame, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                fs, path = open_uri(name)
                with fs.open_input_file(path) as f:
                    data = read_frame(f, seek_table(f)[frame])
                yield pa.RecordBatch.from_arrays([pa.array([page_id], pa.int64()), pa.array([data[offset:offset + length]])],
                                                 schema=arrow_schema(out))

    return asked.mapInArrow(run, out)
