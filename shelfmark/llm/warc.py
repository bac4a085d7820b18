"""WARC archives: a writer and a splittable reader (operator 7).

The writer makes one gzip member per record. Of records with equal payloads of
at least ``REVISIT_BYTES`` bytes the one with the smallest id is a response, the
others are revisits that carry its id and no payload. Which is which comes from
digests alone; a payload travels once at most. A task writes files of its own
and hands back their names, so only files of tasks that succeeded are read.

The reader cuts archives into byte ranges without an index. A task scans its
range for gzip magic, takes a hit for a member only if what it decodes to begins
with a WARC version line, and owns the records that start inside its range; the
last of them may end in the next one. Chance hits inside compressed data fail
the header check; a hit within a record already decoded is never looked at.

Archives are reached by Arrow's file systems (local or mounted folders, object
stores, HDFS where its library is installed).

Edge cases: null html is an empty payload, null urls are empty target URIs; a
page without page_id is written with an empty record id and read as null. Rows
that repeat the smallest id of their payload are all responses; empty tables
give no archives; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import scratch_path

from .common import materialize

REVISIT_BYTES = 100
#: An archive is closed after this size, and a range has at most this many bytes.
ARCHIVE_BYTES, RANGE_BYTES = 256 << 20, 8 << 20
MAGIC = b"\x1f\x8b\x08"
LEVEL = 4
VERSION = b"WARC/1."
CHUNK = 1 << 20
NEVER = "1970-01-01T00:00:00Z"


def place(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        if urlsplit(path).scheme == "file":
            return pafs.LocalFileSystem(), urlsplit(path).path
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One record as a gzip member. A revisit keeps its HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {NEVER}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head[2:2] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    data = ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if rest[size : size + 4] != b"\r\n\r\n":
        raise ValueError("a record ends early")
    return fields, rest[:size]


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, refers_to): the response that a page repeats, or null."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    digest = F.sha2(F.col("html").cast("binary"), 256)
    long = F.octet_length("html") >= REVISIT_BYTES
    firsts = (
        rows.filter(long & F.col("page_id").isNotNull())
        .select("page_id", digest.alias("digest"))
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .filter("first < last")
        .drop("last")
    )
    joined = rows.withColumn("digest", F.when(long, digest)).join(materialize(firsts, "payload-firsts"), "digest", "left")
    return joined.select("page_id", "url", "html", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of :func:`with_revisits` below ``root``; (path, size, records) of
    each archive. Names are new in each attempt of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = place(root)
        system.create_dir(folder, recursive=True)
        done, out, name, size, records = [], None, "", 0, 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns):
                data = record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py())
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, size, records = system.open_output_stream(f"{folder}/{name}", compression=None), 0, 0
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, records))
        if done:
            names, sizes, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["path", "size", "records"])

    columns = rows.select("page_id", "url", "html", "refers_to")
    return materialize(columns.mapInArrow(run, "path string, size bigint, records bigint"), "archives")


class Window:
    """A file read forward in chunks, of which only the wanted part is held."""

    def __init__(self, file: pa.NativeFile, size: int, at: int):
        self.file, self.size, self.start, self.data = file, size, at, b""
        file.seek(at)

    def more(self) -> bool:
        chunk = self.file.read(CHUNK)
        self.data += chunk
        return bool(chunk)

    def drop(self, n: int) -> None:
        self.data = self.data[n:]
        self.start += n


def members(file: pa.NativeFile, size: int, start: int, end: int) -> Iterator[bytes]:
    """Decoded records whose members start at places from ``start`` to ``end``."""
    window = Window(file, size, start)
    window.more()
    while True:
        hit = window.data.find(MAGIC)
        while hit < 0 and window.start < end:
            window.drop(max(len(window.data) - len(MAGIC) + 1, 0))
            if not window.more():
                return
            hit = window.data.find(MAGIC)
        if hit < 0 or window.start + hit >= end:
            return
        window.drop(hit)
        decoded = decode(window)
        if decoded is None:
            window.drop(1)
        else:
            yield decoded


def decode(window: Window) -> bytes | None:
    """The record whose member opens the window, which is moved behind it; None
    if what is there is no member with a WARC record."""
    unpacker, out, used, checked = zlib.decompressobj(31), [], 0, False
    try:
        while not unpacker.eof:
            if used == len(window.data) and not window.more():
                return None
            out.append(unpacker.decompress(window.data[used:]))
            used = len(window.data)
            if not checked and sum(map(len, out)) >= len(VERSION):
                if not b"".join(out[:8]).startswith(VERSION):
                    return None
                checked = True
    except zlib.error:
        return None
    data = b"".join(out)
    if not data.startswith(VERSION):
        return None
    window.drop(used - len(unpacker.unused_data))
    return data


def read_archives(archives: DataFrame, root: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the archives below ``root`` named by (path, size): page_id, url,
    record_type, refers_to, payload_digest and payload_bytes of the full payload,
    and the payload, which is null for revisits."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))
    ranges = archives.select("path", "size", F.explode(starts).alias("start"))
    # One task for some ranges, dealt by place and not by file.
    tasks = max(1, ranges.count())
    dealt = ranges.repartition(min(tasks, 100_000), "path", "start")

    def number(text: str | None) -> int | None:
        digits = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
        return int(digits[1]) if digits else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = place(root)
        names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                rows, held = [], 0
                with system.open_input_file(f"{folder}/{path}") as file:
                    for data in members(file, size, start, min(start + range_bytes, size)):
                        fields, block = parsed(data)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"{path}: the payload of {fields['WARC-Record-ID']} is not what was written")
                        rows.append((
                            number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"],
                            number(fields.get("WARC-Refers-To")), digest, length, None if revisit else payload,
                        ))
                        held += len(payload)
                        if held >= 8 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
    return dealt.mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """What is read back after writing every page."""
    root = scratch_path(spark, "warc")
    archives = write_archives(with_revisits(pages), root)
    return read_archives(archives, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
