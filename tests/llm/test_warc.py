from __future__ import annotations

import hashlib
import io
import random

import pyarrow as pa
import pytest

from shelfmark.llm import warc
from shelfmark.llm.common import table
from shelfmark.llm.warc import members, parsed, read_archives, record, round_trip, with_revisits, write_archives
from shelfmark.session import scratch_path


def expected(rows):
    first = {}
    for page_id, html in rows:
        payload = (html or "").encode()
        if page_id is not None and len(payload) >= 100:
            first[payload] = min(first.get(payload, page_id), page_id)
    out = []
    for page_id, html in rows:
        payload = (html or "").encode()
        refers = first.get(payload)
        revisit = refers is not None and page_id != refers
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", refers if revisit else None))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_sample_table(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    assert found(round_trip(spark, pages)) == expected([(r.page_id, r.html) for r in pages.collect()])


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 99), (9, "é" * 50), (5, "é" * 50), (7, "é" * 50), (5, "é" * 50), (None, "é" * 50), (8, "\r\n\r\nWARC/1.1 " * 40), (10, "y" * 400_000)]
    pages = spark.createDataFrame([(i, f"http://a b/{i}", h) for i, h in rows], "page_id bigint, url string, html string")
    pages = pages.selectExpr("*", "1 AS digest", "2 AS refers_to", "3 AS first")
    wanted = expected([r for r in rows if r[0] is not None])
    result = [r for r in found(round_trip(spark, pages)) if r[0] is not None]
    assert result == wanted
    assert round_trip(spark, pages.filter("page_id < 0")).count() == 0


@pytest.mark.parametrize("size", [1, 37, 500, 10_000])
def test_any_cut_finds_every_record_once(spark, size):
    """Ranges far smaller than records, payloads full of gzip magic and of members."""
    rng = random.Random(size)
    pages = []
    for i in range(25):
        inner = record(1000 + i, "http://inner/", b"inner", None).decode("latin-1")
        pages.append((i, "http://host/", "".join(rng.choice(["\x1f\x8b\x08", "text ", inner]) for _ in range(rng.randrange(12)))))
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    root = scratch_path(spark, "warc-test")
    archives = write_archives(with_revisits(frame), root, archive_bytes=700)
    if size == 1:
        archives = archives.limit(1)
    back = read_archives(archives, root, size).select("page_id", "payload").collect()
    by_id = {i: h for i, _, h in pages}
    assert len({r.page_id for r in back}) == len(back)
    if size > 1:
        assert len(back) == len(pages)
    assert all(r.payload is None or r.payload.decode() == by_id[r.page_id] for r in back)


def test_stored_members_inside_a_record_are_not_records():
    """An uncompressed member that holds another archive's bytes verbatim."""
    import zlib

    inner = record(5, "http://inner/", b"p" * 50, None)
    head = f"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: {len(inner)}\r\n\r\n".encode()
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    outer = packer.compress(head + inner + b"\r\n\r\n") + packer.flush()
    data = outer + record(6, "http://next/", b"q", None)
    got = [parsed(d)[0] for d in members(pa.PythonFile(io.BytesIO(data), mode="r"), len(data), 0, len(data))]
    assert [f["WARC-Type"] for f in got] == ["resource", "response"]


def test_broken_archives_are_noticed():
    data = record(6, "http://next/", b"q" * 500, None)
    assert list(members(pa.PythonFile(io.BytesIO(data[:-30]), mode="r"), len(data) - 30, 0, len(data))) == []
    with pytest.raises(ValueError):
        parsed(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc")
    assert warc.place("file:///tmp/x")[1] == "/tmp/x"
