from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm import token_blocks
from shelfmark.llm.common import table
from shelfmark.llm.queries import tokenizer_path
from shelfmark.llm.token_blocks import BLOCK, HEAD, pack_blocks, read_documents, token_round_trip, unpack_blocks, write_tokens
from shelfmark.session import scratch_path


def expected(rows):
    library = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(frame):
    assert frame.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    return sorted(map(tuple, frame.collect()), key=lambda r: r[1])


def test_sample_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(token_round_trip(docs, tokenizer_path())) == expected(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50), max_size=50), st.integers(0, 60))
def test_blocks_hold_any_numbers(numbers, times):
    ids = np.array(numbers * times, np.uint32)
    assert (unpack_blocks(b"".join(pack_blocks(ids))) == ids).all()


@pytest.mark.parametrize("size", [1, BLOCK - 1, BLOCK, BLOCK + 1, 300 * BLOCK + 7])
def test_sizes_around_a_block(size):
    ids = np.random.default_rng(size).integers(0, 49_000, size).astype(np.uint32)
    blocks = pack_blocks(ids)
    assert len(blocks) == -(-size // BLOCK)
    assert (unpack_blocks(b"".join(blocks)) == ids).all()


def test_outliers_are_exceptions_and_do_not_widen_a_block():
    ids = np.arange(1000, 1000 + BLOCK, dtype=np.uint32) % 8 + 1000
    ids[[3, 700]] = 4_000_000_000
    [block] = pack_blocks(ids)
    least, size, odd, width = HEAD.unpack_from(block)
    assert (least, size + 1, odd, width) == (1000, BLOCK, 2, 3)
    assert len(block) == HEAD.size + 3 * BLOCK // 8 + 2 * 6
    assert (unpack_blocks(block) == ids).all()


def test_equal_ids_take_no_bits():
    [block] = pack_blocks(np.full(BLOCK, 77, np.uint32))
    assert len(block) == HEAD.size


EDGES = [
    (None, "no id"), (None, None), (-5, "below"), (7, None), (7, ""), (8, "one two"), (8, "one two"), (8, "three"),
    (9, "long " * 30_000), (2**62, "far"),
]


def test_edges(spark, documents):
    rows = list(EDGES)
    random.Random(3).shuffle(rows)
    frame = documents(rows, "'x' AS digest").selectExpr("*", "1 AS row", "2 AS path")
    seen = found(token_round_trip(frame, tokenizer_path()))
    wanted = expected(rows)
    # Rows of one doc_id come in any order among themselves.
    assert sorted((d or 0, n, c) for d, _, n, c in seen) == sorted((d or 0, n, c) for d, _, n, c in wanted)
    assert [d for d, *_ in seen] == [d for d, *_ in wanted]
    assert [s for _, s, *_ in seen] == [int(s) for s in np.cumsum([0] + [n for _, _, n, _ in seen])[:-1]]


def test_empty_table(spark, documents):
    assert token_round_trip(documents([]), tokenizer_path()).collect() == []


def test_small_shards_and_slices_give_the_same(spark, documents):
    rows = [(k, "some words of text " * (k % 40)) for k in range(300)]
    root = scratch_path(spark, "small-shards")
    shards = write_tokens(documents(rows), tokenizer_path(), root, shard_ids=2000, shard_docs=20)
    assert shards.count() > 15
    assert found(read_documents(shards, root, slice_docs=7)) == expected(rows)


def test_most_rows_under_one_id_are_split(spark, documents):
    rows = [(5, "the same text")] * 3000 + [(k, "other") for k in range(30)]
    root = scratch_path(spark, "hot-id")
    shards = write_tokens(documents(rows).repartition(4), tokenizer_path(), root)
    assert max(r.docs for r in shards.collect()) < 2500
    assert found(read_documents(shards, root)) == expected(rows)


def test_a_cut_file_is_refused(tmp_path):
    writer = token_blocks.ShardWriter(pa.fs.LocalFileSystem(), str(tmp_path / "x"))
    writer.add(1, np.arange(5000, dtype=np.uint32))
    writer.close()
    data = (tmp_path / "x").read_bytes()
    (tmp_path / "x").write_bytes(data[:-9])
    with pa.OSFile(str(tmp_path / "x")) as file, pytest.raises(ValueError):
        token_blocks.ShardReader(file)
