"""Token files of patched frame-of-reference blocks (operator 12).

Documents are dealt to tasks by ranges of doc_id, in ascending order within each
task. A task encodes its texts, ends each document with an end token, and writes
the ids into shards of its own. A shard is, in little-endian numbers:

* ``MAGIC``;
* blocks of ``BLOCK`` ids (the last one may be shorter). A block subtracts its
  minimum, packs what remains at the bit width that ``PERCENT`` of its ids need,
  and lists place and value of the others. Head: minimum u32, ids less one u16,
  exceptions u16, width u8; then packed bits, places u16, values u32;
* for each document the ids before its end in the shard (u64), its doc_id (i64)
  and whether that is null (u8);
* where each block starts (u64);
* numbers of ids, documents and blocks (u64), and ``MAGIC``.

Any block is found by one look into the index, so a reader takes ids or documents
of any range. A shard's place among all shards follows from the range of its
keys; tasks hand back the names of what they wrote, so files of attempts that
failed are never read. Shards are reached by Arrow's file systems, as archives are.

Edge cases: null doc_ids come first, rows with one doc_id in the order of a hash
of their text; null and empty texts are the end token alone; equal rows are
written one by one; an empty table has no shard; extra columns do not matter.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import scratch_path

from .bpe import ship, vocabulary
from .common import materialize
from .warc import place

MAGIC = b"PFR1"
BLOCK, PERCENT = 1024, 90
#: Blocks that are packed or unpacked at a time.
AT_ONCE = 256
#: A shard is closed after so many ids or documents.
SHARD_IDS, SHARD_DOCS = 64 << 20, 1 << 20
#: Documents that one read looks at.
SLICE_DOCS = 4096
END = 1
HEAD = struct.Struct("<IHHB")
TAIL = struct.Struct("<QQQ4s")


def bit_length(values: np.ndarray) -> np.ndarray:
    """Bits that each of the values below 2^32 needs; none for 0."""
    return np.frexp(values.astype(np.float64))[1]


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of ``BLOCK`` ids, at most the last one shorter."""
    full, rest = divmod(len(ids), BLOCK)
    out = _packed(ids[: full * BLOCK].reshape(full, BLOCK)) if full else []
    return out + (_packed(ids[full * BLOCK :].reshape(1, rest)) if rest else [])


def _packed(rows: np.ndarray) -> list[bytes]:
    count, size = rows.shape
    least = rows.min(axis=1)
    over = (rows - least[:, None]).astype("<u4")
    at = min(size - 1, -(-size * PERCENT // 100) - 1)
    widths = bit_length(np.partition(over, at, axis=1)[:, at])
    odd = over >> widths[:, None].astype(np.uint64) > 0
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        bits = np.unpackbits(over[chosen].view(np.uint8).reshape(len(chosen), size, 4), axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :width].reshape(len(chosen), -1), axis=1, bitorder="little")
        for block, data in zip(chosen, packed):
            places = np.flatnonzero(odd[block])
            head = HEAD.pack(least[block], size - 1, len(places), width)
            out[block] = head + data.tobytes() + places.astype("<u2").tobytes() + over[block, places].tobytes()
    return out


def unpack_blocks(data: bytes) -> np.ndarray:
    """Ids of consecutive blocks."""
    out, at = [], 0
    while at < len(data):
        least, size, odd, width = HEAD.unpack_from(data, at)
        size, at = size + 1, at + HEAD.size
        used = -(-size * width // 8)
        ids = np.zeros((size, 32), np.uint8)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, used, at), count=size * width, bitorder="little")
        ids[:, :width] = bits.reshape(size, width)
        ids = np.packbits(ids, axis=1, bitorder="little").view("<u4").ravel()
        at += used
        ids[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
        at += 6 * odd
        out.append(ids + np.uint32(least))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


class ShardWriter:
    """One shard, written front to back; holds ids of ``AT_ONCE`` blocks at most
    besides the ids of one document."""

    def __init__(self, system: pafs.FileSystem, path: str):
        self.out = system.open_output_stream(path, compression=None)
        self.out.write(MAGIC)
        self.size, self.ids = len(MAGIC), 0
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.starts: list[int] = []
        self.ends: list[int] = []
        self.doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.ids += len(ids)
        self.ends.append(self.ids)
        self.doc_ids.append(doc_id)
        if self.n_held >= AT_ONCE * BLOCK:
            ids = np.concatenate(self.held)
            whole = len(ids) // BLOCK * BLOCK
            for at in range(0, whole, AT_ONCE * BLOCK):
                self._blocks(ids[at : min(at + AT_ONCE * BLOCK, whole)])
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def _blocks(self, ids: np.ndarray) -> None:
        for block in pack_blocks(ids):
            self.starts.append(self.size)
            self.out.write(block)
            self.size += len(block)

    def close(self) -> None:
        if self.n_held:
            self._blocks(np.concatenate(self.held))
        self.starts.append(self.size)
        nulls = np.array([d is None for d in self.doc_ids], np.uint8)
        for table in (
            np.array(self.ends, "<u8"), np.array([d or 0 for d in self.doc_ids], "<i8"), nulls, np.array(self.starts, "<u8"),
        ):
            self.out.write(table.tobytes())
        self.out.write(TAIL.pack(self.ids, len(self.ends), len(self.starts) - 1, MAGIC))
        self.out.close()


class ShardReader:
    """Random access to the ids and documents of a shard."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        self.n_ids, self.n_docs, self.n_blocks, magic = TAIL.unpack(self._at(size - TAIL.size, TAIL.size))
        if magic != MAGIC:
            raise ValueError("no token shard, or one that ends early")
        self.index = size - TAIL.size - 8 * (self.n_blocks + 1)
        self.docs = self.index - 17 * self.n_docs

    def _at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        data = self.file.read(length)
        if len(data) < length:
            raise ValueError("a token shard ends early")
        return data

    def ids(self, start: int, end: int) -> Iterator[np.ndarray]:
        """Ids from ``start`` up to ``end``, some blocks at a time."""
        for first in range(start // BLOCK, -(-end // BLOCK), AT_ONCE):
            last = min(first + AT_ONCE, -(-end // BLOCK))
            places = np.frombuffer(self._at(self.index + 8 * first, 8 * (last - first + 1)), "<u8")
            ids = unpack_blocks(self._at(int(places[0]), int(places[-1] - places[0])))
            yield ids[max(start - first * BLOCK, 0) : end - first * BLOCK]

    def documents(self, first: int, last: int) -> tuple[np.ndarray, list[int | None]]:
        """Ids before each document from ``first`` up to ``last`` and before the one
        that follows, and their doc_ids."""
        low = max(first - 1, 0)
        ends = np.frombuffer(self._at(self.docs + 8 * low, 8 * (last - low)), "<u8").astype(np.int64)
        ends = ends if first else np.concatenate([[0], ends])
        names = np.frombuffer(self._at(self.docs + 8 * self.n_docs + 8 * first, 8 * (last - first)), "<i8").tolist()
        nulls = self._at(self.docs + 16 * self.n_docs + first, last - first)
        return ends, [None if null else name for name, null in zip(names, nulls)]


def write_tokens(
    docs: DataFrame, tokenizer_path: str, root: str, end: int = END, shard_ids: int = SHARD_IDS, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """Write all documents below ``root``; (path, docs, ids, base) of each shard,
    ``base`` being the ids in all shards before it."""
    shared = ship(docs, tokenizer_path)
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    numbered = docs.select("doc_id", "text", digest.alias("digest"), F.monotonically_increasing_id().alias("row"))
    key = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")]
    # Rows that are equal still differ by their number, so a hot doc_id is split.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = numbered.repartitionByRange(parts, *key).sortWithinPartitions(*key)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = place(root)
        system.create_dir(folder, recursive=True)
        words, last = vocabulary(shared.value), int(end).to_bytes(4, "little")
        writer, name, first, done = None, "", (), []

        def close() -> None:
            writer.close()
            done.append((*first, name, len(writer.ends), writer.ids))

        for batch in batches:
            for doc_id, digest, row, ids in zip(batch.column(0), batch.column(2), batch.column(3), words.encoded(batch.column(1))):
                if writer is None:
                    name = f"tokens-{uuid.uuid4().hex}.pfr"
                    first = (doc_id.as_py(), digest.as_py(), row.as_py())
                    writer = ShardWriter(system, f"{folder}/{name}")
                writer.add(doc_id.as_py(), np.frombuffer(ids + last, "<u4"))
                if writer.ids >= shard_ids or len(writer.ends) >= shard_docs:
                    close()
                    writer = None
        if writer is not None:
            close()
        if done:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "row", "path", "docs", "ids"])

    shards = materialize(
        dealt.mapInArrow(run, "doc_id bigint, digest bigint, row bigint, path string, docs bigint, ids bigint"), "shards"
    )
    # One row for each shard of some hundred megabytes.
    before = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("path", "docs", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def read_documents(shards: DataFrame, root: str, slice_docs: int = SLICE_DOCS) -> DataFrame:
    """From the shards below ``root``: doc_id, start (ids of all documents before),
    n_tokens and ids_crc32 of every document."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("docs") - 1, F.lit(slice_docs).cast("bigint"))
    slices = shards.select("path", "docs", "base", F.explode(starts).alias("first"))
    dealt = slices.repartition(min(max(1, slices.count()), 100_000), "path", "first")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = place(root)
        for batch in batches:
            for path, docs, base, first in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{folder}/{path}") as file:
                    shard = ShardReader(file)
                    ends, doc_ids = shard.documents(first, min(first + slice_docs, docs))
                    sums, doc, at, crc = [], 0, int(ends[0]), 0
                    for ids in shard.ids(int(ends[0]), int(ends[-1])):
                        data, offset, stop = ids.tobytes(), at, at + len(ids)
                        while at < stop:
                            upto = min(int(ends[doc + 1]), stop)
                            crc = zlib.crc32(data[4 * (at - offset) : 4 * (upto - offset)], crc)
                            at = upto
                            if at == ends[doc + 1]:
                                sums.append(crc)
                                doc, crc = doc + 1, 0
                columns = [pa.array(doc_ids, pa.int64()), pa.array(ends[:-1] + base), pa.array(np.diff(ends)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return dealt.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """What is read back after writing every document."""
    root = scratch_path(docs.sparkSession, "tokens")
    return read_documents(write_tokens(docs, tokenizer_path, root), root)
