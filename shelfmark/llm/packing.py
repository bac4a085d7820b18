"""Best-fit packing: length patterns by non-negative least squares (operator 8).

Documents become token pieces of at most ``CAPACITY`` tokens; only longer
documents are cut. What has to be packed is then fully described by a histogram
of piece lengths, which has at most ``CAPACITY`` rows at any data size. A plan is
made on this histogram:

1. lengths are grouped into ``BINS`` bins by their upper edge, and all patterns
   of at most three bins that fill a sequence are enumerated;
2. non-negative least squares fit how often each pattern repeats so that the
   patterns use up the histogram; repeats are rounded down;
3. a pattern is realised with the longest lengths left in its bins, and what
   room these leave is filled with the longest lengths that fit;
4. what rounding leaves over is packed the same way, longest first, each place
   taken by the longest length that fits.

Each step repeats one sequence until a length runs out, so a plan has a few
thousand steps. Pieces get a rank among those of their length, by a count per
partition and a row number within, and a rank lies in one interval of the plan,
which gives sequence and place. No text or token is shuffled.

Edge cases: null and empty texts are one piece, the end token; repeated rows are
packed one by one; an empty table has no sequences; extra columns do not matter.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import ship, vocabulary
from .common import materialize

CAPACITY, END = 4096, 1
BINS, PARTS = 64, 3

Steps = list[tuple[int, list[int]]]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""
    shared = ship(docs, tokenizer_path)
    tail = int(end).to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = vocabulary(shared.value)
            rows, piece, start, length, crc = [], [], [], [], []
            for at, ids in enumerate(words.encoded(batch.column(1))):
                ids += tail
                for k, begin in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * begin : 4 * (begin + capacity)]
                    rows.append(at)
                    piece.append(k)
                    start.append(begin)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            columns = [pa.array(piece, pa.int32())] + [pa.array(c, pa.int64()) for c in (start, length, crc)]
            ids_of = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids_of, *columns], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def patterns(bins: int = BINS, parts: int = PARTS) -> np.ndarray:
    """Counts by bin (columns: patterns) of up to ``parts`` bins that sum to ``bins``."""
    found = [
        combo for k in range(1, parts + 1) for combo in combinations_with_replacement(range(1, bins + 1), k) if sum(combo) == bins
    ]
    out = np.zeros((bins, len(found)))
    for column, combo in enumerate(found):
        for size in combo:
            out[size - 1, column] += 1
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that brings ``a @ x`` closest to ``b``, by an active set: free the
    variable with the steepest gain, solve for the free ones, and step back to
    the border whenever one would turn negative."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(np.abs(a.T @ b).max(initial=0), 1)
    for _ in range(3 * a.shape[1]):
        gain = a.T @ (b - a @ x)
        gain[free] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= tolerance:
            break
        free[best] = True
        while True:
            solved = np.zeros_like(x)
            solved[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            below = free & (solved <= 1e-12)
            if not below.any():
                x = solved
                break
            step = np.min(x[below] / np.maximum(x[below] - solved[below], 1e-300))
            x = x + step * (solved - x)
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                break
    return x


class Lengths:
    """How many pieces of each length are left to be packed."""

    def __init__(self, histogram: dict[int, int]):
        self.left = {length: n for length, n in histogram.items() if n > 0}
        self.order = sorted(self.left)

    def longest(self, most: int, least: int = 1) -> int | None:
        at = bisect_left(self.order, most + 1)
        return self.order[at - 1] if at and self.order[at - 1] >= least else None

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if self.left[length] == 0:
            del self.left[length]
            del self.order[bisect_left(self.order, length)]

    def give_back(self, length: int) -> None:
        if length in self.left:
            self.left[length] += 1
        else:
            self.left[length] = 1
            insort(self.order, length)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Steps:
    """Steps (repeats, lengths of one sequence) that use up the histogram."""
    pool, steps, width = Lengths(histogram), [], capacity / BINS

    def settle(start: list[int], most: int | None) -> int:
        """One step that begins with ``start`` (taken already): fill, repeat."""
        lengths, room = list(start), capacity - sum(start)
        while (fit := pool.longest(room)) is not None:
            pool.take(fit, 1)
            lengths.append(fit)
            room -= fit
        need: dict[int, int] = {}
        for length in lengths:
            need[length] = need.get(length, 0) + 1
        more = min(pool.left.get(length, 0) // n for length, n in need.items())
        if most is not None:
            more = min(more, most - 1)
        for length, n in need.items():
            if more:
                pool.take(length, more * n)
        steps.append((1 + more, lengths))
        return 1 + more

    table = patterns()
    counts = np.zeros(BINS)
    for length, n in histogram.items():
        counts[int(-(-length // width)) - 1] += n
    # Leaving short pieces over costs little: they fill gaps.
    weight = np.sqrt(np.arange(1, BINS + 1) / BINS)[:, None]
    repeats = np.floor(nonnegative_least_squares(weight * table, weight[:, 0] * counts) + 1e-6).astype(int)
    for column in np.argsort(-repeats, kind="stable"):
        todo = int(repeats[column])
        bins = [b for b in range(BINS - 1, -1, -1) for _ in range(int(table[b, column]))]
        while todo > 0:
            start: list[int] = []
            for b in bins:
                length = pool.longest(int((b + 1) * width), int(b * width) + 1)
                if length is None:
                    break
                pool.take(length, 1)
                start.append(length)
            if len(start) < len(bins):
                for length in start:
                    pool.give_back(length)
                break
            todo -= settle(start, todo)
    while pool.order:
        length = pool.order[-1]
        pool.take(length, 1)
        settle([length], None)
    return steps


def intervals(steps: Steps) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, place) of each place in a step."""
    out, used, sequence = [], {}, 0
    for repeats, lengths in steps:
        place = 0
        for length in lengths:
            first = used.get(length, 0)
            out.append((length, first, first + repeats, sequence, place))
            used[length] = first + repeats
            place += length
        sequence += repeats
    return out


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows with a ``length``, each with its sequence_id and offset."""
    spark = found.sparkSession
    found = materialize(found.withColumn("dealt", F.spark_partition_id()), "pieces")
    counts = found.groupBy("length", "dealt").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    plan_rows = intervals(plan(histogram, capacity)) if histogram else []
    by_length: dict[int, list] = {}
    for length, first, end, sequence, place in plan_rows:
        by_length.setdefault(length, []).append((first, end, sequence, place))
    earlier = counts.withColumn(
        "before", F.sum("n").over(Window.partitionBy("length").orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1))
    ).select("length", "dealt", F.coalesce("before", F.lit(0)).alias("before"))
    order = [c for c in found.columns if c not in ("length", "dealt")]
    ranked = found.withColumn("within", F.row_number().over(Window.partitionBy("length", "dealt").orderBy(*order)) - 1)
    ranked = ranked.join(earlier, ["length", "dealt"]).withColumn("rank", F.col("before") + F.col("within"))
    # The plan has some thousand intervals, whatever the number of pieces.
    places = spark.createDataFrame(
        [(length, [list(i) for i in part]) for length, part in by_length.items()], "length bigint, part array<array<bigint>>"
    )
    placed = ranked.join(F.broadcast(places), "length")
    hit = F.get(F.filter("part", lambda i: (F.get(i, 0) <= F.col("rank")) & (F.col("rank") < F.get(i, 1))), F.lit(0))
    return placed.withColumn("hit", hit).select(
        *[c for c in found.columns if c != "dealt"],
        (F.get("hit", F.lit(2)) + F.col("rank") - F.get("hit", F.lit(0))).alias("sequence_id"),
        F.get("hit", F.lit(3)).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return pack(pieces(docs, tokenizer_path)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
