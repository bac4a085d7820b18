"""MinHash near-dedup by chosen-path set similarity join (operator 9).

A document's set are the distinct shingles of five words; documents are linked
when their sets' Jaccard similarity reaches a percentage, and linked documents
form components. The join is recursive: a tree starts by branching documents on
one minwise token; a node of at most ``LEAF`` documents is compared
exhaustively, a larger one branches again on further minwise tokens that its
own hash selects. Trees use different tokens, and there are so many of them that a
pair at the threshold is missed by all with a chance below 1e-5, even if its nodes
branch down to ``DEPTH``. Comparisons are screened by the sketches and confirmed on
full sets.

What keeps hot groups in bounds:

* equal sets are one class and join as one document;
* in a large node, the members near a pivot (the one most like the node's typical
  sketch) form a cluster. A cluster is found once for all trees and compared
  exhaustively in blocks over many tasks, each block by one matrix product on
  full sets. Its members need no further comparison with each other, and those
  closest to the pivot none with members far from it (Jaccard distance is a
  metric), so only the others branch on;
* what is still large after ``DEPTH`` levels is compared in blocks as well, so no
  pair is given up;
* tasks emit links of a spanning forest, not all pairs of a group.

Edge cases: null, empty and blank texts have an empty set and no links; shorter
texts than five words are one shingle; a row without doc_id stays alone, with a
null component, and is kept. Rows that share a doc_id are one node: each gets
its own row in the result. Their sets are told apart by a hash of their text and
join one by one; equal rows join once, however often they are repeated. Extra
columns do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import map_texts, materialize, take_turn
from .components import components

WIDTH = 5
#: Minwise tokens in a sketch, documents in a leaf, levels of branching.
TOKENS, LEAF, DEPTH = 64, 64, 4
#: Further tokens on which a large node branches.
BRANCHES = 2
#: Chance that no tree brings a pair at the threshold into one leaf.
MISSED = 1e-5
#: Documents of a block; nodes above ``VAST`` branch before clusters are sought.
BLOCK, VAST = 256, 50_000
#: Equal tokens with a pivot from which a member is near, and beyond which it
#: cannot be linked with one that is not: a similarity of 0.25, and 0.15 + 0.25 more.
NEAR, CORE = 16, 42

#: What tells documents apart: rows of one doc_id may have different texts.
IDENTITY = ["doc_id", "text_hash"]

_seed = np.random.default_rng(20240229)
FACTORS = _seed.integers(1, 1 << 63, TOKENS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _seed.integers(0, 1 << 63, TOKENS, np.uint64)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= 150_000:
            self.clear()
        self[word] = value
        return value


_words = _Words()


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * SPREAD
    return x ^ (x >> np.uint64(29))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    take_turn("near_dup", _words.clear)
    words = np.array(list(map(_words.__getitem__, text.encode().lower().split())), np.uint64)
    n = len(words)
    if n == 0:
        return words
    width = min(n, WIDTH)
    found = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        found = spread(found) + words[k : n - width + 1 + k]
    return np.unique(spread(found))


def minwise(members: np.ndarray) -> np.ndarray:
    """The smallest hash of a set under each of the sketch's functions."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), 1024):
        hashed = members[start : start + 1024, None] * FACTORS + SHIFTS
        np.minimum(best, hashed.min(axis=0), out=best)
    return best


def trees(percent: int) -> int:
    """Trees of which one at least keeps a pair at the threshold together.

    A tree does if the pair shares the root's token and, at every level, one of the
    tokens on which its node branches.
    """
    p = percent / 100
    kept = p * (1 - (1 - p) ** BRANCHES) ** DEPTH
    return min(TOKENS, max(1, math.ceil(math.log(MISSED) / math.log(1 - kept)))) if kept < 1 else 1


def describe(n_trees: int, text: str) -> tuple:
    """Set size, 128-bit key of the set, root node of each tree, sketch."""
    members = shingles(text)
    if not len(members):
        return 0, None, None, None, None
    best = minwise(members)
    roots = spread(spread(best[:n_trees]) + np.arange(1, n_trees + 1, dtype=np.uint64)).view(np.int64)
    k1, k2 = np.frombuffer(hashlib.blake2b(members.tobytes(), digest_size=16).digest(), np.int64)
    sketch = (spread(best) >> np.uint64(48)).astype(np.uint16)
    return len(members), int(k1), int(k2), roots.tolist(), sketch.tobytes()


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def screen(percent: int) -> int:
    """Equal tokens that a pair at the threshold has but for a chance of 1e-5."""
    p = percent / 100
    return int(TOKENS * (p - 4.5 * (p * (1 - p) / TOKENS) ** 0.5))


def sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), TOKENS)


def by_run(df: DataFrame, key: str, handle: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Hand ``handle`` tables in which the rows of each key stand together.

    Rows are dealt and sorted by key; a key that runs over the end of a batch
    waits for the next one. Keys must have a bounded number of rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut or (waiting and waiting[-1].column(batch.schema.get_field_index(key))[-1].as_py() != keys[0]):
                whole = pa.Table.from_batches([*waiting, batch.slice(0, cut)])
                waiting = []
                if whole.num_rows:
                    yield from handle(whole.combine_chunks())
            waiting.append(batch.slice(cut))
        if waiting:
            yield from handle(pa.Table.from_batches(waiting).combine_chunks())

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(keys)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(keys)])


class Forest:
    """Which of a few documents are known to hang together."""

    def __init__(self, labels: list):
        first: dict = {}
        self.up = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(j)] = self.root(i)


def likely_groups(nodes: DataFrame, least: int) -> DataFrame:
    """(key, doc_id, text_hash): documents of one small node that the screen holds
    together.

    ``nodes`` has node, doc_id, text_hash, label, sketch. Documents of one label
    are compared elsewhere.
    Groups with the same members get the same key, from whichever tree.
    """

    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, label = (rows[c].to_numpy() for c in ("node", "label"))
        doc = np.column_stack([rows[c].to_numpy() for c in ("doc_id", "text_hash")])
        sketch = sketches(rows["sketch"].combine_chunks())
        keys, docs = [], []

        def emit(members: np.ndarray) -> None:
            members = np.unique(members, axis=0)
            if len(members) > 1:
                keys.append(np.full(len(members), xxhash.xxh64_intdigest(members.tobytes()), np.uint64))
                docs.append(members)

        for start, end in runs(node):
            size = end - start
            if size == 2:
                if label[start] != label[start + 1] and (sketch[start] == sketch[start + 1]).sum() >= least:
                    emit(doc[start:end])
                continue
            part, labels = sketch[start:end], label[start:end]
            forest = Forest(list(range(size)))
            touched = np.zeros(size, bool)
            for i in range(size - 1):
                near = np.flatnonzero(((part[i + 1 :] == part[i]).sum(axis=1) >= least) & (labels[i + 1 :] != labels[i]))
                for j in near + i + 1:
                    forest.join(i, int(j))
                    touched[i] = touched[j] = True
            tops = np.array([forest.root(i) for i in range(size)])
            for top in np.unique(tops[touched]):
                emit(doc[start:end][tops == top])
        key = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
        found = np.concatenate(docs) if docs else np.zeros((0, 2), np.int64)
        columns = [pa.array(c) for c in (key, np.ascontiguousarray(found[:, 0]), np.ascontiguousarray(found[:, 1]))]
        yield pa.RecordBatch.from_arrays(columns, names=["key", *IDENTITY])

    return by_run(nodes, "node", handle, "key bigint, doc_id bigint, text_hash bigint")


def linked_pairs(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Places i < j of the sets that reach the threshold, by exact counts."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        shared = np.array([[0, len(np.intersect1d(*sets, assume_unique=True))], [0, 0]])
    else:
        # Who has what, for the shingles that two sets have, some at a time.
        values, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        kept = np.cumsum(times > 1) - 1
        owner, column = np.repeat(np.arange(len(sets)), sizes), np.where(times[number] > 1, kept[number], -1)
        owner, column = owner[column >= 0], column[column >= 0]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for low in range(0, int((times > 1).sum()), 8192):
            cut = slice(*np.searchsorted(column, [low, low + 8192]))
            part = np.zeros((len(sets), 8192), np.float32)
            part[owner[cut], column[cut] - low] = 1
            shared += part @ part.T
        shared = np.triu(shared.round().astype(np.int64), 1)
    both = sizes[:, None] + sizes[None, :]
    return zip(*(found.tolist() for found in np.nonzero((100 * shared >= percent * (both - shared)) & (shared > 0))))


def confirm(groups: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of a spanning forest of each group, confirmed on full sets.

    ``groups`` has key, doc_id and text_hash. A group has at most some hundred
    documents.
    """
    texts = docs.select("doc_id", text_hash(), F.coalesce("text", F.lit("")).alias("text"))
    # Equal rows give one text; dealt out alike, this costs the join no shuffle more.
    texts = texts.groupBy(*IDENTITY).agg(F.first("text").alias("text"))
    # The groups grow with the table, so they are never broadcast.
    rows = groups.join(texts.hint("merge"), IDENTITY).select("key", "doc_id", "text")

    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, doc, text = rows["key"].to_numpy(), rows["doc_id"].to_numpy(), rows["text"]
        a, b = [], []
        for start, end in runs(key):
            order = start + np.argsort(doc[start:end], kind="stable")
            ids = doc[order].tolist()
            sets = [shingles(text[int(i)].as_py()) for i in order]
            forest = Forest(ids)
            for i, j in linked_pairs(sets, percent):
                if forest.root(i) != forest.root(j):
                    forest.join(i, j)
                    a.append(ids[i])
                    b.append(ids[j])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return by_run(rows, "key", handle, "a bigint, b bigint")


def typical(members: DataFrame) -> DataFrame:
    """(node, centre): the commonest value of each token among some members."""

    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        node, sketch = rows["node"].to_numpy(), sketches(rows["sketch"].combine_chunks())
        nodes, centres = [], []
        for start, end in runs(node):
            part = np.sort(sketch[start:end], axis=0)
            centre = np.empty(TOKENS, np.uint16)
            for t in range(TOKENS):
                values, counts = np.unique(part[:, t], return_counts=True)
                centre[t] = values[counts.argmax()]
            nodes.append(node[start])
            centres.append(centre.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(centres, pa.binary())], names=["node", "centre"])

    return by_run(members, "node", handle, "node bigint, centre binary")


def with_agreement(df: DataFrame, other: str) -> DataFrame:
    """Rows with the number of tokens on which ``sketch`` and ``other`` agree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = batch.schema.names
                same = sketches(batch.column(names.index("sketch"))) == sketches(batch.column(names.index(other)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(same.sum(axis=1).astype(np.int32))], names=[*names, "agree"])

    return df.mapInArrow(run, StructType([*df.schema, StructField("agree", IntegerType())]))


def pivots(members: DataFrame) -> DataFrame:
    """(node, pivot, pivot_sketch): the member most like what is typical of some
    sixty members; the choice decides about work, not about results."""
    some = members.filter(F.pmod(F.xxhash64("node", *IDENTITY), F.col("n")) < 64)
    centres = materialize(typical(some.select("node", "sketch")), "centres")
    # A node of which no member was drawn still has a pivot: its smallest doc_id.
    centred = members.join(centres, "node", "left").select("node", "doc_id", "sketch", F.coalesce("centre", "sketch").alias("centre"))
    scored = with_agreement(centred, "centre")
    best = scored.groupBy("node").agg(F.max(F.struct("agree", (-F.col("doc_id")).alias("minus"), "sketch")).alias("best"))
    return materialize(
        best.select("node", (-F.col("best.minus")).alias("pivot"), F.col("best.sketch").alias("pivot_sketch")), "pivots"
    )


def children(members: DataFrame) -> DataFrame:
    """(node, doc_id, text_hash, label): members branched on the tokens their node selects."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column(0).to_numpy().view(np.uint64)
            sketch = sketches(batch.column(4)).astype(np.uint64)
            own = spread(node + np.uint64(11))
            for k in range(BRANCHES):
                token = ((own + np.uint64(k * (TOKENS // BRANCHES))) % np.uint64(TOKENS)).astype(np.int64)
                value = sketch[np.arange(len(node)), token]
                child = spread(spread(own + np.uint64(k + 1)) + value).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(child), *batch.columns[1:4]], names=["node", *IDENTITY, "label"])

    columns = members.select("node", *IDENTITY, "label", "sketch")
    return columns.mapInArrow(run, "node bigint, doc_id bigint, text_hash bigint, label bigint")


def blocks(clusters: DataFrame) -> DataFrame:
    """(key, doc_id, text_hash): pairs of blocks of each cluster, (pivot, doc_id,
    text_hash), so that every member meets every other."""
    counted = clusters.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = clusters.join(counted, "pivot").withColumn("own", F.pmod(F.xxhash64(*IDENTITY), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(F.xxhash64("pivot", F.least("own", "other"), F.greatest("own", "other")).alias("key"), *IDENTITY)


def find_links(reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(a, b) links that connect what full sets connect.

    ``reps`` has doc_id, text_hash, roots, sketch, one row for each different set.
    """
    least = screen(percent)
    rows = reps.select(F.explode("roots").alias("node"), *IDENTITY, F.col("doc_id").alias("label"))
    by_doc = reps.select(*IDENTITY, "sketch")
    groups, clusters = None, None
    for level in range(DEPTH + 1):
        sizes = materialize(
            rows.groupBy("node")
            .agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
            .filter("low < high")
            .select("node", "n"),
            "nodes",
        )
        small = rows.join(sizes.filter(F.col("n") <= LEAF), "node").join(by_doc, IDENTITY)
        likely = likely_groups(small.select("node", *IDENTITY, "label", "sketch"), least)
        groups = likely if groups is None else groups.union(likely)
        if sizes.filter(F.col("n") > LEAF).isEmpty():
            break
        members = materialize(rows.join(sizes.filter(F.col("n") > LEAF), "node").join(by_doc, IDENTITY), "members")
        if level == DEPTH:
            near = members.select(F.col("node").alias("pivot"), *IDENTITY)
        else:
            vast, large = members.filter(F.col("n") > VAST), members.filter(F.col("n") <= VAST)
            seen = large.join(pivots(large), "node").select("node", *IDENTITY, "label", "sketch", "pivot", "pivot_sketch")
            known = materialize(with_agreement(seen, "pivot_sketch").drop("pivot_sketch"), "agreements")
            label = F.when(F.col("agree") >= NEAR, F.col("pivot")).otherwise(F.col("label"))
            onward = known.filter(F.col("agree") < CORE).select("node", *IDENTITY, label.alias("label"), "sketch")
            rows = materialize(children(onward.union(vast.select("node", *IDENTITY, "label", "sketch"))), "children")
            near = known.filter(F.col("agree") >= NEAR).select("pivot", *IDENTITY)
        clusters = near if clusters is None else clusters.union(near)
    if clusters is not None:
        groups = groups.union(blocks(materialize(clusters.distinct(), "clusters")))
    return confirm(groups.distinct(), docs, percent)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``docs``."""
    outputs = "n_shingles bigint, k1 bigint, k2 bigint, roots array<bigint>, sketch binary"
    n_trees = trees(percent)
    hashed = docs.select("doc_id", "text", text_hash())
    described = materialize(
        map_texts(hashed, IDENTITY, "text", outputs, partial(describe, n_trees), lambda found: 16 * n_trees + 3 * TOKENS), "sketches"
    )
    joining = described.filter("n_shingles > 0 and doc_id is not null")
    classes = (
        joining.groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("class_id"), F.max("doc_id").alias("last"))
        .filter("class_id < last")
        .drop("last")
    )
    # Written first, so that the join below deals out both sides by itself and
    # adaptive execution can split a class with very many copies.
    classes = materialize(classes, "equal-sets")
    classed = materialize(
        described.join(classes, ["k1", "k2"], "left").withColumn(
            "class_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
        ),
        "classes",
    )
    # A row for each different set of a doc_id, by whichever of its texts.
    one = [F.min_by(name, "text_hash").alias(name) for name in ("roots", "sketch")]
    reps = classed.filter("n_shingles > 0 and doc_id = class_id").groupBy("doc_id", "k1", "k2")
    reps = materialize(reps.agg(F.min("text_hash").alias("text_hash"), *one).drop("k1", "k2"), "different-sets")
    texts = docs.select("doc_id", "text").filter("doc_id is not null")
    links = find_links(reps, texts, percent)
    # Rows that share a doc_id but not a set tie their classes together.
    shared = classed.filter("n_shingles > 0 and doc_id <> class_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b"))
    repeated = classed.filter("n_shingles > 0").groupBy("doc_id").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y")).filter("x < y")
    tied = repeated.select(F.col("x").alias("a"), F.col("y").alias("b")).union(
        shared.join(repeated.select(F.col("doc_id").alias("b")), "b").select("a", "b")
    )
    found = components(links.union(tied)).withColumnRenamed("node", "class_id")
    return classed.join(found, "class_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "class_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "class_id"), F.lit(True)).alias("kept"),
    )
