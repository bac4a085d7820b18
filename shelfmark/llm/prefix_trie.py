"""Prefix trie of conversations in minimal-perfect-hash node tables (operator 13).

Conversations are rebuilt: conversation c begins with the first turns of the
first conversation of its hundred. Each distinct sequence of turns that begins a
conversation is a node, the textless root included; the result has a row for each.

1. Turns are dealt by ranges of (conv_id, turn), numbered where they lie, and
   counted on over the borders of the ranges. From here on a turn is a digest of
   122 bits and a length; texts move once.
2. A node's digest is the sum of its turns' digests times powers of a fixed
   number, modulo a prime, so prefixes of long conversations are summed in
   segments of ``SEGMENT`` turns and the segments' sums are added afterwards.
3. Equal digests are one node: one grouping gives members, smallest member and
   whether the node has children, and fails if turns of a node disagree.
4. A node belongs to its smallest member, which then also owns what follows on
   its own path. Paths of owners are dealt to shards by hundreds of
   conversations. A shard enumerates its distinct digests, gives each a slot by a
   minimal perfect hash that is verified against the digest, scatters the owners'
   counts into flat arrays, and adds them up through an array of parent slots, the
   deepest nodes first. A node that stands in several shards is counted in full by
   adding up its parts, because each node's own count stands in one shard only.
5. Ids of the members that end at a node are joined in order in chunks, and the
   chunks are hashed in order.

A shard takes at most ``SHARD_ROWS`` rows at a time (and the rest of a path of
``SEGMENT`` turns); a longer conversation is cut into such bands, and what a deeper
band sums up to enters the band above as a count of its last turn. So no turn,
conversation, or group of equal ones has to fit one task.

Edge cases: rows without conv_id belong to no conversation and are left out;
null roles and texts are empty; turns of one number come in the order of hashes
of role and text; repeated rows are turns of their own; an empty table has no
node, not even a root; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Conversations of one hundred share their first turns, at most HEADS - 1 of them.
HUNDRED, HEADS = 100, 6
PRIME = (1 << 61) - 1
#: Any two numbers below the prime; digests are sums over powers of them.
POWERS = (0x0B5C_9A4E_51D7_2F63, 0x16E3_7C01_A8F2_94BD)
SEGMENT = 4096
SHARD_ROWS = 200_000
CHUNK_IDS = 4096
#: A parent with more chains below it than this share of all is looked up apart.
HOT_SHARE, HOT_LEAST = 1000, 1000
KEY = ["depth", "a", "b"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def parts_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def turn_digest(role: str, text: str) -> tuple[int, int]:
    head = role.encode()
    digest = hashlib.blake2b(len(head).to_bytes(8, "little") + head + text.encode(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little") % PRIME, int.from_bytes(digest[8:], "little") % PRIME


def batch(kinds: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, n, ta, tb, chars): turns without texts, numbered from 1
    within their conversation and ``part``; parts follow each other."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), F.xxhash64(role, text).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    key = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    dealt = rows.repartitionByRange(parts_of(rows), *key).sortWithinPartitions(*key).select("conv_id", "role", "text")
    names = ["conv_id", "part", "n", "ta", "tb", "chars"]
    kinds = dict.fromkeys(names, pa.int64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for found in batches:
            rows = []
            for conv_id, role, text in zip(*found.columns):
                conv_id, text = conv_id.as_py(), text.as_py()
                n = n + 1 if conv_id == last else 1
                last = conv_id
                rows.append((conv_id, part, n, *turn_digest(role.as_py(), text), len(text)))
            if rows:
                yield batch(kinds, rows)

    return materialize(dealt.mapInArrow(run, ", ".join(f"{name} bigint" for name in names)), "turns")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of rebuilt conversations (conv_id, depth, ta, tb, chars, length) and
    the conversations (conv_id, length), turnless ones included."""
    turns = numbered_turns(conversations)
    pieces = materialize(turns.groupBy("conv_id", "part").agg(F.max("n").alias("n")), "turn-pieces")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one conversation goes on over each border between two parts.
    going_on = pieces.select("conv_id", "part", F.sum("n").over(earlier).alias("before")).filter("before is not null")
    turns = turns.join(F.broadcast(going_on), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("n") + F.coalesce("before", F.lit(0))).alias("at"), "ta", "tb", "chars"
    )

    conv_id = F.col("conv_id")
    heads = F.pmod(F.crc32(conv_id.cast("string")), F.lit(HEADS))
    own = pieces.groupBy("conv_id").agg(F.sum("n").alias("own"))
    named = own.select("conv_id", "own", (conv_id - conv_id % HUNDRED).alias("base"), heads.alias("h"))
    bases = own.filter(conv_id % HUNDRED == 0).select(conv_id.alias("base"), F.col("own").alias("base_own"))
    head = F.least("h", F.coalesce("base_own", F.lit(0)))
    found = materialize(
        named.join(bases, "base", "left").select(
            "conv_id", "base", "h", head.alias("head"), (head + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")
        ),
        "conversations",
    )
    at, h, base = F.col("at"), F.col("h"), F.col("base")
    kept = turns.join(found, "conv_id").filter((at > h) | (conv_id == base))
    depth = F.when(at > h, at - h + F.col("head")).otherwise(at)
    kept = kept.select("conv_id", depth.alias("depth"), "ta", "tb", "chars", "length")
    first = turns.filter((at < HEADS) & (conv_id % HUNDRED == 0)).withColumnRenamed("conv_id", "base")
    taken = first.join(found, "base").filter((at <= h) & (conv_id != base))
    taken = taken.select("conv_id", at.alias("depth"), "ta", "tb", "chars", "length")
    return kept.union(taken), found.select("conv_id", "length")


def paths(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, pa, pb, ta, chars, length): the node that each turn of
    each conversation reaches, and the one before; depth 0 is the root."""
    names = ["conv_id", "depth", "a", "b", "pa", "pb", "ta", "chars", "length"]
    segment = F.expr(f"(depth - 1) div {SEGMENT}")
    columns = turns.select("conv_id", segment.alias("segment"), "depth", "ta", "tb", "chars", "length")
    dealt = columns.repartition(parts_of(turns), "conv_id", "segment").sortWithinPartitions("conv_id", "segment", "depth")
    kinds = dict.fromkeys(names, pa.int64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, a, b, power_a, power_b = None, 0, 0, 1, 1
        for found in batches:
            rows = []
            for conv_id, piece, depth, ta, tb, chars, length in zip(*(c.to_pylist() for c in found.columns)):
                if (conv_id, piece) != last:
                    last, a, b = (conv_id, piece), 0, 0
                    power_a, power_b = (pow(p, depth, PRIME) for p in POWERS)
                before = a, b
                a, b = (a + ta * power_a) % PRIME, (b + tb * power_b) % PRIME
                power_a, power_b = power_a * POWERS[0] % PRIME, power_b * POWERS[1] % PRIME
                rows.append((conv_id, depth, a, b, *before, ta, chars, length))
            if rows:
                yield batch(kinds, rows)

    summed = materialize(dealt.mapInArrow(run, ", ".join(f"{name} bigint" for name in names)), "prefixes")
    # What the segments before add; few conversations have more than one.
    upto = Window.partitionBy("conv_id").orderBy("segment")

    def total(name: str) -> Column:
        return (F.sum(F.col(name).cast("decimal(38,0)")).over(upto) % PRIME).cast("bigint")

    borders = summed.filter((F.col("depth") % SEGMENT == 0) & (F.col("length") > F.col("depth")))
    borders = borders.select("conv_id", F.expr(f"depth div {SEGMENT}").alias("segment"), "a", "b")
    before = borders.select("conv_id", "segment", total("a").alias("ca"), total("b").alias("cb"))
    deep = summed.filter(F.col("depth") > SEGMENT).withColumn("segment", segment).join(before, ["conv_id", "segment"])
    moved = {name: ((F.col(name) + F.col(f"c{name[-1]}")) % PRIME).alias(name) for name in ("a", "b", "pa", "pb")}
    deep = deep.select(*[moved.get(name, F.col(name)) for name in names])
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = {"depth": zero, "a": zero, "b": zero, "pa": none, "pb": none, "ta": zero, "chars": zero}
    roots = conversations.select(*[root[name].alias(name) if name in root else F.col(name) for name in names])
    return summed.filter(F.col("depth") <= SEGMENT).union(deep).union(roots)


def distinct_nodes(path: DataFrame) -> DataFrame:
    """A row for each node: its smallest member, members, the digest of its parent,
    whether it is a leaf, and what its own text saves."""
    one = F.when(F.min("ta") == F.max("ta"), F.min("conv_id"))
    grouped = path.groupBy(*KEY).agg(
        F.coalesce(one, F.raise_error(F.lit("turns of a node disagree")).cast("bigint")).alias("conv_id"),
        F.count("*").alias("n_convs"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("length").alias("longest"), F.max("chars").alias("chars"),
    )
    leaf = (F.col("longest") == F.col("depth")).cast("bigint")
    saved = (F.col("n_convs") - 1) * F.col("chars")
    return grouped.select(*KEY, "conv_id", "n_convs", "pa", "pb", leaf.alias("leaf"), saved.alias("saved"))


class NodeTable:
    """Slots 0 to n-1 for n distinct digests, by a minimal perfect hash.

    Each level hashes the digests that are left into twice as many cells; those
    alone in their cell take the next slots, the others go down a level.
    """

    def __init__(self, depth: np.ndarray, a: np.ndarray, b: np.ndarray):
        order = np.lexsort((b, a, depth))
        depth, a, b = depth[order], a[order], b[order]
        new = np.ones(len(order), bool)
        new[1:] = (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        keys = depth[new], a[new], b[new]
        self.levels: list[np.ndarray] = []
        left, slots = np.arange(len(keys[0])), 0
        while len(left):
            size = 2 * len(left)
            cells = self._cells(len(self.levels), size, *(k[left] for k in keys))
            alone = np.bincount(cells, minlength=size) == 1
            self.levels.append(np.where(alone, np.cumsum(alone) - 1 + slots, -1))
            slots += int(alone.sum())
            left = left[~alone[cells]]
        self.size = slots
        self.depth, self.a, self.b = (np.zeros(slots, np.int64) for _ in range(3))
        at = self._find(*keys)
        if len(np.unique(at)) != slots:
            raise ValueError("two digests share a slot")
        self.depth[at], self.a[at], self.b[at] = keys

    @staticmethod
    def _cells(level: int, size: int, depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = a.astype(np.uint64) ^ (depth.astype(np.uint64) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b.astype(np.uint64)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def _find(self, depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slots = np.full(len(depth), -1)
        left = np.arange(len(depth))
        for level, table in enumerate(self.levels):
            slots[left] = table[self._cells(level, len(table), depth[left], a[left], b[left])]
            left = left[slots[left] < 0]
        return slots

    def slots(self, depth: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of digests of the table; any other digest is an error."""
        found = self._find(depth, a, b)
        if (found < 0).any() or (self.depth[found] != depth).any() or (self.a[found] != a).any() or (self.b[found] != b).any():
            raise ValueError("a digest that the table does not hold")
        return found


def sum_up(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Sums of leaf and saved over the subtrees that the paths ``rows`` make: rows
    of a path stand together, shallow ones first; a depth may be repeated."""
    key = [rows[name] for name in KEY]
    table = NodeTable(*key)
    slot = table.slots(*key)
    parent = np.full(table.size, -1)
    path_goes_on = (rows["conv_id"][1:] == rows["conv_id"][:-1]) & (rows["band"][1:] == rows["band"][:-1])
    below = np.flatnonzero(path_goes_on & (rows["depth"][1:] > rows["depth"][:-1])) + 1
    parent[slot[below]] = slot[below - 1]
    sums = {}
    order = np.argsort(table.depth, kind="stable")
    cuts = np.flatnonzero(np.diff(table.depth[order])) + 1
    levels = [level[parent[level] >= 0] for level in np.split(order, cuts)]
    for name in ("leaf", "saved"):
        sums[name] = np.zeros(table.size, np.int64)
        np.add.at(sums[name], slot, rows[name])
        for level in reversed(levels):
            np.add.at(sums[name], parent[level], sums[name][level])
    return {"depth": table.depth, "a": table.a, "b": table.b} | sums


def subtree_sums(nodes: DataFrame, path: DataFrame, chains: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(depth, a, b, leaf, saved): parts of the sums over each node's subtree.

    ``chains`` names the depth from which on a conversation owns its path.
    """
    names = ["conv_id", "band", *KEY, "leaf", "saved"]
    band = F.expr(f"depth div {SEGMENT}").alias("band")
    zero = F.lit(0).cast("bigint")
    owned = nodes.select("conv_id", band, *KEY, "leaf", "saved")
    above = path.join(chains, "conv_id").filter(F.col("depth") < F.col("top"))
    rows = owned.union(above.select("conv_id", band, *KEY, zero.alias("leaf"), zero.alias("saved")))

    # Of conversations longer than a band: what deeper bands own, at the last turn
    # of each band above.
    deeper = Window.partitionBy("conv_id").orderBy(F.col("band").desc())
    of_band = owned.filter("band > 0").groupBy("conv_id", "band").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    suffix = of_band.select("conv_id", "band", F.sum("leaf").over(deeper).alias("leaf"), F.sum("saved").over(deeper).alias("saved"))
    first = suffix.join(chains, "conv_id").filter(F.col("band") == F.greatest(F.expr(f"top div {SEGMENT}"), F.lit(1)))
    gaps = first.filter("band > 1").select(
        "conv_id", F.explode(F.sequence(zero, F.col("band") - 2)).alias("band"), "leaf", "saved"
    )
    carried = suffix.select("conv_id", (F.col("band") - 1).alias("band"), "leaf", "saved").union(gaps)
    last = path.filter(F.col("depth") % SEGMENT == SEGMENT - 1).select("conv_id", band, *KEY)
    rows = rows.select(*names).union(last.join(carried, ["conv_id", "band"]).select(*names))

    hundred = F.col("conv_id") - F.col("conv_id") % HUNDRED
    dealt = rows.repartition(parts_of(rows), hundred, F.col("band")).sortWithinPartitions("conv_id", "band", "depth")
    out = [*KEY, "leaf", "saved"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flushed(whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            columns = pa.Table.from_batches(held)
            rows = {name: columns.column(name).to_numpy() for name in names}
            size, held = len(columns), []
            if not whole:  # the last path may go on in the next batch
                same = (rows["conv_id"] == rows["conv_id"][-1]) & (rows["band"] == rows["band"][-1])
                size = int(np.argmax(same))
                held = columns.slice(size).to_batches()
            if size:
                sums = sum_up({name: values[:size] for name, values in rows.items()})
                yield pa.RecordBatch.from_arrays([pa.array(sums[name]) for name in out], names=out)

        for found in batches:
            held.append(found)
            if sum(b.num_rows for b in held) >= shard_rows:
                yield from flushed(False)
        if held:
            yield from flushed(True)

    return dealt.mapInArrow(run, ", ".join(f"{name} bigint" for name in out))


def end_digests(path: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """(depth, a, b, ends): SHA-256 of the ids of conversations that end at a node."""
    ends = path.filter("depth = length").select(*KEY, "conv_id")
    parts = parts_of(path)
    dealt = ends.repartitionByRange(parts, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    numbers = dict.fromkeys([*KEY, "first"], pa.int64())

    def chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, rows = None, [], []
        for found in batches:
            for depth, a, b, conv_id in zip(*(c.to_pylist() for c in found.columns)):
                if (depth, a, b) != node or len(ids) >= chunk_ids:
                    if ids:
                        rows.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = (depth, a, b), []
                ids.append(conv_id)
            if rows:
                yield batch(numbers | {"ids": pa.string()}, rows)
                rows = []
        if ids:
            yield batch(numbers | {"ids": pa.string()}, [(*node, ids[0], ",".join(map(str, ids)))])

    chunks = dealt.mapInArrow(chunked, "depth bigint, a bigint, b bigint, first bigint, ids string")
    ordered = chunks.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first")
    named = {name: numbers[name] for name in KEY} | {"ends": pa.string()}

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, rows = None, None, []
        for found in batches:
            for depth, a, b, _, ids in zip(*(c.to_pylist() for c in found.columns)):
                if (depth, a, b) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        rows.append((*node, state.hexdigest()))
                    node, state = (depth, a, b), hashlib.sha256(ids.encode())
            if rows:
                yield batch(named, rows)
                rows = []
        if node:
            yield batch(named, [(*node, state.hexdigest())])

    return ordered.mapInArrow(hashed, "depth bigint, a bigint, b bigint, ends string")


def chain_parents(nodes: DataFrame, chains: DataFrame) -> DataFrame:
    """(depth, a, b, parent_conv_id) of the first node that a conversation owns.

    What follows on its path has the conversation itself as parent's owner. A node
    with a thousandth of all chains below it, of which there are at most a
    thousand, is looked up by a broadcast; no other key is that frequent.
    """
    tops = nodes.join(chains, "conv_id").filter((F.col("depth") == F.col("top")) & (F.col("depth") > 0))
    tops = tops.select(*KEY, (F.col("depth") - 1).alias("pd"), "pa", "pb")
    parents = nodes.select(F.col("depth").alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    up = ["pd", "pa", "pb"]
    least = max(HOT_LEAST, chains.count() // HOT_SHARE)
    hot = tops.groupBy(*up).count().filter(F.col("count") > least).drop("count")
    hot = materialize(parents.join(F.broadcast(hot), up), "hot-parents")
    by_broadcast = tops.join(F.broadcast(hot), up)
    rest = tops.join(F.broadcast(hot.drop("parent_conv_id")), up, "left_anti").join(parents, up)
    return by_broadcast.select(*KEY, "parent_conv_id").union(rest.select(*KEY, "parent_conv_id"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations."""
    turns, found = rebuilt_turns(conversations)
    path = paths(turns, found)
    nodes = materialize(distinct_nodes(path), "trie-nodes")
    chains = materialize(nodes.groupBy("conv_id").agg(F.min("depth").alias("top")), "trie-chains")
    facts = {
        "conv_id": "bigint", "n_convs": "bigint", "parent_conv_id": "bigint", "n_children": "bigint",
        "leaf": "bigint", "saved": "bigint", "ends": "string",
    }

    def part(df: DataFrame) -> DataFrame:
        return df.select(*KEY, *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in facts.items()])

    children = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    parts = [
        nodes.drop("leaf", "saved"),
        children.withColumn("n_children", F.lit(1).cast("bigint")),
        subtree_sums(nodes, path, chains),
        end_digests(path),
        chain_parents(nodes, chains),
    ]
    whole = reduce(DataFrame.union, map(part, parts)).groupBy(*KEY).agg(
        F.max("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("above"), F.max("n_convs").alias("n_convs"),
        F.coalesce(F.sum("n_children"), F.lit(0)).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"), F.coalesce(F.max("ends"), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    parent = F.when(F.col("depth") > 0, F.coalesce("above", "conv_id"))
    return whole.select(
        "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
