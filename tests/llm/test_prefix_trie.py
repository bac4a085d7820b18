from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfmark.llm import prefix_trie as pt
from shelfmark.llm.common import table
from shelfmark.llm.prefix_trie import NodeTable, prefix_trie, turn_digest


def brute_force(rows):
    """Rows (conv_id, turn, role, text), by dicts over whole prefixes."""
    original = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            original[conv_id].append((turn, role or "", text or ""))
    original = {c: [t[1:] for t in sorted(ts, key=lambda t: (t[0] is not None, t[0] or 0))] for c, ts in original.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(original):
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt = original.get(c - int(np.fmod(c, 100)), [])[:h] + original[c][h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append(c)
        ends[tuple(rebuilt)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            members[n][0], len(n), members[n[:-1]][0] if n else None, len(members[n]), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in members
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()))


def frame(spark, rows, *extra):
    made = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return made.selectExpr("*", *extra)


def test_sample_table(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    assert found(prefix_trie(conversations)) == brute_force(rows)


def some_rows(seed, conversations=260, longest=9, vocabulary=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(700), conversations):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, turn, draw.choice(["user", None, "x"]), draw.choice(["", None, "né", "hello", "a" * 50][: vocabulary + 2])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [2, 4096])
def test_any_segment_and_shard_size(spark, monkeypatch, segment):
    monkeypatch.setattr(pt, "SEGMENT", segment)
    rows = some_rows(segment) + [(1050, t, "user", f"turn {t % 3}") for t in range(41)]
    assert found(prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_shards_cut_anywhere(spark, monkeypatch):
    whole = pt.subtree_sums
    monkeypatch.setattr(pt, "subtree_sums", lambda *frames: whole(*frames, shard_rows=7))
    ends = pt.end_digests
    monkeypatch.setattr(pt, "end_digests", lambda path: ends(path, chunk_ids=3))
    rows = some_rows(5, vocabulary=1)
    assert found(prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_frequent_parents_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(pt, "HOT_LEAST", 3)
    rows = [(c, t, "user", "start" if t == 0 else f"{c} {t}") for c in range(120) for t in range(7)]
    assert found(prefix_trie(frame(spark, rows))) == brute_force(rows)


def test_edges(spark):
    rows = [
        (None, 1, "user", "left out"), (105, None, None, None), (105, 0, "user", "b"), (107, 3, "user", "c"),
        (-3, 0, "user", "x"), (-3, 1, None, "y"), (-300, 0, "user", "x"), (2**60, 5, "r", "t"), (108, 1, "u", "same"),
        (108, 1, "u", "same"), (200, 0, "u", "long " * 100_000), (201, 0, "u", "long " * 100_000), (201, 1, "u", "z"),
    ]
    extra = frame(spark, rows, "'k' AS depth", "2 AS a", "3 AS row", "4 AS digest")
    assert found(prefix_trie(extra)) == brute_force(rows)


def test_turnless_conversations_end_at_the_root(spark):
    # crc32("105") % 6 turns are cut, and conversation 100 is absent.
    cut = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(cut, 0, "user", "only")]
    wanted = brute_force(rows)
    assert wanted == [(cut, 0, None, 1, 0, 1, 0, hashlib.sha256(str(cut).encode()).hexdigest())]
    assert found(prefix_trie(frame(spark, rows))) == wanted


def test_empty_table(spark):
    assert prefix_trie(frame(spark, [])).collect() == []


def test_role_and_text_do_not_run_into_each_other():
    assert turn_digest("ab", "c") != turn_digest("a", "bc")


def test_slots_are_minimal_and_verified():
    draw = np.random.default_rng(1)
    depth, a, b = draw.integers(0, 9, 5000), draw.integers(0, 2**61, 5000), draw.integers(0, 2**61, 5000)
    twice = [np.concatenate([k, k]) for k in (depth, a, b)]
    nodes = NodeTable(*twice)
    slots = nodes.slots(depth, a, b)
    assert nodes.size == 5000 and sorted(slots) == list(range(5000))
    with pytest.raises(ValueError):
        nodes.slots(depth[:1], a[:1] + 1, b[:1])
