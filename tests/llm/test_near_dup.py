from __future__ import annotations

import random
import re

import numpy as np
import pytest

from shelfmark.llm import near_dup
from shelfmark.llm.common import table
from shelfmark.llm.components import components
from shelfmark.llm.near_dup import near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows, percent):
    rows = [(d, shingle_set(t)) for d, t in rows]
    up = {d: d for d, _ in rows}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                up[high] = low
    return sorted((d, len(s), root(d), root(d) == d) for d, s in rows)


def found(docs, percent=85):
    return sorted(tuple(r) for r in near_duplicates(docs, percent).collect())


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def edited(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("percent", [80, 85])
def test_sample_table_against_brute_force(spark, sf_dir, percent):
    docs = table(spark, sf_dir, "documents")
    assert found(docs, percent) == brute_force([(r.doc_id, r.text) for r in docs.collect()], percent)


def test_large_groups_of_near_copies(documents):
    """One group far above a leaf, with fringe members, and a passage all share."""
    rng = random.Random(5)
    base, passage = words(rng, 300), words(rng, 30)
    texts = [edited(rng, base, rng.choice([1, 2, 3, 4, 9])) for _ in range(220)]
    texts += [" ".join(passage + words(rng, rng.choice([3, 6, 60]))) for _ in range(150)]
    texts += [" ".join(words(rng, 80)) for _ in range(60)] + texts[:40]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(documents(rows)) == brute_force(rows, 85)


def test_what_stays_large_is_compared_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(near_dup, "DEPTH", 0)
    rng = random.Random(6)
    bases = [words(rng, 120) for _ in range(4)]
    texts = [edited(rng, rng.choice(bases), rng.choice([1, 2, 5])) for _ in range(200)]
    rows = list(enumerate(texts))
    assert found(documents(rows)) == brute_force(rows, 85)


def test_edges(documents, spark):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A\x0bB"), (6, "a b c d e"), (7, "a b c d e f"), (8, long), (9, long + " y"), (10, "\u00a0"), (11, "É b"), (12, "é b")]
    docs = documents(rows, "1 AS node").selectExpr("*", "2 AS component_id", "3 AS kept")
    assert found(docs) == brute_force(rows, 85)
    assert found(documents([])) == []


def test_repeated_rows_and_missing_ids(documents):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "p q r s t"), (2, "a b c d e"), (3, "p q r s t"), (None, "p q r s t"), (4, "z")]
    result = sorted(map(tuple, near_duplicates(documents(rows)).collect()), key=str)
    assert result == sorted(
        [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (2, 1, 1, False), (3, 1, 1, False), (None, 1, None, True), (4, 1, 4, True)], key=str
    )


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(129, 60), (7, 7)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    result = {r.node: r.component for r in components(links).collect()}
    assert all(result[i] == 0 for i in range(41))
    assert all(result[k] == 60 for k in [60, *range(100, 130)])


def test_shingles_of_windows():
    assert len(near_dup.shingles("a b c d e a b c d e")) == 5
    assert len(near_dup.shingles("")) == 0
    assert np.array_equal(near_dup.shingles("A b"), near_dup.shingles("a\tB"))


def test_one_id_repeated_very_often_keeps_its_links(documents):
    """Equal rows of one doc_id are a large node whose members all hash alike."""
    rng = random.Random(11)
    base = words(rng, 200)
    text, near = " ".join(base), edited(rng, base, 1)
    rows = [(1, text)] * 1500 + [(2, near), (3, " ".join(words(rng, 50)))]
    result = found(documents(rows).repartition(4))
    assert len(result) == len(rows)
    assert {(r[0], r[2], r[3]) for r in result} == {(1, 1, True), (2, 1, False), (3, 3, True)}


def test_one_id_with_very_many_texts_keeps_all_their_links(documents):
    rng = random.Random(12)
    bases = [words(rng, 60) for _ in range(40)]
    rows = [(500, edited(rng, rng.choice(bases[:20]), rng.choice([0, 1]))) for _ in range(300)]
    rows += [(k, edited(rng, bases[k % 40], 1)) for k in range(1, 80)]
    wanted = brute_force([(k, t) for k, t in rows], 85)
    result = found(documents(rows))
    assert sorted({(r[0], r[2]) for r in result}) == sorted({(r[0], r[2]) for r in wanted})


@pytest.mark.parametrize("percent", [80, 85])
def test_recall_of_pairs_at_the_threshold(documents, monkeypatch, percent):
    """Pairs just above the threshold, in nodes that branch as far as they can."""
    monkeypatch.setattr(near_dup, "LEAF", 1)
    rng = random.Random(percent)
    rows, wanted = [], 0
    for k in range(150):
        base = words(rng, 100)
        # Words put at the end make so many of the 96 shingles differ on each side.
        new = next(n for n in range(30, 0, -1) if 100 * (96 - n) >= percent * (96 + n))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:-new] + words(rng, new)))]
        wanted += 1
    linked = sum(not r[3] for r in found(documents(rows), percent))
    assert linked == wanted


def test_trees_follow_the_percentage():
    for percent in (70, 80, 85, 95):
        p = percent / 100
        kept = p * (1 - (1 - p) ** near_dup.BRANCHES) ** near_dup.DEPTH
        n = near_dup.trees(percent)
        assert (1 - kept) ** n <= near_dup.MISSED < (1 - kept) ** (n - 1)
    assert near_dup.trees(85) == 8 and near_dup.trees(100) == 1
