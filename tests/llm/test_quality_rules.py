from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from shelfmark.llm.common import table
from shelfmark.llm.quality_rules import LEVELS, apply_rules, measured, pick, select_cutoffs, statistics, upper_bound


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), n < 50 or 100 * len(covered) > 50 * n


EDGES = [None, "", " \n ", "a", "a b", "a b c", "a a a a", "a a a", "x\ny\nx\n \n \n", "é\u00a0b\x85c \x1cd", "# * <a|b> &", "l\r\nl\r\nl", "a b c d " * 30_000, "w" * 100_000]


@pytest.mark.parametrize("text", EDGES)
def test_statistics_of_edges(text):
    assert statistics(text or "")[:5] == brute(text)[:5]


def test_sample_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = {r.doc_id: tuple(r)[1:] for r in apply_rules(docs, table(spark, sf_dir, "labels")).collect()}
    for row in docs.collect():
        wanted = brute(row.text)
        assert found[row.doc_id][:6] == wanted
        assert not (wanted[5] and found[row.doc_id][6])


def make(rng, kind):
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(80)]
    if kind == "junk":
        words = [w + "%%%" * (i % 3 == 0) for i, w in enumerate(words)]
    return " ".join(words)


def test_cutoffs_are_certified_by_stratum(documents, spark):
    rng = random.Random(1)
    rows = [(i, make(rng, "junk" if i % 5 == 0 else "clean")) for i in range(3000)]
    docs = documents(rows, "0 AS kept").drop("lang").selectExpr("*", "if(doc_id < 2900, 'en', if(doc_id < 2990, 'de', null)) AS lang", "1 AS stratum")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(3000)] + [(None, 1, 0), (99999, 0, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in apply_rules(docs, labels).collect()}
    assert not any(kept[i] for i in range(0, 2900, 5))
    assert sum(kept[i] for i in range(2900) if i % 5) >= 2320 * 0.98
    assert all(kept[i] for i in range(2900, 3000))  # too few labels there
    assert all(r.kept for r in apply_rules(docs, labels.filter("doc_id < 0")).collect())
    assert apply_rules(docs.filter("doc_id < 0"), labels).count() == 0


def test_a_repeated_document_is_one_trial(documents, spark):
    rng = random.Random(3)
    rows = [(i, make(rng, "junk" if i % 5 == 0 else "clean")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    once = measured(documents(rows), "doc_id")
    often = measured(documents(rows + [rows[7]] * 300 + [rows[5]] * 300), "doc_id")
    assert select_cutoffs(once, labels) == select_cutoffs(often, labels)


def test_bound_is_the_exact_one():
    assert upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    p = upper_bound(7, 300, 0.01)
    tail = sum(math.comb(300, k) * p**k * (1 - p) ** (300 - k) for k in range(8))
    assert tail == pytest.approx(0.01, rel=1e-6)
    assert upper_bound(5, 5, 0.1) == 1.0


def test_the_mildest_level_that_catches_nearly_all_is_taken():
    assert pick([(0, 0), (0, 50), (1, 50), (90, 60)] + [(0, 0)] * (len(LEVELS) - 4), 1000, 0.01, 0.02) == 1
    assert pick([(0, 9)], 10, 0.01, 0.02) is None
