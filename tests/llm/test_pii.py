from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import pii
from shelfmark.llm.common import table
from shelfmark.llm.pii import KINDS, base_spans, cutoffs, find_pii, lower_bound, pii_report, redact, train_pii, written
from shelfmark.llm.trees import Split

# The patterns as the contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, d in enumerate(reversed(number)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PLAIN[kind], text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


EDGES = [
    None, "", "a@b.c.d_e@f.g", "x@y", "a@b@c.d", "..@-.-", "1.2.3.4.5.6.7.8.9", "256.1.1.1 01.002.0003.255", "0000000000255.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1112 4111  1111", "+1 (499) 555-6503", "+1 2", "++12 345 678 901 234 567", "+49-(0)-30.1234567",
    "é😀 a@b.cd 😀 1.1.1.1 é", "+1" + " 2" * 7 + " +3", "a" * 200_000, "9" * 200_000, "1.1.1.1" * 3_000, "a@" * 5_000, "+1 " * 5_000, "a.b@c.d " * 300,
]


def test_base_spans_of_edges(documents, spark):
    docs = documents(list(enumerate(EDGES))).withColumn("text", F.coalesce("text", F.lit("")))
    rows = docs.select("doc_id", *[F.transform(base_spans(F.col("text"), k), lambda s: F.struct(s["start"], s["end"])).alias(k) for k in KINDS]).collect()
    for r in rows:
        found = [(k, s[0], s[1]) for k in KINDS for s in r[k]]
        assert found == brute(EDGES[r.doc_id]), EDGES[r.doc_id][:60]


def test_random_texts_of_few_characters(documents):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab1923.@+- ()é") for _ in range(120)) for _ in range(300)]
    texts += [" ".join("".join(rng.choice("0123456789") for _ in range(rng.choice([3, 4, 13, 16]))) for _ in range(20)) for _ in range(100)]
    docs = documents(list(enumerate(texts)))
    for r in docs.select("doc_id", *[base_spans(F.col("text"), k).alias(k) for k in KINDS]).collect():
        assert [(k, s.start, s.end) for k in KINDS for s in r[k]] == brute(texts[r.doc_id])


def check(rows, documents):
    found = {r.doc_id: r for r in rows}
    for doc_id, text in documents:
        base, r = brute(text), found[doc_id]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(b[0] == k for b in base) for k in KINDS]
        spans = [tuple(s.split(":")) for s in r.spans.split(",") if s]
        assert spans == sorted(spans, key=lambda s: (KINDS.index(s[0]), int(s[1])))
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(spans)


def test_sample_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check(pii_report(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_repeats_missing_ids_and_clashing_names(documents):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (None, "1.1.1.1"), (2, None)]
    docs = documents(rows, "1 AS base").selectExpr("*", "2 AS candidates", "3 AS found", "4 AS base_spans")
    found = sorted((str(r.doc_id), r.spans) for r in pii_report(docs).collect())
    assert found == [("1", "email:0:6"), ("1", "email:0:6"), ("2", ""), ("None", "ip:0:7")]
    assert pii_report(documents([])).count() == 0


@pytest.fixture(scope="module")
def contacts(spark):
    """Texts with valid data, and with other numbers of other shapes."""
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = []
    for i in range(600):
        phone = f"+1 ({number(3)}) 555-{number(4)}"
        card = next(c for c in iter(lambda: "4" + number(15), None) if luhn(c))
        rows.append((i, f"word {phone} more words {card} id{number(12)}x and {number(7)}abc or x{number(16)}"))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_added_spans_pass_a_calibrated_threshold(contacts, spark):
    model = train_pii(contacts)
    assert model.thresholds["card"] <= 1
    card = next(c for c in (f"4{k:015d}" for k in range(10**14, 10**14 + 50)) if not luhn(c))
    texts = [(1, f"paid with {card} today"), (2, "nothing 12 here"), (3, "id123456789012x")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = {r.doc_id: r.line for r in find_pii(docs, model).select("doc_id", written(F.col("found")).alias("line")).collect()}
    assert "card:10:26" in found[1]
    assert found[2] == ""


def test_nothing_but_expressions(contacts):
    plan = find_pii(contacts, pii.PiiModel(pii.BoostedTrees(()), dict.fromkeys(KINDS, 2.0)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|InArrow|Exchange", plan)


def test_redaction(spark):
    spans = "array(struct(0 AS kind, 2 AS start, 5 AS end), struct(1 AS kind, 4 AS start, 7 AS end), struct(3 AS kind, 9 AS start, 10 AS end))"
    row = spark.sql(f"SELECT 'é😀abcdefghij' AS text, {spans} AS found").select(redact(F.col("text"), F.col("found")).alias("r")).first()
    assert row.r == "é😀[email]fg[phone]ij"


def test_thresholds():
    counts = [("card", 90, 200, 200), ("card", 50, 0, 200), ("ip", 99, 5, 5)]
    assert cutoffs(counts, 0.95) == {"email": 2.0, "ip": 2.0, "card": 0.9, "phone": 2.0}
    assert lower_bound(0, 0) == 0.0 and 0.94 < lower_bound(50, 50) < 1


def test_numbers_beside_others_are_proposals(documents):
    texts = ["order 12 4111 1111 1111 1111", "4111111111111111 4012888888881881", "2024-05-01 4111111111111111", "7" * 40 + " +1 (499) 555-6503", "9.8.192.168.0.1"]
    found = {}
    for r in pii.with_candidates(documents(list(enumerate(texts)))).collect():
        found[r.doc_id] = {(c.kind, texts[r.doc_id][c.start : c.end]) for c in r.candidates}
    assert ("card", "4111 1111 1111 1111") in found[0]
    assert {("card", "4111111111111111"), ("card", "4012888888881881")} <= found[1]
    assert ("card", "4111111111111111") in found[2]
    assert {("phone", "+1 (499) 555-6503"), ("phone", "(499) 555-6503")} <= found[3]
    assert ("ip", "192.168.0.1") in found[4]
    assert not any(sum(c.isdigit() for c in match) > 30 for few in found.values() for kind, match in few if kind == "card")


def test_a_card_beside_other_numbers_is_found(spark):
    """With trees that like cards of sixteen digits."""
    digits = pii.FEATURES.index("digits")
    card = Split(digits, 15.5, -5.0, Split(digits, 16.5, 5.0, -5.0))
    trees = pii.BoostedTrees(((1.0, Split(0, 1.5, -5.0, Split(0, 2.5, card, -5.0))),))
    texts = [(1, "order 12 4111 1111 1111 1111"), (2, "4111111111111111 4012888888881881"), (3, "2024-05-01 4111111111111111")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = find_pii(docs, pii.PiiModel(trees, dict.fromkeys(KINDS, 0.9))).select("doc_id", "base_spans", written(F.col("found")).alias("line")).collect()
    assert all(not r.base_spans for r in rows)
    assert {r.doc_id: r.line for r in rows} == {1: "card:9:28", 2: "card:0:16,card:17:33", 3: "card:11:27"}


def test_thresholds_come_from_all_documents(contacts, monkeypatch):
    """The sample holds too few cards for a threshold, the table enough."""
    seen = []
    monkeypatch.setattr(pii, "cutoffs", lambda counts, precision: seen.extend(counts) or cutoffs(counts, precision))
    repeated = contacts.union(contacts.limit(1).selectExpr("CAST(NULL AS bigint)", "text"))
    model = train_pii(repeated, sample=60)
    assert sum(n for kind, _, _, n in seen if kind == "card") > 1_000
    assert model.thresholds["card"] <= 1
