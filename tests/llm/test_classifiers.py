from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from shelfmark.llm import quality, toxicity
from shelfmark.llm.common import table
from shelfmark.llm.labelled import labelled_sample
from shelfmark.llm.quality import dual_descent, judge_quality
from shelfmark.llm.toxicity import bag, judge_toxicity, packed_bags, score_toxicity, sign_counts

JUDGES = [(judge_quality, "quality", 5, 0), (judge_toxicity, "toxic", 4, 2)]


def corpus(spark, n=800):
    """Texts of made-up words; bad ones shout, toxic ones insult in one sentence."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeiourstn") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
        bad, toxic = i % 4 == 0, i % 3 == 0
        if toxic:
            words[rng.randrange(60)] = rng.choice(["vilekor", "vilekan", "grumpf"]) + rng.choice(["", "o", "us"])
        if bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, ". ".join(" ".join(words[k : k + 10]) for k in range(0, 60, 10)) + "."))
        labels.append((i, int(not bad), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' AS lang", "1 AS score", "2 AS label")
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("judge, label, folds, held", JUDGES)
def test_held_out_documents_are_told_apart(spark, judge, label, folds, held):
    docs, labels = corpus(spark)
    rows = judge(docs, labels).join(labels, "doc_id").collect()
    assert len(rows) == 800
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    aside = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r[label] for r in aside]) > 0.95


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = corpus(spark, 200)
    for judge, label, folds, held in JUDGES:
        other = labels.selectExpr("doc_id", *[f"if(crc32(cast(doc_id as string)) % {folds} = {held}, 1 - {c}, {c}) AS {c}" for c in ("quality", "toxic")])
        one = {r.doc_id: r.score for r in judge(docs, labels).collect()}
        assert one == {r.doc_id: r.score for r in judge(docs.repartition(7), other).collect()}


@pytest.mark.parametrize("judge, label, folds, held", JUDGES)
def test_edges(spark, documents, judge, label, folds, held):
    _, labels = corpus(spark, 50)
    rows = [(1, None), (2, ""), (3, " \n"), (None, "text"), (4, "same"), (4, "same"), (5, "w" * 200_000), (6, "a b. " * 60_000)]
    scored = judge(documents(rows, "1 AS held_out"), labels).collect()
    assert len(scored) == len(rows)
    assert all(r.score is not None and 0 <= r.score <= 1 and r.held_out is not None for r in scored)
    assert judge(documents([]), labels).count() == 0
    assert judge(documents(rows), labels.filter("doc_id < 0")).count() == len(rows)
    assert judge(documents(rows), labels.selectExpr("doc_id", "1 AS quality", "1 AS toxic")).count() == len(rows)


def test_the_sample_is_bounded_and_the_same_however_rows_are_dealt(spark, documents):
    docs, labels = corpus(spark, 300)
    from pyspark.sql import functions as F

    pick = lambda d: sorted(tuple(r) for r in labelled_sample(d, labels, "toxic", F.lit(True), 50).collect())
    assert len(pick(docs)) == 50
    assert pick(docs) == pick(docs.union(docs).repartition(9))


def test_worst_sentences_are_located(spark):
    docs, labels = corpus(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    hits = [r for r in judge_toxicity(docs, labels).collect() if r.predicted and r.doc_id % 3 == 0]
    named = [("vileko" in (s := texts[r.doc_id][r.worst_start : r.worst_end].lower()) or "vileka" in s or "grumpf" in s) for r in hits]
    assert np.mean(named) > 0.95


def test_noisy_or_of_sentences():
    model = toxicity.ToxicityModel({zlib.crc32(b"bad"): 3.0, zlib.crc32(b"worse*"): 1.0}, -2.0)
    score, start, end, worst = model.judge("Fine here. Bad worse1 there!")
    one, other = 1 / (1 + np.exp(2.0)), 1 / (1 + np.exp(2.0 - 3.0 - 0.0))
    assert score == pytest.approx(1 - (1 - one) * (1 - other)) or score > other
    assert (start, end) == (10, 28) and worst > one


def test_dual_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(0)
    rows = [np.arange(3)] * 40
    values = [rng.normal(size=3) + 1.5 * s for s in ([1, -1] * 20)]
    signs, cost = np.array([1.0, -1.0] * 20), np.ones(40)
    w = dual_descent(rows, values, signs, cost, 3, 400)
    loss = lambda v: 0.5 * v @ v + sum(max(0, 1 - s * (v @ x)) for s, x in zip(signs, values))
    best = loss(w)
    for _ in range(300):
        assert loss(w + rng.normal(size=3) * 0.02) >= best - 1e-3


def test_constant_models():
    assert toxicity.ToxicityModel({}, 0.0, 0.0).judge("a b")[0] == 0.0
    assert quality.fit_rows([], np.array([], int), 8).score("a") == 0.5


def test_sample_table(spark, sf_dir):
    for judge, *_ in JUDGES:
        docs = table(spark, sf_dir, "documents")
        assert judge(docs, table(spark, sf_dir, "labels")).count() == docs.count()


def toxic_by_hand(weights, base, text):
    """Noisy-or of sentences, letter by letter."""
    sentences, now = [], ""
    for k, c in enumerate(text):
        now += c
        ends = c in ".!?" and (k + 1 == len(text) or text[k + 1] not in ".!?") or c == "\n"
        if ends or k + 1 == len(text):
            sentences.append(now)
            now = ""
    calm, any_words = 1.0, False
    for sentence in sentences:
        if not sentence.strip(".!?\n"):
            continue
        odds = base
        for word in sentence.split():
            any_words = True
            word = word.lower()
            while word and not word[0].isalnum():
                word = word[1:]
            while word and not word[-1].isalnum():
                word = word[:-1]
            for sign in [word] + [word[:n] + "*" for n in (4, 5, 6) if len(word) > n] if word else []:
                odds += weights.get(zlib.crc32(sign.encode()), 0.0)
        if sentence.split():
            calm *= 1 - 1 / (1 + np.exp(-odds))
    return 1 - calm if any_words else 0.0


def test_toxicity_scores_equal_brute_force(spark, documents):
    draw = random.Random(8)
    words = ["bad", "Worse", "grumpfel", "vilekano", "ok", "(bad)", "é", "it's", "--", "fine", "grump"]
    signs = ["bad", "worse", "grum*", "grump*", "vilek*", "vileka*", "é", "it's", "fine"]
    weights = {zlib.crc32(s.encode()): draw.uniform(-2, 3) for s in signs}
    texts = ["".join(draw.choice(words) + draw.choice([" ", ". ", "! ", "\n", "  "]) for _ in range(draw.randint(0, 30))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate([*texts, "", None, "bad"])]
    scored = score_toxicity(documents(rows), toxicity.ToxicityModel(weights, -3.0), "doc_id").collect()
    assert {r.doc_id: pytest.approx(r.score, abs=1e-9) for r in scored} == {k: toxic_by_hand(weights, -3.0, t or "") for k, t in rows}


def test_signs_are_counted_by_document_and_packed_by_sentence(spark):
    texts = [(1, "bad bad. Bad fine!"), (1, "grumpfel"), (0, "fine. fine bad")]
    rows = [(label, *map(bytearray, bag(text))) for label, text in texts]
    bags = spark.createDataFrame(rows, "label int, signs binary, sizes binary").repartition(2)
    crc = {s: zlib.crc32(s.encode()) for s in ("bad", "fine", "grumpfel", "grum*", "grump*", "grumpf*")}
    counted = {r.sign: (r.zeros, r.ones) for r in sign_counts(bags).collect()}
    assert counted == {crc[s]: (0, 1) for s in crc if s[0] == "g"} | {crc["bad"]: (1, 1), crc["fine"]: (1, 1)}
    vocabulary = np.sort(np.array([crc["bad"], crc["fine"]], np.uint32))
    packed = sorted(
        (r.label, tuple(np.frombuffer(r.sizes, "<u2")), tuple(vocabulary[np.frombuffer(r.hits, "<u2")])) for r in packed_bags(bags, vocabulary).collect()
    )
    both = tuple(vocabulary)
    assert packed == sorted([(1, (1, 2), (crc["bad"], *both)), (1, (0,), ()), (0, (1, 2), (crc["fine"], *both))])


def quality_by_hand(model, text):
    """Margin over a set of n-grams, one by one, with plain integers."""

    def mixed(*parts):
        out = len(parts)
        for part in parts:
            out = (out ^ part) * 0x9E3779B97F4A7C15 % 2**64
            out ^= out >> 29
        return out % 2**32

    words = text.split()
    crc = [zlib.crc32(w.lower().encode()) for w in words]
    forms = [zlib.crc32(b"s" + quality.shape(w).encode()) for w in words]
    found = set(crc) | {f ^ 1 for f in forms}
    for k in range(len(words) - 1):
        found |= {mixed(crc[k], crc[k + 1]), mixed(forms[k], forms[k + 1], int(crc[k] == crc[k + 1]))}
    found |= {mixed(*forms[k : k + 3], 7) for k in range(len(words) - 2)}
    numbers = {n % (2**model.bits - 1) + 1 for n in found} if words else {0}
    length = sum(model.ratios[n] ** 2 for n in numbers) ** 0.5 + 1e-9
    margin = sum(model.weights[n] * model.ratios[n] for n in numbers) / length + model.bias
    return 1 / (1 + np.exp(-(model.slope * margin + model.shift)))


def test_quality_scores_equal_brute_force(spark, documents):
    draw = random.Random(5)
    noise = np.random.default_rng(5)
    model = quality.QualityModel(noise.normal(size=1 << 9), noise.normal(size=1 << 9), 0.2, 1.3, -0.4, 9)
    words = ["The", "the", "AND!!", "a1", "é", "x" * 30, "...", "two"]
    rows = [(k, " ".join(draw.choices(words, k=k % 40))) for k in range(60)] + [(60, None), (61, "the " * 45_000)]
    scored = quality.score_quality(documents(rows), model, "doc_id").collect()
    assert {r.doc_id: pytest.approx(r.score, abs=1e-9) for r in scored} == {k: quality_by_hand(model, t or "") for k, t in rows}
