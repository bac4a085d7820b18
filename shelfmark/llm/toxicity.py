"""Toxicity by multiple-instance learning (operator 10).

A document is a bag of sentences. A sentence's score is a logistic function of
its words; the document is toxic if any sentence is, so its probability is the
noisy-or of the sentence scores. Only documents are labelled: the words' weights
are fitted to the documents' likelihood, and the sentence scores then say where
the offending sentences are.

Fitting takes at most ``sample`` labelled documents of at most ``LONGEST`` letters.
Their signs (words and how these begin) are hashed to 32 bits in tasks and counted
by label on Spark; at most ``words`` of them get a weight. Tasks then pack each
document into the numbers of its weighted signs, two bytes each, and only those
arrays come to the driver for the gradient steps. Scoring takes every document, in
full, in the tasks of the scan.

Edge cases: null and empty texts have no sentence and score 0; unless documents
of both labels can be learnt from, nothing is known and every score is 0. Rows
are scored one by one, so repeated rows repeat their score and extra columns do
not matter.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialize, take_turn
from .labelled import labelled_sample, remainder

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Bound on the labelled documents a model is fitted on.
SAMPLE = 4_000
#: Bound on the letters of a document a model is fitted on; all lengths are scored.
LONGEST = 50_000
#: Bound on the words and beginnings that have a weight; two bytes number them.
WORDS = 50_000
#: Toxic documents that a sign must stand in.
LEAST = 3
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
BEGINNINGS = (4, 5, 6)
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def plain(word: str) -> str:
    """A word in lower case without what stands around it."""
    return EDGE.sub("", word.lower())


def signs(word: str) -> list[str]:
    """What counts of a word: itself and how it begins, as insults are inflected."""
    return [word] + [word[:n] + "*" for n in BEGINNINGS if len(word) > n] if word else []


def sign_hashes(word: str) -> list[int]:
    return [zlib.crc32(sign.encode()) for sign in signs(plain(word))]


@dataclass
class ToxicityModel:
    """Log-odds of a sentence: ``base`` and the weights of its words' hashed signs."""

    weights: dict[int, float]
    base: float
    fixed: float | None = None

    def __post_init__(self) -> None:
        self._memory: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        found = self._memory.get(word)
        if found is None:
            if len(self._memory) >= 150_000:
                self._memory.clear()
            found = self._memory[word] = sum(self.weights.get(s, 0.0) for s in sign_hashes(word))
        return found

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Start, end (code points) and log-odds of the sentences in a text."""
        spans, odds = [], []
        for match in SENTENCE.finditer(text):
            words = match.group().split()
            if words:
                spans.append(match.span())
                odds.append(self.base + sum(map(self._weight, words)))
        return spans, np.array(odds)

    def judge(self, text: str) -> tuple[float, int | None, int | None, float]:
        """Document score; start, end and score of its worst sentence."""
        take_turn(f"toxicity {id(self)}", self._memory.clear)
        spans, odds = self.sentences(text)
        if not spans:
            return 0.0, None, None, 0.0
        if self.fixed is not None:
            return self.fixed, *spans[0], self.fixed
        worst = int(odds.argmax())
        none = np.logaddexp(0, odds).sum()  # minus log of the chance that no sentence is toxic
        return float(-np.expm1(-none)), *spans[worst], float(1 / (1 + np.exp(-np.clip(odds[worst], -60, 60))))


def bag(text: str) -> tuple[bytes, bytes]:
    """Distinct hashed signs of each sentence (u32), and their number (u32)."""
    found, sizes = array("I"), array("I")
    for match in SENTENCE.finditer(text):
        hashes = sorted({h for word in match.group().split() for h in sign_hashes(word)})
        if hashes:
            found.extend(hashes)
            sizes.append(len(hashes))
    return found.tobytes(), sizes.tobytes()


def sign_counts(bags: DataFrame) -> DataFrame:
    """(sign, zeros, ones): documents of either label that a sign stands in."""
    names = ["sign", "zeros", "ones"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_label = {0: [], 1: []}
            for label, found in zip(batch.column(0), batch.column(1)):
                by_label[label.as_py()].append(np.unique(np.frombuffer(found.as_py(), "<u4")))
            for label, found in by_label.items():
                if found:
                    sign, n = np.unique(np.concatenate(found), return_counts=True)
                    counts = {label: n, 1 - label: np.zeros(len(n), np.int64)}
                    columns = [pa.array(c.astype(np.int64)) for c in (sign, counts[0], counts[1])]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    counted = bags.select("label", "signs").mapInArrow(run, "sign bigint, zeros bigint, ones bigint")
    return counted.groupBy("sign").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))


def packed_bags(bags: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(label, hits, sizes): numbers in ``vocabulary``, which is in ascending order,
    of each sentence's signs (u16), and how many a sentence has (u16)."""
    shared = bags.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            hits, sizes = [], []
            for found, lengths in zip(batch.column(1), batch.column(2)):
                found, lengths = (np.frombuffer(value.as_py(), "<u4") for value in (found, lengths))
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                hit = known[at] == found
                hits.append(at[hit].astype("<u2").tobytes())
                sentence = np.repeat(np.arange(len(lengths)), lengths)
                sizes.append(np.bincount(sentence[hit], minlength=len(lengths)).astype("<u2").tobytes())
            columns = [batch.column(0), pa.array(hits, pa.binary()), pa.array(sizes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "hits", "sizes"])

    return bags.select("label", "signs", "sizes").mapInArrow(run, "label int, hits binary, sizes binary")


def fit_bags(
    vocabulary: np.ndarray, labels: np.ndarray, hits: list[bytes], sizes: list[bytes], rounds: int = 200
) -> ToxicityModel:
    """Weights by proximal gradient steps on the noisy-or likelihood.

    Small weights are drawn to zero, as almost all signs say nothing.
    """
    columns = np.frombuffer(b"".join(hits), "<u2")
    width = np.frombuffer(b"".join(sizes), "<u2")
    owner = np.repeat(np.arange(len(labels)), [len(s) // 2 for s in sizes])
    rows = np.repeat(np.arange(len(width), dtype=np.int32), width)
    labels = labels.astype(float)
    weights = np.zeros(len(vocabulary) + 1)
    weights[-1] = np.log(max(labels.sum(), 1) / len(owner))  # as if every toxic document had one toxic sentence
    squares = np.full(len(weights), 1e-8)
    momentum = np.zeros(len(weights))
    step, pull = 0.3, 0.05
    for _ in range(rounds):
        odds = weights[-1] + np.bincount(rows, weights[columns], len(owner))
        calm = np.bincount(owner, np.logaddexp(0, odds), len(labels))
        # Derivative of the log-likelihood by ``calm``: toxic documents want more.
        slope = np.where(labels == 1, 1 / np.expm1(np.clip(calm, 1e-9, 500)), -1.0)
        by_sentence = slope[owner] / (1 + np.exp(-np.clip(odds, -60, 60)))
        gradient = np.append(np.bincount(columns, by_sentence[rows], len(vocabulary)), by_sentence.sum())
        momentum = 0.9 * momentum + 0.1 * gradient
        squares = 0.99 * squares + 0.01 * gradient**2
        rate = step / (np.sqrt(squares) + 1.0)
        weights += rate * momentum
        weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - rate[:-1] * pull, 0)
    return ToxicityModel({int(s): float(w) for s, w in zip(vocabulary, weights) if w}, float(weights[-1]))


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, words: int = WORDS) -> ToxicityModel:
    """A model from labelled documents outside the held-out fold."""
    short = docs.filter(F.coalesce(F.length("text"), F.lit(0)) <= LONGEST)
    chosen = labelled_sample(short, labels, "toxic", remainder("doc_id", FOLDS) != HELD_OUT, sample)
    featured = map_texts(
        chosen, ["doc_id", "label"], "text", "signs binary, sizes binary", bag, lambda found: sum(map(len, found))
    )
    bags = materialize(featured.filter(F.octet_length("sizes") > 0), "toxicity-bags")
    seen = {row.label: row["count"] for row in bags.groupBy("label").count().collect()}
    if set(seen) != {0, 1}:
        return ToxicityModel({}, 0.0, 0.0)
    lift = (F.col("ones") + 0.5) / (seen[1] + 1) / ((F.col("zeros") + 0.5) / (seen[0] + 1))
    counted = sign_counts(bags).filter(F.col("ones") >= LEAST)
    kept = counted.orderBy(F.abs(F.log(lift)).desc(), "sign").limit(words).select("sign").toArrow()
    vocabulary = np.sort(kept.column(0).to_numpy()).astype(np.uint32)
    if not len(vocabulary):
        return ToxicityModel({}, float(np.log(1 / (1 + seen[0] / seen[1]))), 0.0)
    found = packed_bags(bags.orderBy("doc_id"), vocabulary).toArrow()
    packed = [found.column(name).to_pylist() for name in ("hits", "sizes")]
    return fit_bags(vocabulary, found.column("label").to_numpy(), *packed)


def score_toxicity(docs: DataFrame, model: ToxicityModel, *keys: str) -> DataFrame:
    """``keys``, the score of every text, and span and score of its worst sentence."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    outputs = "score double, worst_start int, worst_end int, worst_score double"
    return map_texts(docs, list(keys), "text", outputs, lambda text: shared.value.judge(text))


def judge_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_toxicity(docs, train_toxicity(docs, labels), "doc_id").select(
        "doc_id",
        (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "worst_start",
        "worst_end",
        "worst_score",
    )
