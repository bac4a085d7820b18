"""Quality classifier: naive Bayes support vectors (operator 3).

A text becomes indicators of hashed n-grams: words and pairs of words, and one
to three successive word shapes (``THAT!!`` is ``X+!+``). An indicator counts
with the log ratio of its frequencies in both classes, and a linear hinge-loss
model over these ratios is fitted by dual coordinate descent. Platt's sigmoid
turns margins into scores.

Fitting takes at most ``sample`` labelled documents (features from executors,
then coordinate descent over them in the driver); scoring takes every document
in the tasks of the scan, with a model of twice ``2**bits`` floats.

Edge cases: null and empty texts have the one indicator "empty" and a score
like all others; if only one class is labelled the score is that class for
every text, and 0.5 without labels. Rows are scored one by one, so repeated
rows repeat their score and extra columns do not matter.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .labelled import labelled_sample, remainder

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Bound on the labelled documents a model is fitted on.
SAMPLE = 4_000
BITS = 19


def shape(word: str) -> str:
    kinds = ("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word)
    return "".join(k + "+" * (len(list(run)) > 1) for k, run in groupby(kinds))


class Words(dict):
    """Word to one number: its hash, then its shape's hash. Bounded."""

    def __missing__(self, word: str) -> int:
        data = word.lower().encode()
        value = (zlib.crc32(data) << 32) | zlib.crc32(b"s" + shape(word).encode())
        if len(self) >= 400_000:
            self.clear()
        self[word] = value
        return value


_words = Words()


def mix(*parts: np.ndarray) -> np.ndarray:
    """One 32-bit hash of several in a row."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = (out ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out & np.uint64(0xFFFFFFFF)


def indicators(text: str, bits: int) -> np.ndarray:
    """Distinct numbers of the n-grams in a text, ascending."""
    words = text.split()
    if not words:
        return np.zeros(1, np.int32)
    both = np.array(list(map(_words.__getitem__, words)), np.uint64)
    word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    found = [word, form ^ np.uint64(1)]
    if len(words) > 1:
        same = word[1:] == word[:-1]
        found += [mix(word[:-1], word[1:]), mix(form[:-1], form[1:], same.astype(np.uint64))]
    if len(words) > 2:
        found.append(mix(form[:-2], form[1:-1], form[2:], np.full(len(words) - 2, 7, np.uint64)))
    size = np.uint64((1 << bits) - 1)
    seen = np.zeros(1 << bits, bool) if len(words) > 40_000 else None
    numbers = np.concatenate(found) % size + np.uint64(1)
    if seen is None:
        return np.unique(numbers.astype(np.int32))
    seen[numbers] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class QualityModel:
    """Weights by indicator, and the sigmoid from margin to score."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float
    bits: int

    def score(self, text: str) -> float:
        row = indicators(text, self.bits)
        ratios = self.ratios[row].astype(np.float64)
        margin = float(self.weights[row] @ ratios) / (np.linalg.norm(ratios) + 1e-9) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60))))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, size: int, smooth: float = 1.0) -> np.ndarray:
    counts = [np.full(size, smooth), np.full(size, smooth)]
    for row, label in zip(rows, labels):
        counts[label][row] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, cost: np.ndarray, size: int, rounds: int) -> np.ndarray:
    """Weights of a linear hinge-loss model; each step solves for one document's
    multiplier, held between 0 and its cost."""
    weights, alpha = np.zeros(size), np.zeros(len(rows))
    norms = np.array([v @ v for v in values]) + 1e-12
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = signs[i] * (weights[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                weights[rows[i]] += signs[i] * step * values[i]
                alpha[i] = new
                moved = max(moved, abs(step) * norms[i])
        if moved < 1e-3:
            break
    return weights


def platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a sigmoid by Newton steps on smoothed targets."""
    ones, zeros = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, [(g * margins).sum() + 1e-3 * (a - 1), g.sum()])
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, bits: int, rounds: int = 12) -> QualityModel:
    """Ratios and weights from nine tenths of the rows, the sigmoid from the rest."""
    size = 1 << bits
    if len(set(labels.tolist())) < 2:
        fixed = 0.0 if len(labels) == 0 else (20.0 if labels[0] else -20.0)
        return QualityModel(np.zeros(size), np.zeros(size), 0.0, 1.0, fixed, bits)
    aside = np.arange(len(rows)) % 10 == 9
    fit = [i for i in range(len(rows)) if not aside[i]]
    if len(set(labels[fit].tolist())) < 2 or len(set(labels[aside].tolist())) < 2:
        fit, aside = list(range(len(rows))), np.ones(len(rows), bool)
    ratios = log_ratios([rows[i] for i in fit], labels[fit], size)
    # Rows have unit length after scaling, or long texts would rule the fit.
    values = []
    for row in rows:
        value = ratios[row]
        values.append(np.append(value / (np.linalg.norm(value) + 1e-9), 0.3))
    with_bias = [np.append(row, size) for row in rows]
    share = labels[fit].mean()
    cost = np.where(labels == 1, 1.0 / max(share, 0.02), 1.0 / max(1 - share, 0.02)) * 2
    weights = dual_descent(
        [with_bias[i] for i in fit], [values[i] for i in fit], np.where(labels[fit] == 1, 1.0, -1.0), cost[fit], size + 1, rounds
    )
    margins = np.array([weights[with_bias[i]] @ values[i] for i in np.flatnonzero(aside)])
    slope, shift = platt(margins, labels[aside])
    return QualityModel(weights[:-1], ratios, 0.3 * float(weights[-1]), slope, shift, bits)


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> QualityModel:
    """A model from labelled documents outside the held-out fold."""
    chosen = labelled_sample(docs, labels, "quality", remainder("doc_id", FOLDS) != HELD_OUT, sample)
    featured = map_texts(
        chosen, ["doc_id", "label"], "text", "row binary",
        lambda text: (indicators(text, bits).tobytes(),), lambda found: len(found[0]),
    )
    rows = featured.orderBy("doc_id").collect()
    return fit_rows([np.frombuffer(r.row, np.int32) for r in rows], np.array([r.label for r in rows], int), bits)


def score_quality(docs: DataFrame, model: QualityModel, *keys: str) -> DataFrame:
    """``keys`` and the score of every text: 0 to 1, higher for likelier label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, list(keys), "text", "score double", lambda text: (shared.value.score(text),))


def judge_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, train_quality(docs, labels), "doc_id")
    return scored.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
