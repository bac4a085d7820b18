"""Quality rules with risk-controlled thresholds (operator 4).

Four statistics of a text (share of symbols, of repeated words, of words in
capitals, of duplicate lines) are held against cutoffs; a text above any cutoff
is rejected. Cutoffs are set for each stratum (language) from labelled
documents in two halves:

* one half proposes ``LEVELS``: at each level the cutoffs are the same quantile
  of the statistics of its clean documents, from their maximum downwards;
* the other half tests every level: the exact (Clopper-Pearson) upper bound on
  the share of clean documents rejected must be at most ``RISK``. The chance of
  a wrong bound, ``ERROR``, is divided by the number of bounds, strata times
  levels (Bonferroni), so that all selected cutoffs hold together.

Of the certified levels the one that catches nearly the most labelled bad
documents with the mildest cutoffs is taken. A stratum with too few labelled
documents certifies nothing, and then only the base rule applies there.

Statistics are computed in the tasks of the scan and written once; labelled
documents are only counted, on the cluster, and the driver sees one row for each
stratum that has labels.

Edge cases: null and empty texts have no words and fail the base rule; a null
language is a stratum of its own; conflicting labels of a document count as
clean; labels without a document count for nothing. Repeated rows are judged
alike; extra columns do not matter.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RISK, ERROR = 0.02, 0.05
#: Shares of clean documents that a level's cutoffs leave above them.
LEVELS = [0.0, 0.0005, 0.001, 0.002, 0.003, 0.005, 0.0075, 0.01]
#: A level counts as catching nearly the most from this share on.
NEARLY = 0.99
RATIOS = ["symbol_share", "repeat_share", "capital_share", "line_share"]
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_capitals bigint, n_lines bigint"


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that are found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pair = ids[:-1] * len(numbers) + ids[1:]
    if len(numbers) > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    hit = times[window] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= hit
    return int(covered.sum())


def statistics(text: str) -> tuple:
    """Values in the order of ``COUNTS``."""
    words = text.encode().split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            repeats += line in seen
            seen.add(line)
    capitals = sum(map(bytes.isupper, words))
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), repeats, repeated_words(words), capitals, lines


def with_ratios(rows: DataFrame) -> DataFrame:
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    return rows.withColumns({
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "capital_share": share("n_capitals", "n_words"),
        "line_share": share("n_dup_lines", "n_lines"),
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    })


def upper_bound(hits: int, total: int, error: float) -> float:
    """Exact upper bound on a share: the largest one under which ``hits`` or fewer
    of ``total`` still have a chance of ``error``."""
    if hits >= total:
        return 1.0

    def at_most(p: float) -> float:
        logs = [
            math.lgamma(total + 1) - math.lgamma(k + 1) - math.lgamma(total - k + 1) + k * math.log(p) + (total - k) * math.log1p(-p)
            for k in range(hits + 1)
        ]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)

    low, high = hits / total, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if 0 < middle < 1 and at_most(middle) > error else (low, middle)
    return high


def rejected(cutoffs: list[float]) -> Column:
    return F.greatest(*[(F.col(name) > F.lit(cut)).cast("int") for name, cut in zip(RATIOS, cutoffs)]) == 1


def pick(levels: list[tuple[int, int]], clean: int, error: float, risk: float) -> int | None:
    """Level to use, from (clean rejected, bad rejected) counts of each."""
    good = [k for k, (wrong, _) in enumerate(levels) if clean and upper_bound(wrong, clean, error) <= risk]
    if not good:
        return None
    most = max(levels[k][1] for k in good)
    return min(k for k in good if levels[k][1] >= NEARLY * most)


def select_cutoffs(rows: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[str, list[float]]:
    """Certified cutoffs by stratum, in the order of ``RATIOS``.

    ``rows`` has doc_id, stratum and the ratios. Documents that the base rule
    fails take no part: what is controlled is what the cutoffs add.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("clean"))
    # Trials of a binomial bound are independent: a doc_id counts once, however many
    # rows it stands in, with the smallest of their figures.
    one = F.min(F.struct("stratum", "clean", *RATIOS)).alias("one")
    held = rows.filter(~F.col("base_failed")).join(known, "doc_id").groupBy("doc_id").agg(one).select("doc_id", "one.*")
    held = materialize(held.select("stratum", "clean", F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half"), *RATIOS), "labelled-ratios")
    wanted = [1 - level for level in LEVELS]
    proposed = (
        held.filter("half = 0 and clean = 1")
        .groupBy("stratum")
        .agg(*[F.percentile_approx(name, wanted, 100_000).alias(name) for name in RATIOS])
        .collect()
    )
    out: dict[str, list[float]] = {}
    if not proposed:
        return out
    grid = {r.stratum: [[getattr(r, name)[k] for name in RATIOS] for k in range(len(LEVELS))] for r in proposed}
    table = held.sparkSession.createDataFrame([(s, levels) for s, levels in grid.items()], "stratum string, levels array<array<double>>")
    tested = held.filter("half = 1").join(F.broadcast(table), "stratum")  # a row for each labelled stratum
    sums = [F.sum("clean").alias("clean")]
    for k in range(len(LEVELS)):
        above = [F.col(name) > F.get(F.get("levels", F.lit(k)), F.lit(i)) for i, name in enumerate(RATIOS)]
        hit = above[0] | above[1] | above[2] | above[3]
        sums += [F.sum((hit & (F.col("clean") == 1)).cast("int")).alias(f"wrong{k}"), F.sum((hit & (F.col("clean") == 0)).cast("int")).alias(f"right{k}")]
    share = error / (len(grid) * len(LEVELS))
    for r in tested.groupBy("stratum").agg(*sums).collect():
        level = pick([(r[f"wrong{k}"], r[f"right{k}"]) for k in range(len(LEVELS))], r.clean, share, risk)
        if level is not None:
            out[r.stratum] = grid[r.stratum][level]
    return out


def verdicts(rows: DataFrame, cutoffs: dict[str, list[float]]) -> DataFrame:
    """Rows with ``kept``: neither the base rule nor a cutoff of the stratum fails."""
    fails = F.col("base_failed")
    for stratum, cuts in cutoffs.items():
        fails = fails | ((F.col("stratum") == stratum) & rejected(cuts))
    return rows.withColumn("kept", ~fails)


def measured(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys``, stratum, counts, ratios and the base rule of each row."""
    rows = docs.select(*dict.fromkeys([*keys, "text"]), F.coalesce(F.col("lang"), F.lit("")).alias("stratum"))
    return with_ratios(map_texts(rows, [*keys, "stratum"], "text", COUNTS, statistics))


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = materialize(measured(docs, "doc_id"), "rule-statistics")
    return verdicts(rows, select_cutoffs(rows, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
