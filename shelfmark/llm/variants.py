"""Spelling variants by PartEnum signatures (operator 11).

Words are counted over all texts, and two words are near if one inserted, deleted
or replaced letter makes one of the other. A word is seen as a binary vector: its
letters with the number of their occurrence ("a1", "a2"). A replaced letter
changes two places of it at most, an inserted one a single place. PartEnum deals
the places into parts and takes every choice of parts that at least one pair of
near words must share in full: of ``REPLACED`` parts any all but two, of
``INSERTED`` parts any all but one. Words that share such a signature are joined
and then verified by their edit distance.

Letters say nothing of their order, so a signature also names the half of the
word that the edit leaves alone: either the first letters or the last ones are
the same. It also names the lengths that are compared, n with n or n with n + 1.
A signature that more than ``CROWD`` words share is split further: there, words
are joined by what is left without the letter at one place of the edited half.
Words joined so are near, so no group of look-alikes is ever paired out.

Runs are counted in the tasks of the scan, so a frequent word reaches the shuffle
once for ``HELD`` distinct ones. Pairs, forms and roots are joins over the words.

Edge cases: null texts hold no run, a null doc_id counts as empty text in the
checksum; every row counts, repeated ones too; texts of any length are read run by
run; empty tables have no word; extra columns do not matter. Of near words with
equal counts the first in code-point order is the form. As a form has twice its
word's count, following forms ends.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: One run of so many, by its checksum, loses a letter.
DROPS_ONE_IN = 97
LETTERS, TIMES, LEAD = 5, 3, 2
#: Parts of the vector for words of equal and of neighbouring lengths.
REPLACED, INSERTED = 3, 2
CROWD = 128
#: Distinct words that a task counts before it hands counts on.
HELD = 200_000
#: A text longer than this is read run by run.
LONG = 1 << 20


def run_counts(doc_id: object, text: str) -> Counter:
    """Counts of a text's runs, some of which have lost a letter."""
    found = Counter(RUN.findall(text) if len(text) < LONG else (m.group() for m in RUN.finditer(text)))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in found.items():
        word = run.lower() if run.isascii() else run.translate(LOWER)
        h = zlib.crc32(word.encode(), start)
        if h % DROPS_ONE_IN == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out[word] += n
    return out


def word_counts(docs: DataFrame, letters: int = LETTERS, times: int = TIMES) -> DataFrame:
    """(word, n) of the words of at least ``letters`` letters and ``times`` runs."""
    names = {"word": pa.string(), "n": pa.int64()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def handed() -> pa.RecordBatch:
            columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=list(names))

        for batch in batches:
            for doc_id, text in zip(batch.column(0), texts_of(batch.column(1))):
                for word, n in run_counts(doc_id.as_py(), text).items():
                    if len(word) >= letters:
                        held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield handed()
        if held:
            yield handed()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def part_hashes(word: str, parts: int) -> list[int]:
    """A hash of the places of the vector in each part; 64 bits, signed."""
    sums, seen = [0] * parts, {}
    for letter in word:
        nth = seen[letter] = seen.get(letter, 0) + 1
        place = zlib.crc32(f"{letter}{nth}".encode())
        # Any mix of the place will do; parts add theirs up, whatever the order.
        sums[place % parts] += (place + 1) * (place ^ 0x9E3779B97F4A7C15)
    return [(s + 2**63) % 2**64 - 2**63 for s in sums]


def with_parts(words: DataFrame) -> DataFrame:
    """(word, n, replaced, inserted): the hashes of a word's parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in batches:
            found = batch.column(0).to_pylist()
            columns = [pa.array([part_hashes(w, p) for w in found], kind) for p in (REPLACED, INSERTED)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["word", "n", "replaced", "inserted"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, replaced array<bigint>, inserted array<bigint>")


def signatures(words: DataFrame) -> DataFrame:
    """(key, side, last, word, n): side 0 for words compared with those of their
    length, 1 and 2 for the shorter and the longer of neighbouring lengths. Words
    that share a key have the last letters in common, or the first ones."""
    word, length = F.col("word"), F.length("word")

    def enumerated(side: int, short: Column, hashes: str, parts: int, left_out: int) -> list[Column]:
        half = F.floor(short / 2).cast("int")
        out = []
        for which, keep in enumerate(combinations(range(parts), parts - left_out)):
            for last in (False, True):
                shared = F.substring(word, length - (short - half) + 1, short - half) if last else F.substring(word, F.lit(1), half)
                kind = F.lit(4 * which + 2 * (side > 0) + last)
                key = F.xxhash64(kind, short, shared, *[F.col(hashes)[p] for p in keep])
                out.append(F.struct(key.alias("key"), F.lit(side).cast("tinyint").alias("side"), F.lit(last).alias("last")))
        return out

    every = [
        *enumerated(0, length, "replaced", REPLACED, 2),
        *enumerated(1, length, "inserted", INSERTED, 1),
        *enumerated(2, length - 1, "inserted", INSERTED, 1),
    ]
    return with_parts(words).select(F.inline(F.array(*every)), "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n): each near pair once for each of its words."""
    signed = materialize(signatures(words), "signatures")
    same, short, long = (F.count_if(F.col("side") == side) for side in range(3))
    # Keys under which two words meet at all.
    met = signed.groupBy("key").agg(same.alias("same"), short.alias("short"), long.alias("long"))
    met = met.filter("same > 1 or short > 0 and long > 0")
    crowded = (F.col("same") > CROWD) | (F.greatest("short", "long") > CROWD)
    rows = materialize(
        signed.join(met.select("key", crowded.alias("crowded")), "key").select(signed.columns + ["crowded"]), "met-signatures"
    )
    # In a crowd: what is left of the word without the letter at one place of the
    # half that differs; of the shorter of two lengths nothing is left out.
    length = F.length("word")
    half = F.floor((length - F.when(F.col("side") == 2, 1).otherwise(0)) / 2).cast("int")
    places = F.when(F.col("last"), F.sequence(F.lit(0), half)).otherwise(F.sequence(half, length - 1))
    places = F.when(F.col("side") == 1, F.array(F.lit(-1))).otherwise(places)
    apart = rows.filter("crowded").withColumn("place", F.explode(places))
    place = F.col("place")
    left = F.when(place < 0, F.col("word")).otherwise(
        F.concat(F.substring("word", F.lit(1), place), F.substring(F.col("word"), place + 2, F.length("word")))
    )
    finer = F.when(F.col("side") == 0, F.xxhash64("key", "place", left)).otherwise(F.xxhash64("key", left))
    split = apart.select(finer.alias("key"), "side", "word", "n").distinct()
    joined = rows.filter("not crowded").select("key", "side", "word", "n").union(split)

    one, two = joined.alias("one"), joined.alias("two")
    meets = (F.col("one.side") == 0) & (F.col("two.side") == 0) & (F.col("one.word") < F.col("two.word"))
    meets = meets | ((F.col("one.side") == 1) & (F.col("two.side") == 2))
    near = F.levenshtein(F.col("one.word"), F.col("two.word"), 1) == 1
    pairs = one.join(two, (F.col("one.key") == F.col("two.key")) & meets & near)
    ordered = pairs.select(F.col("one.word").alias("a"), F.col("one.n").alias("a_n"), F.col("two.word").alias("b"), F.col("two.n").alias("b_n"))
    return ordered.distinct().select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")),
            )
        )
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form (word, form): the last form.

    Each round follows one form of the words that are not yet at a root; counts
    double at every step, so there are few rounds.
    """
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    going, done = forms.select("word", F.col("form").alias("root")), None
    while True:
        followed = materialize(going.join(step, "root", "left"), "roots")
        ended = followed.filter("next is null").select("word", "root")
        done = ended if done is None else done.union(ended)
        going = followed.filter("next is not null").select("word", F.col("next").alias("root"))
        if going.isEmpty():
            return done


def variant_groups(docs: DataFrame, lead: int = LEAD) -> DataFrame:
    """Every word with its count, near words, form and root."""
    words = materialize(word_counts(docs), "words")
    nearest = near_pairs(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    )
    leads = -F.col("best.less") >= lead * F.col("n")
    judged = materialize(
        words.join(nearest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(leads, F.col("best.other")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(judged.filter("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
