from __future__ import annotations

import random
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from shelfmark.llm.bpe import Vocabulary
from shelfmark.llm.common import table
from shelfmark.llm.packing import CAPACITY, intervals, nonnegative_least_squares, pack_documents, patterns, plan
from shelfmark.llm.queries import tokenizer_path


def check_layout(rows, documents, library):
    wanted = []
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k, begin in enumerate(range(0, len(ids), CAPACITY)):
            part = array("I", ids[begin : begin + CAPACITY])
            wanted.append((doc_id, k, begin, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(wanted, key=str)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= CAPACITY
    total = sum(w[3] for w in wanted)
    return len(sequences), -(-total // CAPACITY)


def test_sample_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    library = Tokenizer.from_file(tokenizer_path())
    used, bound = check_layout(pack_documents(docs, tokenizer_path()).collect(), [(r.doc_id, r.text) for r in docs.collect()], library)
    assert used <= bound * 1.04 + 2


def test_edges(documents):
    library = Tokenizer.from_file(tokenizer_path())
    rows = [(1, None), (2, ""), (2, ""), (None, "word"), (3, "a " * 4095), (4, "a " * 4096), (5, "a " * 9000), (6, "one two")]
    docs = documents(rows, "1 AS dealt").selectExpr("*", "2 AS rank", "3 AS length")
    used, bound = check_layout(pack_documents(docs, tokenizer_path()).collect(), rows, library)
    assert used <= bound + 1
    assert pack_documents(documents([]), tokenizer_path()).count() == 0


def test_plans_use_up_any_histogram():
    rng = random.Random(3)
    for trial in range(12):
        lengths = [min(CAPACITY, int(rng.lognormvariate(6.5, 1.0)) + 1) for _ in range(rng.choice([3, 400, 5000]))]
        lengths += [rng.choice([1, 7, CAPACITY, CAPACITY - 1, 2048])] * rng.choice([0, 900])
        histogram = {}
        for length in lengths:
            histogram[length] = histogram.get(length, 0) + 1
        steps = plan(histogram)
        used = {}
        for repeats, one in steps:
            assert sum(one) <= CAPACITY
            for length in one:
                used[length] = used.get(length, 0) + repeats
        assert used == histogram
        spans = sorted(intervals(steps))
        assert sum(end - first for _, first, end, _, _ in spans) == len(lengths)
        if len(lengths) > 1000:
            assert sum(r for r, _ in steps) <= 1.03 * max(sum(lengths) / CAPACITY, sum(x > CAPACITY // 2 for x in lengths)) + 2


def test_plans_grow_with_lengths_not_with_pieces():
    rng = random.Random(4)
    histogram = {length: rng.randrange(1, 10**9) for length in range(1, CAPACITY + 1)}
    assert len(plan(histogram)) < 3 * CAPACITY


def test_least_squares_stays_nonnegative_and_optimal():
    a = patterns()
    b = np.random.default_rng(1).integers(0, 1000, len(a)).astype(float)
    x = nonnegative_least_squares(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all()
    assert gradient.max() < 1e-5 and np.abs(gradient[x > 0]).max() < 1e-5


def test_a_column_of_texts_with_new_words_is_encoded_as_a_whole():
    draw = random.Random(9)
    words = ["".join(draw.choices("aeinorstéü", k=draw.randint(5, 11))) + draw.choice(["", ".", "'s"]) for _ in range(20_000)]
    column = pa.array([" ".join(words[k : k + 50]) for k in range(0, len(words), 50)])
    with open(tokenizer_path(), "rb") as file:
        content = file.read()
    taught, learner, calls = Vocabulary(content), Vocabulary(content), 0
    wanted = list(taught.encoded(column))
    learner.pairs = taught.pairs  # asked for once, whatever the number of words

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        found = list(learner.encoded(column))
    finally:
        sys.setprofile(None)
    assert found == wanted and calls < 2 * len(words)
