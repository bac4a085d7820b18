from __future__ import annotations

import hashlib
import random
import sys
import unicodedata
from array import array

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfmark.llm.bpe import Memory, Pairs, TokenTexts, Vocabulary, token_digests
from shelfmark.llm.common import table
from shelfmark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizer_path(), "rb") as file:
        return Vocabulary(file.read())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    data = array("I", ids).tobytes()
    return len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


EDGES = [
    "", " ", "a", "it's we'll THEY'D", "x" * 5000, "ab" * 3000, "aaaa bbbb " * 50, "1234567890", "\x1c a\x1db \x85c\u2003d",
    "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|EndOfText|>", "ΣΑΣ ΟΔΟΣ", "e\u0301 \u0301a", "漢字かな交じり文 한국어",
    "😀😀 👩‍👩‍👧", "İstanbul", "\u1c89 \ua7cb", "foo_bar--baz!!!", "\n\t\r\x0b", "ß ẞ ﬁ", "</w> a</w>", "Ġ</w>",
]


@pytest.mark.parametrize("text", EDGES)
def test_edges_encode_like_the_library(library, vocabulary, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert list(array("I", vocabulary.encode(text))) == ids
    assert TokenTexts(vocabulary.content).decode(vocabulary.encode(text)).decode() == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinorsth '<|>.,!09\n"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_encodes_like_the_library(text):
    library, vocabulary = LIBRARY
    assert list(array("I", vocabulary.encode(text))) == library.encode(text, add_special_tokens=False).ids


with open(tokenizer_path(), "rb") as _file:
    LIBRARY = (Tokenizer.from_file(tokenizer_path()), Vocabulary(_file.read()))


def test_pairs_agree_with_merging_from_scratch(library, vocabulary):
    words = sorted(w[:-4] for w in library.get_vocab() if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha())
    for first, second in zip(words[::97], words[::89]):
        word = first + second
        assert list(array("I", vocabulary.encode(word))) == library.encode(word, add_special_tokens=False).ids


def test_sample_table(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    found = {r.doc_id: r for r in token_digests(docs, tokenizer_path()).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for row in rows:
        got = found[row.doc_id]
        assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == expected(library, row.text)


def test_frames_with_nulls_repeats_and_clashing_names(documents, library):
    docs = documents([(1, None), (1, "Same text"), (1, "Same text"), (None, "x")], "1 AS ids").selectExpr("*", "2 AS decoded")
    found = sorted(tuple(r) for r in token_digests(docs, tokenizer_path()).fillna(-1, "doc_id").collect())
    wanted = sorted([(1, *expected(library, "")), (1, *expected(library, "Same text")), (1, *expected(library, "Same text")), (-1, *expected(library, "x"))])
    assert found == wanted
    assert token_digests(documents([]), tokenizer_path()).count() == 0


def test_normal_form_is_checked_against_unicode():
    assert unicodedata.normalize("NFC", "e\u0301") == "é"


def test_words_learnt_side_by_side_encode_like_the_library(library):
    draw = random.Random(4)
    letters = "abcdeénorst'’ß1,.A"
    texts = [" ".join("".join(draw.choices(letters, k=draw.randint(1, 12))) for _ in range(300)) for _ in range(6)]
    texts += EDGES + ["x" * 200 + " " + "ab" * 31 + " " + "a" * 64 + " " + "b" * 65]
    learner = Vocabulary(LIBRARY[1].content)
    learner.pairs = Pairs(learner.fits, 64)  # forgets all pairs now and then
    for text, ids in zip(texts, learner.encoded(pa.array(texts)), strict=True):
        assert list(array("I", ids)) == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdeinorst.", min_size=1, max_size=14), min_size=40, max_size=200))
def test_any_words_learnt_together_encode_like_the_library(words):
    library, vocabulary = LIBRARY
    learner = Vocabulary.__new__(Vocabulary)
    learner.__dict__ |= vocabulary.__dict__ | {"word_ids": Memory(lambda w: learner._word(w)), "piece_ids": Memory(learner._piece)}
    [ids] = learner.encode_group([" ".join(words)])
    assert list(array("I", ids)) == library.encode(" ".join(words), add_special_tokens=False).ids


def test_latin_texts_encode_like_the_library_whatever_is_forgotten(library):
    draw = random.Random(7)
    pools = [[chr(b) for b in range(256)], list("'strevmldTSRELA a.1²éÉ"), list("aeionrst ")]
    learner = Vocabulary(LIBRARY[1].content)
    for size in (500_000, 20):
        learner.latin_ids.size = size
        for _ in range(12):
            texts = ["".join(draw.choices(draw.choice(pools), k=draw.randint(0, 90))) for _ in range(30)]
            texts += ["", "'", "a'", "'s", "x'l", "''re 'rent it'd've 'S", "é" * 200, "ab " * 70 + "'ll", "Привет it's", "<|endoftext|>'s"]
            for text, ids in zip(texts, learner.encode_group(texts), strict=True):
                assert list(array("I", ids)) == library.encode(text, add_special_tokens=False).ids, text
    assert len(learner.latin_ids.slot) <= 20
    assert learner.encode_group([]) == [] and learner.encode_group(["", " "]) == [b"", b""]


def test_new_latin_words_are_not_handled_one_by_one():
    draw = random.Random(8)
    words = ["".join(draw.choices("aeinorstéü", k=draw.randint(5, 11))) + draw.choice(["", ".", ","]) for _ in range(20_000)]
    taught, learner, calls = Vocabulary(LIBRARY[1].content), Vocabulary(LIBRARY[1].content), 0
    taught.encode_group([" ".join(words)])
    learner.pairs = taught.pairs  # asked for once, whatever the number of words

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        learner.encode_group([" ".join(words)])
    finally:
        sys.setprofile(None)
    assert calls < len(words)
