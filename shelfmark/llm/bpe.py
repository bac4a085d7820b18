"""BPE encoding and decoding with a public vocabulary (operator 2).

Encoding is exact without replaying merges. An Aho-Corasick automaton over all
tokens finds the longest token that starts at each position of a piece. The
encoder walks these matches from left to right and accepts a token when its pair
with the token before it is compatible, that is, when merging both texts from
scratch would leave exactly this pair. If no prefix of a match fits, the encoder
steps back and marks the position as a dead end, so every position is left at
most once for each token that ends there. Latin-1 texts are cut into pieces as one
byte array, a group of texts at a time, and each distinct piece is looked up once;
words of other scripts are looked up one by one. The pieces that a group brings
anew are matched in one run and walked side by side in flat arrays. Decoding
gathers token texts from one byte buffer through a table of offsets.

Edge cases: null is the empty text and gives no tokens; any white space, control
characters and code points of any script follow the vocabulary's normaliser;
special tokens in a text become their ids. Rows are handled one by one, so
repeated rows repeat their result and extra columns do not matter.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FLUSH_BYTES, groups_of, map_texts, take_turn

WORD_END = "</w>"
#: Latin text, where Python's Unicode tables agree with any vocabulary file's.
PLAIN_BELOW = "ɐ"
#: Entries of one generation of remembered words; two generations are held.
REMEMBERED = 200_000
#: Pieces of Latin-1 texts that are remembered from group to group.
PIECES_KEPT = 300_000
#: Pairs of tokens of which it is remembered whether they are compatible.
PAIRS = 1 << 20
#: Pieces are walked side by side if there are so many, none longer than this.
ABREAST, SHORT = 32, 64
#: Stands between pieces that are matched in one run; no token has it.
GAP = 600
#: Pieces that are matched and walked in one run.
AT_ONCE = 1 << 14
#: What the pattern of the pre-tokeniser tells apart; each number is a piece.
SPACE, LETTER, NUMBER, OTHER = range(4)

# The pattern of the vocabulary's pre-tokeniser.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable
    Latin-1 stands for itself, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        letters.setdefault(b, chr(0x100 + b - sum(o < b for o in own)))
    return [letters[b] for b in range(256)]


def gathered(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places ``start`` to ``start + count`` of each row, one row after the other."""
    ends = np.cumsum(count)
    places = np.repeat(start - (ends - count), count)
    places += np.arange(len(places))
    return places


class Memory(dict):
    """Word to ids, as bytes; forgets what was not used for a generation."""

    def __init__(self, make, size: int = REMEMBERED):
        super().__init__()
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, word: str) -> bytes:
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        self.put(word, value)
        return value

    def put(self, word: str, value: bytes) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[word] = value

    def knows(self, word: str) -> bool:
        return word in self or word in self.older


class PieceIds:
    """Ids of Latin-1 pieces in one flat array; when there are too many, those that
    no later group had are forgotten."""

    def __init__(self, make, size: int = PIECES_KEPT):
        self.make, self.size = make, size
        self.slot: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int64)

    def slots(self, pieces: list[bytes]) -> np.ndarray:
        """Where ids of distinct pieces stand in ``start`` and ``count``; good until ``tidy``."""
        found = np.fromiter(map(self.slot.get, pieces, repeat(-1)), np.int64, len(pieces))
        self.hits[found[found >= 0]] += 1
        new = np.flatnonzero(found < 0)
        if len(new):
            unknown = [pieces[k] for k in new.tolist()]
            made = [self.make(unknown[k : k + AT_ONCE]) for k in range(0, len(unknown), AT_ONCE)]
            count = np.concatenate([n for _, n in made])
            found[new] = np.arange(len(self.slot), len(self.slot) + len(new))
            self.slot.update(zip(unknown, found[new].tolist()))
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in made)])
        return found

    def tidy(self) -> None:
        if len(self.slot) <= self.size:
            return
        kept = np.flatnonzero(self.hits)
        if len(kept) > self.size // 2:
            kept = np.sort(kept[np.argsort(-self.hits[kept], kind="stable")[: self.size // 2]])
        pieces = list(self.slot)
        self.slot = {pieces[k]: at for at, k in enumerate(kept.tolist())}
        self.ids = self.ids[gathered(self.start[kept], self.count[kept])]
        self.count = self.count[kept]
        self.start = np.cumsum(self.count) - self.count
        self.hits = np.zeros(len(kept), np.int64)


class Pairs:
    """Whether two tokens are compatible; asked for once, kept in open addressing."""

    def __init__(self, fits, size: int = PAIRS):
        self.fits, self.size = fits, size
        self.shift = np.uint64(64 - (2 * size - 1).bit_length())
        self._empty()

    def _empty(self) -> None:
        self.used = 0
        self.keys = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.good = np.zeros(len(self.keys), bool)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 32) + right
        out, cell = np.zeros(len(keys), bool), self._cell(keys)
        left_over, unknown = np.arange(len(keys)), []
        while len(left_over):
            seen = self.keys[cell[left_over]]
            hit = seen == keys[left_over]
            out[left_over[hit]] = self.good[cell[left_over[hit]]]
            unknown.append(left_over[seen < 0])
            left_over = left_over[~hit & (seen >= 0)]
            cell[left_over] = (cell[left_over] + 1) % len(self.keys)
        unknown = np.concatenate(unknown) if unknown else left_over
        if len(unknown):
            new, where = np.unique(keys[unknown], return_inverse=True)
            out[unknown] = np.array([self._ask(int(key)) for key in new])[where]
        return out

    def _cell(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ask(self, key: int) -> bool:
        if self.used >= self.size:
            self._empty()
        at = ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while self.keys[at] >= 0:
            at = (at + 1) % len(self.keys)
        self.keys[at], self.good[at] = key, self.fits(key >> 32, key & 0xFFFFFFFF)
        self.used += 1
        return bool(self.good[at])


class Vocabulary:
    """Tables of one byte-level BPE vocabulary with word ends."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or model["ignore_merges"]:
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.content = content
        self.text_of = {i: t for t, i in model["vocab"].items()}
        self.text_of |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pieces = regex.compile(PIECES)
        self.odd_space = regex.compile("[\x1c-\x1f]")
        latin = [chr(b) for b in range(256)]
        self.lower = "".join(latin).lower().encode("latin-1")
        kinds = {SPACE: r"\s", LETTER: r"\p{L}", NUMBER: r"\p{N}", OTHER: r"[^\s\p{L}\p{N}]"}
        self.kind = np.array([next(k for k, p in kinds.items() if regex.match(p, c)) for c in latin], np.uint8)
        self.letters = byte_letters()
        self._matching(model)
        # Pieces of plain lower-case letters are words too and remembered there.
        self.piece_ids = Memory(self._piece, REMEMBERED // 2)
        self.word_ids = Memory(self._word)
        self.latin_ids = PieceIds(self._latin_pieces)
        self.compatible = lru_cache(PAIRS // 16)(self.fits)
        self.pairs = Pairs(self.fits)

    def _matching(self, model: dict) -> None:
        """A token is spelt in 512 symbols: a byte, or a byte that ends a word."""
        byte_of = {letter: b for b, letter in enumerate(self.letters)}

        def spelt(token: str) -> str:
            ends = token.endswith(WORD_END) and token != WORD_END
            bytes_ = [byte_of[c] for c in (token[: -len(WORD_END)] if ends else token)]
            return "".join(map(chr, bytes_[:-1])) + chr(bytes_[-1] + 256 * ends)

        ids = {spelt(t): i for t, i in model["vocab"].items()}
        size = max(self.text_of) + 1
        self.length, self.shorter = [0] * size, [-1] * size
        # Tokens of one and two symbols are told by tables, longer ones by the automaton.
        self.one, self.two = np.full(512, -1), np.full((512, 512), -1, np.int32)
        self.short: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for s, i in ids.items():
            if len(s) > 2:
                self.automaton.add_word(s, i)
            else:
                self.short[s] = i
                table, place = (self.one, ord(s)) if len(s) == 1 else (self.two, (ord(s[0]), ord(s[1])))
                table[place] = i
            self.length[i] = len(s)
            self.shorter[i] = next((ids[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in ids), -1)
        self.automaton.make_automaton()
        self.lengths, self.shorter_of = np.array(self.length), np.array(self.shorter)
        # By token: when its merge is due (-1: a single symbol) and its halves.
        self.due, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.joint: dict[tuple[int, int], int] = {}
        vocab = model["vocab"]
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            i = vocab[a + b] if a + b in vocab else ids[spelt(a) + spelt(b)]
            if self.due[i] >= 0:
                raise ValueError("a token with two merges is not supported")
            self.joint[vocab[a], vocab[b]] = rank
            self.due[i], self.left[i], self.right[i] = rank, vocab[a], vocab[b]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the texts of both tokens gives this very pair.

        Merges are undone, the latest first, and only next to the seam. A merge
        over the seam that was due before the one just undone breaks the pair.
        Of equal merges the left one comes first.
        """
        limit, joint, due = 2 * len(self.joint) + 2, self.joint, self.due
        while True:
            across = joint.get((left, right))
            if across is not None and 2 * across < limit:
                return False
            a, b = due[left], due[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = 2 * a, self.right[left]
            else:
                limit, right = 2 * b + 1, self.left[right]

    @staticmethod
    def _symbols(piece: str) -> str:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1")
        return piece[:-1] + chr(ord(piece[-1]) + 256)

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece, given in the vocabulary's letters for bytes."""
        return self._matched(self._symbols(piece))

    def _matched(self, symbols: str) -> bytes:
        n, length, shorter, compatible = len(symbols), self.length, self.shorter, self.compatible
        short = self.short
        longest = [short.get(symbols[i : i + 2], -1) for i in range(n)]
        longest = [t if t >= 0 else short.get(s, -1) for t, s in zip(longest, symbols)]
        for end, token in self.automaton.iter(symbols):
            longest[end - length[token] + 1] = token
        found: list[int] = []
        dead = bytearray(n + 1)
        at, before, token = 0, -1, longest[0]
        while True:
            end = at + length[token]
            if not dead[end] and (before < 0 or compatible(before, token)):
                found.append(token)
                if end == n:
                    return array("I", found).tobytes()
                at, before, token = end, token, longest[end]
                continue
            token = shorter[token]
            if token < 0:
                while token < 0:
                    dead[at] = 1
                    token = found.pop()
                    at -= length[token]
                    token = shorter[token]
                before = found[-1] if found else -1

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The same for many short pieces."""
        symbols = [self._symbols(piece) for piece in pieces]
        sizes = np.array([len(s) for s in symbols])
        stop = np.cumsum(sizes + 1) - 1  # where the gap behind a piece is
        start = stop - sizes
        gap = chr(GAP)
        stack, depth = self._walk(np.frombuffer((gap.join(symbols) + gap).encode("utf-32-le"), "<u4"), start, stop)
        data = stack.astype("<u4").tobytes()
        return [data[4 * s : 4 * (s + d)] for s, d in zip(start.tolist(), depth.tolist())]

    def _latin_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in lower-case Latin-1, one after the other, and how many each has."""
        data = (b"\n".join(pieces) + b"\n").decode("latin-1").encode()  # no piece has white space
        codes = np.frombuffer(data, np.uint8).astype("<u4")
        stop = np.flatnonzero(codes == ord("\n"))
        start = np.concatenate([[0], stop[:-1] + 1])
        codes[stop - 1] += 256
        codes[stop] = GAP
        stack, depth = self._walk(codes, start, stop)
        return stack[gathered(start, depth)], depth

    def _walk(self, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces spelt in ``codes`` with gaps behind them, one step of each walk
        at a time: a piece's ids stand from its start on, as many as the second array says."""
        text = codes.tobytes().decode("utf-32-le")
        longest = self._short_tokens(codes)
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        longest[hits[:, 0] - self.lengths[hits[:, 1]] + 1] = hits[:, 1]  # later, and so longer, ones stay
        stack, dead = np.zeros(len(longest), np.uint32), np.zeros(len(longest), bool)
        depth = np.zeros(len(start), np.int64)
        piece, long = np.flatnonzero(stop - start <= SHORT), np.flatnonzero(stop - start > SHORT)
        at, before, token = start[piece], np.full(len(piece), -1), longest[start[piece]]
        while len(piece) >= ABREAST:
            end = at + self.lengths[token]
            good = (token >= 0) & ~dead[np.where(token >= 0, end, at)]
            asked = np.flatnonzero(good & (before >= 0))
            good[asked] = self.pairs(before[asked], token[asked])
            back = np.flatnonzero(token < 0)
            down = np.flatnonzero(~good & (token >= 0))
            token[down] = self.shorter_of[token[down]]
            if len(back):
                dead[at[back]] = True
                depth[piece[back]] -= 1
                top = start[piece[back]] + depth[piece[back]]
                taken = stack[top].astype(np.int64)
                at[back] -= self.lengths[taken]
                token[back] = self.shorter_of[taken]
                before[back] = np.where(depth[piece[back]] > 0, stack[np.maximum(top - 1, 0)], -1)
            on = np.flatnonzero(good)
            stack[start[piece[on]] + depth[piece[on]]] = token[on]
            depth[piece[on]] += 1
            before[on], at[on] = token[on], end[on]
            token[on] = longest[np.minimum(end[on], len(longest) - 1)]
            going = np.ones(len(piece), bool)
            going[on] = end[on] < stop[piece[on]]
            piece, at, before, token = piece[going], at[going], before[going], token[going]
        for left in (*piece.tolist(), *long.tolist()):
            ids = np.frombuffer(self._matched(text[start[left] : stop[left]]), np.uint32)
            stack[start[left] : start[left] + len(ids)] = ids
            depth[left] = len(ids)
        return stack, depth

    def _short_tokens(self, codes: np.ndarray) -> np.ndarray:
        """The longest token of at most two symbols at each place of a text; none at gaps."""
        known = codes < 512
        code = np.where(known, codes, 0)
        longest = np.where(known, self.one[code], -1)
        pairs = np.where(known[:-1] & known[1:], self.two[code[:-1], code[1:]], -1)
        longest[:-1] = np.where(pairs >= 0, pairs, longest[:-1])
        return longest

    def encoded(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of the texts of an Arrow column, encoded group by group."""
        for group in groups_of(column):
            yield from self.encode_group(group)

    def encode_group(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; every piece or word of the group is looked up once."""
        letters = [self._latin(text) for text in texts]
        latin = iter(self._encode_latin([raw for raw in letters if raw is not None]))
        others = iter(self._encode_words([t for t, raw in zip(texts, letters) if raw is None]))
        return [next(others if raw is None else latin) for raw in letters]

    def _latin(self, text: str) -> bytes | None:
        """A text in lower-case Latin-1; None if it has other letters, special tokens or
        separators of its own. Latin-1 has no decomposed letters, so case is all that
        its normaliser changes."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if b"<|" in raw or any(b in raw for b in (b"\x1c", b"\x1d", b"\x1e", b"\x1f")):
            return None
        return raw.translate(self.lower)

    def _encode_latin(self, texts: list[bytes]) -> list[bytes]:
        """Ids of lower-case Latin-1 texts: all are cut into pieces at once."""
        codes = np.frombuffer(b"\n".join(texts), np.uint8)
        kind = self.kind[codes]
        first = kind == NUMBER
        first[:1] = True
        first[1:] |= kind[1:] != kind[:-1]
        self._contract(codes, kind, first)
        inner = kind != SPACE
        pieces = np.flatnonzero(first & inner)
        starts = np.append(np.flatnonzero(first[inner]), np.count_nonzero(inner)).astype(np.int32)
        buffers = [None, pa.py_buffer(starts), pa.py_buffer(codes[inner])]
        distinct = pa.Array.from_buffers(pa.binary(), len(pieces), buffers).dictionary_encode()
        slots = self.latin_ids.slots(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()]
        count = self.latin_ids.count[slots]
        ids = self.latin_ids.ids[gathered(self.latin_ids.start[slots], count)].astype("<u4", copy=False)
        self.latin_ids.tidy()
        # By text: its first piece, and so its first id.
        begin = np.cumsum([0, *(len(raw) + 1 for raw in texts)])
        place = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(pieces, begin)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(place, place[1:])]

    @staticmethod
    def _contract(codes: np.ndarray, kind: np.ndarray, first: np.ndarray) -> None:
        """Mark pieces like 's and 're, which an apostrophe on its own begins."""
        marks = np.flatnonzero((codes[:-1] == ord("'")) & first[:-1] & (kind[1:] == LETTER))
        one = codes[marks + 1]
        two = codes[np.minimum(marks + 2, len(codes) - 1)]
        whole = marks + 2 < len(codes)
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        wide = whole & (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | whole & (one == ord("l")) & (two == ord("l"))
        for chosen, width in ((marks[short], 2), (marks[wide], 3)):
            first[chosen + 1] = False
            behind = chosen + width
            first[behind[behind < len(codes)]] = True

    def _encode_words(self, texts: list[str]) -> list[bytes]:
        """Ids of any texts; every word of them is looked up once."""
        split = [self._words_of(text) for text in texts]
        found: dict[str, bytes] = {}
        new, get, older = [], self.word_ids.get, self.word_ids.older.get
        for word in set().union(*[words for words in split if words]):
            ids = get(word) or older(word)
            if ids is None:
                new.append(word)
            else:
                found[word] = ids
        self._learn(new, found)
        ids_of = found.__getitem__
        return [self.encode(t) if words is None else b"".join(map(ids_of, words)) for t, words in zip(texts, split)]

    def _words_of(self, text: str) -> list[str] | None:
        """Words of a text; None if it has special tokens or separators of its own."""
        if "<|" in text or self.odd_space.search(text):
            return None
        return text.split()

    def _learn(self, new: list[str], found: dict[str, bytes]) -> None:
        """Remember new words, and put their ids into ``found``."""
        parts = {}
        for word in new:
            if word.isascii():
                parts[word] = self._split(word.lower())
            elif max(word) < PLAIN_BELOW:
                parts[word] = self._split(unicodedata.normalize("NFC", word).lower())
        words, others = self.word_ids, self.piece_ids
        unknown = set()
        for of_word in parts.values():
            for piece in of_word:
                if len(piece) <= SHORT and not (words if piece.isascii() and piece.isalpha() else others).knows(piece):
                    unknown.add(piece)
        pieces = list(unknown)
        if len(pieces) >= ABREAST:
            for piece, ids in zip(pieces, self._pieces(pieces)):
                (words if piece.isascii() and piece.isalpha() else others).put(piece, ids)
        for word in new:
            of_word = parts.get(word)
            if of_word is None or len(of_word) == 1 and of_word[0] == word:
                found[word] = words[word]
            else:
                ids = found[word] = b"".join([words[p] if p.isascii() and p.isalpha() else others[p] for p in of_word])
                words.put(word, ids)

    @property
    def library(self):
        """The public tokenizers library: its Unicode tables for rare scripts."""
        if not hasattr(self, "_library"):
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.content.decode())
        return self._library

    def _split(self, word: str) -> list[str]:
        """Pieces of a plain word; the pattern is spared for letters and one mark."""
        if word.isalpha():
            return [word]
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [word[:-1], word[-1]]
        return self.pieces.findall(word)

    def _word(self, word: str) -> bytes:
        """Ids of what stands between two white spaces."""
        if word.isascii() and word.isalpha():
            return self._piece(word) if word.islower() else self.word_ids[word.lower()]
        if max(word) < PLAIN_BELOW:
            pieces = self._split(unicodedata.normalize("NFC", word).lower())
        else:
            normal = self.library.normalizer.normalize_str(word)
            byte_of = {letter: b for b, letter in enumerate(self.letters)}
            pieces = [
                bytes(byte_of[c] for c in piece).decode()
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)
            ]
        words, others = self.word_ids, self.piece_ids
        return b"".join([words[p] if p.isascii() and p.isalpha() else others[p] for p in pieces])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if "<|" in text:
            parts = self.special_pattern.split(text)
            return b"".join(self.special.get(p) or self._plain(p) for p in parts)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        words = text.split() if not self.odd_space.search(text) else [w for w in regex.split(r"\s+", text) if w]
        return b"".join(map(self.word_ids.__getitem__, words))


class TokenTexts:
    """Token texts, each with a blank, in one buffer with a table of offsets."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        text_of = {i: t for t, i in spec["model"]["vocab"].items()}
        text_of |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        texts = [(text_of.get(i, "") + " ").encode() for i in range(max(text_of) + 1)]
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        self.widths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.widths)])[:-1]

    def decode(self, ids: bytes) -> bytes:
        """Token texts with blanks between them, in UTF-8."""
        if not ids:
            return b""
        tokens = np.frombuffer(ids, "<u4")
        widths = self.widths[tokens]
        return self.buffer[gathered(self.starts[tokens], widths)[:-1]].tobytes()


@lru_cache(maxsize=1)
def _vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


def vocabulary(content: bytes) -> Vocabulary:
    """The tables of a vocabulary, held as long as a worker encodes."""
    take_turn("bpe", _vocabulary.cache_clear)
    return _vocabulary(content)


@lru_cache(maxsize=2)
def token_texts(content: bytes) -> TokenTexts:
    return TokenTexts(content)


def ship(df: DataFrame, tokenizer_path: str):
    """Broadcast a vocabulary file (about 2 MB, whatever the data's size)."""
    with open(tokenizer_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def bpe_encode(df: DataFrame, tokenizer_path: str, *keys: str, text: str = "text") -> DataFrame:
    """``keys`` and ``ids``: little-endian unsigned 32-bit token ids of ``text``."""
    shared = ship(df, tokenizer_path)

    def rows(texts: list[str]) -> list[tuple]:
        return [(ids,) for ids in vocabulary(shared.value).encode_group(texts)]

    return map_texts(df, list(keys), text, "ids binary", None, lambda found: len(found[0]), rows)


def bpe_decode(df: DataFrame, tokenizer_path: str, *keys: str, ids: str = "ids") -> DataFrame:
    """``keys`` and ``decoded``: the text of each row's ids."""
    shared = ship(df, tokenizer_path)
    source = df.select(*dict.fromkeys([*keys, ids]))
    place = source.columns.index(ids)
    schema = source.select(*keys).schema.add("decoded", "string", True)
    names = [*keys, "decoded"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = token_texts(shared.value)
            start, held, out = 0, 0, []
            for at, value in enumerate(batch.column(place)):
                out.append(texts.decode(value.as_py() or b""))
                held += len(out[-1])
                if held >= FLUSH_BYTES or at == batch.num_rows - 1:
                    kept = [batch.column(k).slice(start, len(out)) for k in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(out, pa.binary()).cast(pa.string())], names=names)
                    start, held, out = at + 1, 0, []

    return source.mapInArrow(run, schema)


def token_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digest columns of an encoding and of what it decodes to."""
    encoded = bpe_encode(docs, tokenizer_path, "doc_id")
    return bpe_decode(encoded, tokenizer_path, "doc_id", "ids").select(
        "doc_id",
        F.expr("octet_length(ids) div 4").cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
