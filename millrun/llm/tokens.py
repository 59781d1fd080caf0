"""Whole texts to token ids, piece by piece.

A tokenizer first splits a text by its pattern and then merges within each
piece, so a piece's ids do not depend on its surroundings. Texts are cut at
places that are always piece borders, and the ids of a cut are remembered
per worker in a bounded memo: frequent words are encoded once.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
import sys
from array import array
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import Memo

#: White space of one library and not of another: such texts take the plain way.
_ODD = re.compile("[\x1c-\x1f\x85᠎​﻿]")
#: Fixed split pattern of byte-level vocabularies (the public package's PATTERN).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: Letters below are letters to every library; such a word is one piece.
_LATIN = "\u0250"
#: A run of these is one piece (an apostrophe may open one with the letters after it).
_MARKS = "".join(c for c in string.punctuation if c != "'")


def packed(ids: list[int]) -> bytes:
    a = array("I", ids)  # four bytes on every platform of CPython
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()


_COUNT_BITS = 31
_COUNT = (1 << _COUNT_BITS) - 1


class SpacedEncoder:
    """Ids of a text whose pattern lets a piece take the one space before it.

    A single space between two non-space characters always opens a piece, so
    the text is cut there. A text with other white space next to a space is
    split by the pattern as a whole. ``encode_pieces`` encodes many pieces at
    once: their ids one after another, and the start and count of each.

    The ids of words met before lie in one array (``flat``), ``at`` has a word's
    place there: its start, and in the low bits its count. Of ``LIMIT`` words
    and more, those not asked for lately are forgotten.
    """

    LIMIT, LONGEST = 250_000, 48

    def __init__(self, encode_piece: Callable[[str], list[int]], pattern: str = BYTE_PATTERN, encode_pieces: Callable[[list[str]], tuple] | None = None) -> None:
        import regex

        self.split, self.encode_pieces = regex.compile(pattern).findall, encode_pieces or one_by_one(encode_piece)
        self.pieces = Memo(lambda piece: packed(encode_piece(piece)), self.LIMIT, self.LONGEST)
        self.at: dict[str, int] = {}
        self.flat, self.used = np.empty(1 << 16, "<u4"), 0
        self.old, self.old_flat = self.at, self.flat

    def __call__(self, text: str) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0].tobytes()

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column one after another, and where each text's begin and end.
        Each different word is looked up once."""
        if len(self.at) >= self.LIMIT or self.used >= 32 * self.LIMIT:
            self.old, self.old_flat = self.at, self.flat
            self.at, self.flat, self.used = {}, np.empty(1 << 16, "<u4"), 0
        cut = pc.split_pattern(column.cast(pa.string()), " ")
        coded = cut.flatten().dictionary_encode()
        of, ends = coded.indices.to_numpy(), cut.offsets.to_numpy() - cut.offsets[0].as_py()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        later = np.ones(len(of), bool)  # a text's first word has no space before it
        later[ends[:-1]] = False
        asked = np.zeros(len(different), bool)
        asked[of[later]] = True
        firsts = [different[k] for k in of[ends[:-1]].tolist()]
        self._learn_pieces([w for w in firsts if w.isalpha()])
        place = np.full(len(different), -1)
        place[asked] = self._places([w for w, yes in zip(different, asked.tolist()) if yes])
        bad = np.concatenate(([0], np.cumsum((place[of] < 0) & later)))
        plain = (bad[ends[1:]] > bad[ends[:-1]]).tolist()
        place = place[of]
        alone, at = [], self.used  # what follows the words' ids
        for row, (first, a, b) in enumerate(zip(firsts, ends.tolist(), ends[1:].tolist())):
            if plain[row] or b - a == 1 or not first or first[-1].isspace() or _ODD.search(first):
                ids = self._whole(column[row].as_py())
                place[a + 1 : b] = 0
            else:
                ids = self._whole(first)
            alone.append(ids)
            place[a] = at << _COUNT_BITS | len(ids) // 4
            at += len(ids) // 4
        flat = np.concatenate((self.flat[: self.used], np.frombuffer(b"".join(alone), "<u4")))
        ids, upto = _gathered(flat, place)
        return ids, np.concatenate(([0], upto))[ends]

    def _whole(self, text: str) -> bytes:
        pieces = self.split(text)
        if len(pieces) > 1:
            self._learn_pieces(pieces)
        return b"".join([self.pieces[p] for p in pieces])

    def _learn_pieces(self, pieces: list[str]) -> None:
        new = [p for p in dict.fromkeys(pieces) if len(p) <= self.LONGEST and p not in self.pieces and p not in self.pieces.old]
        if len(new) > 1:
            flat, starts, counts = self.encode_pieces(new)
            data = flat.astype("<u4").tobytes()
            for piece, a, n in zip(new, starts.tolist(), counts.tolist(), strict=True):
                self.pieces.remember(piece, data[4 * a : 4 * (a + n)])

    def _places(self, words: list[str]) -> np.ndarray:
        """The place of what each `` word`` gives, -1 where a cut before or after it is not safe."""
        place = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(place < 0).tolist()
        if new:
            self._learn([words[k] for k in new])
            place[new] = [self.extra.pop(words[k], -1) if (p := self.at.get(words[k])) is None else p for k in new]
        return place

    def _learn(self, words: list[str]) -> None:
        self.extra: dict[str, int] = {}  # long words: not remembered
        before = np.fromiter(map(self.old.get, words, repeat(-1)), np.int64, len(words))
        known = np.flatnonzero(before >= 0)
        ids, upto = _gathered(self.old_flat, before[known])
        counts = before[known] & _COUNT
        self._append([words[k] for k in known.tolist()], ids, upto - counts, counts)
        letters: dict[str, None] = {}  # words of one piece
        others: list[tuple[str, str, list[str]]] = []  # a word, its letters, the pieces after them
        bare: list[str] = []
        for k in np.flatnonzero(before < 0).tolist():
            word = words[k]
            if word.isalpha() and max(word) < _LATIN:
                letters[word] = None
                continue
            line, _, rest = word.partition("\n")  # the end of a line opens a piece
            stem = line.rstrip(_MARKS)
            if not (stem.isalpha() and max(stem) < _LATIN):
                stem, rest, tail = "", "", word
            else:
                tail = word[len(stem) :]
                if word[-1].isspace() or (rest and rest[0].isspace()) or _ODD.search(rest):
                    continue
                if stem not in self.at:
                    letters[stem] = None
            if not stem and (not word or word[0].isspace() or word[-1].isspace() or _ODD.search(word)):
                continue
            if stem and len(line) == len(word):
                pieces = [tail]  # a run of marks
            else:
                pieces = self.split(tail if stem else " " + word)
                bare += pieces
            others.append((word, stem, pieces))
        ones = [w for w in letters if w not in self.at]
        if ones:
            self._append(ones, *self.encode_pieces([" " + w for w in ones]))
        if others:
            self._learn_pieces(bare)
            values = []
            for word, stem, pieces in others:
                data = b"".join([self.pieces[p] for p in pieces])
                if stem:
                    at = self.at.get(stem, -1)
                    at = self.extra[stem] if at < 0 else at
                    start = at >> _COUNT_BITS
                    data = self.flat[start : start + (at & _COUNT)].tobytes() + data
                values.append(data)
            counts = np.fromiter(map(len, values), np.int64, len(values)) // 4
            self._append([o[0] for o in others], np.frombuffer(b"".join(values), "<u4"), np.cumsum(counts) - counts, counts)

    def _append(self, words: list[str], flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        need = self.used + len(flat)
        if need > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.empty(need, "<u4")))
        self.flat[self.used : need] = flat
        places = ((starts + self.used) << _COUNT_BITS | counts).tolist()
        self.used = need
        self.at.update(zip(words, places, strict=True))
        if max(map(len, words), default=0) > self.LONGEST:
            for word in words:
                if len(word) > self.LONGEST:
                    self.extra[word] = self.at.pop(word)


def _gathered(flat: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids at each place one after another, and where those of each end."""
    counts = place & _COUNT
    upto = np.cumsum(counts)
    total = int(upto[-1]) if len(upto) else 0
    return flat[np.repeat((place >> _COUNT_BITS) - (upto - counts), counts) + np.arange(total)], upto


def one_by_one(encode_piece: Callable[[str], list[int]]) -> Callable[[list[str]], tuple]:
    def encode_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids: list[int] = []
        ends = []
        for piece in pieces:
            ids += encode_piece(piece)
            ends.append(len(ids))
        starts = np.array([0, *ends[:-1]], np.int64)
        return np.array(ids, "<u4"), starts, np.array(ends, np.int64) - starts

    return encode_pieces


class Remembered:
    """Ids of strings met before, one string's after another's in one array (``flat``).

    ``at`` has a string's place there: its start, and in the low bits its count.
    ``learn`` gives the ids and counts of many new ones at once. Of ``LIMIT``
    strings and more, those not asked for lately are forgotten.
    """

    LIMIT, LONGEST = 250_000, 48

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.learn = learn
        self.at: dict[str, int] = {}
        self.flat, self.used = np.empty(1 << 16, "<u4"), 0
        self.old, self.old_flat = self.at, self.flat

    def places(self, keys: list[str]) -> np.ndarray:
        """The places in ``flat`` of different strings, good until the next call."""
        if len(self.at) >= self.LIMIT or self.used >= 32 * self.LIMIT:
            self.old, self.old_flat = self.at, self.flat
            self.at, self.flat, self.used = {}, np.empty(1 << 16, "<u4"), 0
        place = np.fromiter(map(self.at.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(place < 0)
        if len(new):
            before = np.fromiter(map(self.old.get, [keys[k] for k in new.tolist()], repeat(-1)), np.int64, len(new))
            known, before = new[before >= 0], before[before >= 0]
            place[known] = self._append([keys[k] for k in known.tolist()], _gathered(self.old_flat, before)[0], before & _COUNT)
            new = new[place[new] < 0]
        if len(new):
            asked = [keys[k] for k in new.tolist()]
            place[new] = self._append(asked, *self.learn(asked))
        return place

    def _append(self, keys: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        need = self.used + len(ids)
        if need > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.empty(need, "<u4")))
        self.flat[self.used : need] = ids
        places = (np.cumsum(counts) - counts + self.used) << _COUNT_BITS | counts
        self.used = need
        self.at.update(zip(keys, places.tolist(), strict=True))
        if max(map(len, keys), default=0) > self.LONGEST:
            for key in keys:
                if len(key) > self.LONGEST:
                    del self.at[key]
        return places


class WordEncoder:
    """Ids of a text whose tokenizer drops white space: cut at every white space.

    The words of a column are cut in Arrow and each different one is looked up
    once; new pieces of all of them are encoded together.
    """

    def __init__(self, tokenizer, pattern: str) -> None:
        import regex

        self.split, self.normalize = regex.compile(pattern).findall, tokenizer.normalizer.normalize_str
        self.pieces = Remembered(library_pieces(tokenizer))
        self.words = Remembered(self._joined)

    def _cut(self, word: str) -> list[str]:
        if word.isascii() or max(word) < _LATIN:  # in normal form
            low = word.lower()
            if low.isalpha():
                return [low]
            stem = low.rstrip(_MARKS)
            if stem.isalpha():
                return [stem, low[len(stem) :]]
        return self.split(self.normalize(word))

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        cuts = list(map(self._cut, texts))
        numbers: dict[str, int] = {}
        of = np.array([numbers.setdefault(p, len(numbers)) for pieces in cuts for p in pieces], np.int64)
        place = self.pieces.places(list(numbers))[of]
        ids, upto = _gathered(self.pieces.flat, place)
        ends = np.cumsum([0, *map(len, cuts)])
        return ids, np.diff(np.concatenate(([0], upto))[ends])

    def __call__(self, text: str) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0].tobytes()

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column one after another, and where each text's begin and end."""
        column = column.cast(pa.string())
        odd = pc.match_substring_regex(column, pattern=_ODD.pattern)
        cut = pc.utf8_split_whitespace(pc.if_else(odd, "", column))
        coded = cut.flatten().dictionary_encode()
        place = self.words.places(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        ids, upto = _gathered(self.words.flat, place)
        ends = np.concatenate(([0], upto))[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if not len(whole):
            return ids, ends
        others, counts = self._joined([column[k].as_py() for k in whole.tolist()])
        ids = np.insert(ids, np.repeat(ends[whole], counts), others)
        more = np.zeros(len(ends), np.int64)
        more[whole + 1] = counts
        return ids, ends + np.cumsum(more)


def library_pieces(tokenizer) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Ids of many pieces at once, by the library's merges, and how many each has.

    Where a word's last token is marked by a suffix, the pieces go through the
    library as one text, and the marks say where each one ends.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    model = tokenizer.model

    def alone(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, _, counts = one_by_one(lambda piece: [t.id for t in model.tokenize(visible(piece))])(pieces)
        return flat, counts

    suffix = getattr(model, "end_of_word_suffix", None)
    if not suffix:
        return alone
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    plain = Tokenizer(model)  # no special tokens
    plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    vocab = plain.get_vocab(with_added_tokens=False)
    last = np.zeros(max(vocab.values()) + 1, bool)
    last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def together(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(plain.encode_batch_fast([" ".join(map(visible, pieces))], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(last[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(pieces) else alone(pieces)

    return together


def _byte_letters() -> dict[int, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary:
    itself where printable, else the next free letter from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


_SPACE = chr(_LETTERS[32])


def visible(piece: str) -> str:
    if piece.isascii():
        if piece.isalpha():
            return piece
        if piece[1:].isalpha() and piece[0] == " ":
            return _SPACE + piece[1:]
    return piece.encode().decode("latin-1").translate(_LETTERS)


@functools.lru_cache(maxsize=4)
def file_encoder(path: str) -> Callable[[str], bytes]:
    """The encoder of a ``tokenizers`` file as little-endian unsigned 32-bit ids,
    once per worker. The library's own normalizer and merges are used; strings
    of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    splits = [p for p in (spec["pre_tokenizer"].get("pretokenizers") or []) if p["type"] == "Split"]
    if splits:
        return WordEncoder(tokenizer, splits[0]["pattern"]["Regex"])
    return SpacedEncoder(lambda piece: [t.id for t in tokenizer.model.tokenize(visible(piece))])


def words_le(ids: bytes) -> np.ndarray:
    """Little-endian unsigned 32-bit ids as an array."""
    a = np.frombuffer(ids, dtype="<u4")
    return a if sys.byteorder == "little" else a.astype(np.uint32)
