"""Byte BPE, token files and packing against the public libraries."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import sys
import unicodedata
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, docs, table  # noqa: E402

from millrun.llm import byte_bpe, packing, token_file, tokens  # noqa: E402
from millrun.llm.common import Memo, scratch  # noqa: E402

RANKS, BYTE, WORD = (P.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def libraries():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    out = {"tiktoken": tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary}
    for path in (BYTE, WORD):
        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        out[path] = lambda s, t=t: t.encode(s, add_special_tokens=False).ids
    return out


def _random_texts(n):
    rnd = random.Random(11)
    wild = " " * 6 + "aeiouthnTHE'sStredlvm0123.,!?\n\t\r\x0b\x1c\x85\xa0 éßñÄΣσς١²½漢字한́̈İ​᠎﻿😀<|endoftext|>ǅﬁ"
    plain = " " * 6 + "abcdefghijklm.,;'éßñÄº"
    return ["".join(rnd.choice(rnd.choice((wild, plain))) for _ in range(rnd.choice((0, 1, 3, 10, 60, 300)))) for _ in range(n)]


def test_pattern_is_the_public_one():
    assert tokens.BYTE_PATTERN == P.PATTERN


def test_encoders_equal_the_libraries(libraries):
    bpe, encode = byte_bpe._encoder(RANKS)
    for text in _random_texts(4_000):
        want = libraries["tiktoken"](text)
        data, decimal = encode(text)
        assert tokens.words_le(data).tolist() == want and decimal == "".join(f"{i} " for i in want)
        assert bpe.decode(want) == text.encode()
        for path in (BYTE, WORD):
            assert tokens.words_le(tokens.file_encoder(path)(text)).tolist() == libraries[path](text), repr(text)


def test_segment_tree_on_long_pieces(libraries):
    bpe = byte_bpe.SegmentTreeBpe(RANKS)
    for piece in ("ab" * 20_000, "a" * 9_999, "thequickbrown" * 700, "é" * 3_000):
        assert bpe.encode_piece(piece) == libraries["tiktoken"](piece)


def test_memo_is_bounded_and_right():
    memo = Memo(lambda k: k * 2, limit=10, longest=4)
    assert all(memo[f"{i % 37}"] == f"{i % 37}" * 2 for i in range(2_000))
    assert len(memo) <= 10 and len(memo.old) <= 10
    assert memo["long" * 9] == "long" * 18 and "long" * 9 not in memo


def test_round_trip_of_awkward_texts(spark, libraries):
    rows = awkward()
    got = table(byte_bpe.round_trip(docs(spark, rows, clash=True), RANKS), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for doc, text in rows:
        ids = libraries["tiktoken"](text or "")
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert byte_bpe.round_trip(docs(spark, rows).where("false"), RANKS).count() == 0


def test_encode_and_decode_tables(spark):
    df = docs(spark, [(1, "some text é"), (2, None)])
    decoded = byte_bpe.decode(byte_bpe.encode(df, RANKS), RANKS)
    assert {r.doc_id: bytes(r.data) for r in decoded.collect()} == {1: "some text é".encode(), 2: b""}


def test_token_file(spark, libraries, monkeypatch):
    rows = [r for r in awkward() if r[0] is not None and r[0] not in (7, 13)] + [(100 + i, f"text number {i} of many words " * (i % 7)) for i in range(300)]
    path = scratch(spark, "test-file")
    monkeypatch.setattr(token_file, "BLOCK_BYTES", 2_000)  # several blocks a part
    got = {r.doc_id: r for r in token_file.round_trip(docs(spark, rows, clash=True), path, WORD, 1).collect()}
    start = 0
    for doc, text in sorted(rows):
        ids = np.array([*libraries[WORD](text or ""), 1], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(rows)
    few = {r.doc_id: list(r.ids) for r in token_file.fetch(spark, path, [9, 104]).collect()}
    assert few == {d: [*libraries[WORD](dict(rows)[d]), 1] for d in (9, 104)}
    digest, dictionary = token_file._dictionary(spark, path)
    assert hashlib.sha256(dictionary).hexdigest() == digest and dictionary
    assert spark.read.parquet(f"{path}/blocks").select("dictionary_sha256").distinct().count() == 1


def test_token_file_of_ties_and_nothing(spark):
    rows = awkward()
    got = token_file.round_trip(docs(spark, rows), scratch(spark, "ties"), WORD, 1).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 2
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert token_file.round_trip(docs(spark, rows).where("false"), scratch(spark, "none"), WORD, 1).count() == 0


def _best(lengths, size):
    """Fewest bins, by trying all places."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[i] <= size and bins[b] not in bins[:b]:
                go(i + 1, [*bins[:b], bins[b] + lengths[i], *bins[b + 1 :]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best[0]


def test_bounds_and_best_fit_against_all_packings():
    rnd = np.random.default_rng(3)
    for _ in range(150):
        size = int(rnd.integers(8, 40))
        lengths = rnd.integers(1, size + 1, int(rnd.integers(1, 9)))
        bins, offsets, fill = packing.best_fit_decreasing(lengths, size)
        best = _best(sorted(lengths.tolist(), reverse=True), size)
        assert packing.lower_bound(lengths, size) <= best <= len(fill) <= 11 * best / 9 + 1
        assert (fill <= size).all() and (np.bincount(bins, lengths) == fill).all()
        for b in range(len(fill)):
            at = np.argsort(offsets[bins == b])
            assert (offsets[bins == b][at] == np.concatenate(([0], np.cumsum(lengths[bins == b][at])[:-1]))).all()
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3  # a plain sum says 2


def _valid(rows, got, encode, size, end):
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    want = defaultdict(list)
    for doc, text in rows:
        ids = np.array([*encode(text or ""), end], "<u4")
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids) + 1, size)]
        want[doc] += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_of_awkward_texts(spark, libraries):
    rows = awkward()
    got = packing.pack(docs(spark, rows, clash=True), BYTE, size=64, end_id=0).collect()
    used = _valid(rows, got, libraries[BYTE], 64, 0)
    lengths = [r.length for r in got]
    assert used <= -(-sum(lengths) // 64) * 1.05 + 1
    assert packing.pack(docs(spark, rows).where("false"), BYTE).count() == 0


def test_partitions_with_a_gap_exchange(spark, libraries, monkeypatch):
    rnd = random.Random(2)
    rows = [(i, " a" * rnd.choice((3, 13, 21, 22, 25, 30, 39))) for i in range(600)]
    monkeypatch.setattr(packing, "PER_PARTITION", 40)
    got = packing.pack(docs(spark, rows), BYTE, size=64, end_id=0).collect()
    used = _valid(rows, got, libraries[BYTE], 64, 0)
    lengths = np.array([r.length for r in got])
    assert used <= len(packing.best_fit_decreasing(lengths, 64)[2]) + 2
    assert len({r.sequence_id >> 58 for r in got}) > 1  # some were packed in a later round


def test_rounds_are_as_wide_as_the_open_pieces_need(spark, libraries, monkeypatch):
    """Lengths of which two fit a sequence and three rarely do: most pieces stay open."""
    rnd = random.Random(4)
    rows = [(i, " a" * rnd.randrange(18, 31)) for i in range(900)]
    widths, pack = [], packing._pack
    monkeypatch.setattr(packing, "PER_PARTITION", 50)
    monkeypatch.setattr(packing, "_pack", lambda items, size, pools, salt: widths.append((items.count(), pools)) or pack(items, size, pools, salt))
    got = packing.pack(docs(spark, rows), BYTE, size=64, end_id=0).collect()
    used = _valid(rows, got, libraries[BYTE], 64, 0)
    assert len(widths) > 1 and all(n <= pools * 50 for n, pools in widths), widths
    assert used <= len(packing.best_fit_decreasing(np.array([r.length for r in got]), 64)[2]) * 1.03


def _batched(encoder, texts, rows=50):
    import pyarrow as pa

    out = []
    for at in range(0, len(texts), rows):
        ids, ends = encoder.batch(pa.array(texts[at : at + rows], pa.string()))
        out += [ids[a:b].tolist() for a, b in zip(ends.tolist(), ends[1:].tolist())]
    return out


def test_columns_of_texts_equal_the_libraries(libraries):
    texts = _random_texts(1_500)
    texts += [t.replace(" ", " word.\nNext ") for t in texts[::3]] + ["is.&&& un%%% it's.\n's a!\n", "x" * 60 + ". " + "x" * 60 + " y " + "x" * 60, " ", "", "a  b"]
    for encoder, want in ((byte_bpe._encoder(RANKS)[1], libraries["tiktoken"]), (tokens.file_encoder(BYTE), libraries[BYTE])):
        for limit in (encoder.LIMIT, 40):  # with the small one, words are forgotten and met again
            encoder.LIMIT = limit
            assert _batched(encoder, texts) == [want(t) for t in texts]
        del encoder.LIMIT


def test_each_word_of_a_column_is_encoded_once():
    asked = []
    encoder = tokens.SpacedEncoder(lambda piece: asked.append(piece) or [len(piece)])
    _batched(encoder, ["the cat sat, the cat", "a cat sat"] * 20)
    assert sorted(asked) == [" cat", " sat", " the", ",", "a", "the"]


def test_many_trees_at_once_equal_the_library(libraries):
    bpe, rnd = byte_bpe.SegmentTreeBpe(RANKS), random.Random(5)
    sizes = (1, 2, 3, 4, 5, 8, 9, 15, 16, 17, 32, 33, 63, 64, 65, 200)
    pieces = ["".join(rnd.choice("abtheinsér") for _ in range(rnd.choice(sizes))) for _ in range(6_000)]
    flat, starts, counts = bpe.encode_pieces(pieces)
    assert [flat[a : a + n].tolist() for a, n in zip(starts.tolist(), counts.tolist())] == [libraries["tiktoken"](p) for p in pieces]


def test_words_of_a_column_are_looked_up_once_and_equal_the_library(libraries):
    rnd = random.Random(6)
    texts = _random_texts(1_500) + ["x" * 60 + ". " + "É" * 60 + " y " + "x" * 60, "", " ", "a  b", "it's. (is) ªº'' İI ẞß K\u030c J\u030c <|endoftext|>", "\x1c", "fo\x85o \ufeffbar"]
    texts += [chr(c) + "A " + chr(c) + "a. a" + chr(c) for c in range(1, 0x3100) if unicodedata.category(chr(c)) != "Cn"]
    rnd.shuffle(texts)
    want = [libraries[WORD](t) for t in texts]
    encoder = tokens.WordEncoder(Tokenizer.from_file(WORD), _word_pattern())
    for limit in (250_000, 40):  # with the small one, words are forgotten and met again
        encoder.words.LIMIT = encoder.pieces.LIMIT = limit
        for rows in (1, 50):
            assert _batched(encoder, texts[:: 1 if rows > 1 else 20], rows) == want[:: 1 if rows > 1 else 20]
    assert max(map(len, encoder.words.at)) <= encoder.words.LONGEST


def _word_pattern():
    with open(WORD, encoding="utf-8") as f:
        return json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]


def test_a_word_file_asks_for_each_word_and_piece_of_a_column_once():
    encoder = tokens.WordEncoder(Tokenizer.from_file(WORD), _word_pattern())
    words, pieces = [], []
    for remembered, asked in ((encoder.words, words), (encoder.pieces, pieces)):
        remembered.learn = lambda keys, learn=remembered.learn, asked=asked: asked.append(sorted(keys)) or learn(keys)
    _batched(encoder, ["The cat sat, the cat.", "a  cat\nsat"] * 20)
    assert words == [["The", "a", "cat", "cat.", "sat", "sat,", "the"]]
    assert pieces == [[",", ".", "a", "cat", "sat", "the"]]
