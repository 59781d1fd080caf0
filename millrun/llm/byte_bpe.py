"""Byte-level BPE encoding and decoding with a segment tree per piece.

The tree's leaves are the byte positions of a piece. The leaf of a live
position holds the rank of the pair that starts there (and the position, so
that the minimum is the leftmost one); a merge takes the root, removes the
right neighbour and updates at most three leaves: the merged position, the
removed one and the live neighbour to the left, each in logarithmic time. A
piece of n bytes costs O(n log n) even if it is one very long word. The trees
of many short pieces are worked on together, as rows of one array: a step does
the next merge of each of them.

Defined cases: null text is an empty one (no ids; digests of the empty
string); an empty table gives no rows; repeated rows are encoded each; other
columns of the input are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of, text_of, uncollected
from .tokens import SpacedEncoder, words_le

_NONE = 1 << 62
_SHIFT = 32
_MASK = (1 << _SHIFT) - 1
JOINT = 64  # bytes of a piece whose tree is one of many at most
_TREES = 4_096  # of them at once
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Pairs:
    """Rank of the token that two neighbouring tokens make, -1 if none: an open hash table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.span = max(ranks.values(), default=0) + 1
        found = [(a * self.span + b, r) for token, r in ranks.items() for k in range(1, len(token)) if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None]
        keys, values = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)
        self.bits = (4 * len(found) + 1).bit_length()
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int64)
        at = self._slots(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            self.values[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], at[~mine] + 1 & (1 << self.bits) - 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _ODD >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.span + b
        at = self._slots(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], -1)
        rest = np.flatnonzero((found != keys) & (found != -1))
        while len(rest):
            at[rest] = at[rest] + 1 & (1 << self.bits) - 1
            found = self.keys[at[rest]]
            hit = found == keys[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (found != -1)]
        return out


class SegmentTreeBpe:
    """Ranks of a vocabulary file (one base64 token and its rank per line)."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        self.tokens = {rank: token for token, rank in self.ranks.items()}

    def encode_piece(self, piece: str | bytes) -> list[int]:
        data = piece.encode() if isinstance(piece, str) else piece
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        if n < 2:
            return [ranks[data]] if n else []
        size = 1 << (n - 1).bit_length()
        rank_of = ranks.get
        level = [_NONE if (r := rank_of(data[i : i + 2])) is None else r << _SHIFT | i for i in range(n - 1)]
        level += [_NONE] * (size - n + 1)
        tree = level  # node k has the children 2k and 2k + 1, leaf i is node size + i
        while len(level) > 1:
            level = [a if a < b else b for a, b in zip(level[::2], level[1::2])]
            tree = level + tree
        tree.insert(0, _NONE)
        after = list(range(1, n + 1))  # the next live position
        before = list(range(-1, n - 1))
        while (best := tree[1]) != _NONE:
            i = best & _MASK
            gone = after[i]
            end = after[i] = after[gone]  # the merged token is data[i:end]
            tree[size + gone] = _NONE
            r = None
            if end < n:
                before[end] = i
                r = rank_of(data[i : after[end]])
            tree[size + i] = _NONE if r is None else r << _SHIFT | i
            left = before[i]
            if left >= 0:
                r = rank_of(data[left:end])
                tree[size + left] = _NONE if r is None else r << _SHIFT | left
                low = size + left >> 1
            else:
                low = size + i >> 1
            # up from the three leaves; paths that have met go on as one
            middle, high = size + i >> 1, size + gone >> 1
            while high:
                x, y = tree[2 * high], tree[2 * high + 1]
                tree[high] = x if x < y else y
                if middle != high:
                    x, y = tree[2 * middle], tree[2 * middle + 1]
                    tree[middle] = x if x < y else y
                if low != middle:
                    x, y = tree[2 * low], tree[2 * low + 1]
                    tree[low] = x if x < y else y
                low >>= 1
                middle >>= 1
                high >>= 1
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : after[i]]])
            i = after[i]
        return out

    @functools.cached_property
    def pairs(self) -> _Pairs:
        return _Pairs(self.ranks)

    @functools.cached_property
    def bytes(self) -> np.ndarray:
        return np.array([self.ranks[b"%c" % b] for b in range(256)], np.int64)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all pieces one after another, and the start and count of each piece's."""
        starts, counts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        short: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        ids: list[int] = []
        for k, piece in enumerate(pieces):
            data = piece.encode()
            if data in self.ranks or not 2 <= len(data) <= JOINT:
                found = self.encode_piece(data)
                starts[k], counts[k] = len(ids), len(found)
                ids += found
            else:
                short[1 << (len(data) - 1).bit_length()].append((k, data))
        flat, used = [np.array(ids, np.int64)], len(ids)
        for size, members in short.items():
            for at in range(0, len(members), _TREES):
                numbers, some = zip(*members[at : at + _TREES], strict=True)
                found, many = self._together(some, size)
                starts[[*numbers]], counts[[*numbers]] = used + np.cumsum(many) - many, many
                used += len(found)
                flat.append(found)
        return np.concatenate(flat), starts, counts

    def _together(self, pieces: tuple[bytes, ...], size: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of at most ``size`` bytes, and how many each has; row k of each array belongs to piece k."""
        m, place = len(pieces), np.arange(size)
        length = np.array([len(p) for p in pieces])
        token = self.bytes[np.frombuffer(b"".join([p.ljust(size, b"\0") for p in pieces]), np.uint8).reshape(m, size)]
        rank = self.pairs(token[:, :-1].reshape(-1), token[:, 1:].reshape(-1)).reshape(m, size - 1)
        tree = np.full((m, 2 * size), _NONE)  # node k has the children 2k and 2k + 1, leaf i is node size + i
        tree[:, size:-1] = np.where((rank >= 0) & (place[:-1] < length[:, None] - 1), rank << _SHIFT | place[:-1], _NONE)
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        live = place < length[:, None]
        after, before = np.tile(place + 1, (m, 1)), np.tile(place - 1, (m, 1))  # the next live position and the one before
        nodes, tokens, lives, nexts, lasts = (a.reshape(-1) for a in (tree, token, live, after, before))
        row = np.arange(m)
        while True:
            best = nodes[row * 2 * size + 1]
            row, best = row[best != _NONE], best[best != _NONE]
            if not len(row):
                break
            i, r = best & _MASK, best >> _SHIFT
            base, root = row * size, row * 2 * size
            gone = nexts[base + i]
            end = nexts[base + gone]  # the merged token ends before it
            nexts[base + i], tokens[base + i], lives[base + gone] = end, r, False
            inner = end < length[row]
            lasts[(base + end)[inner]] = i[inner]
            nodes[root + size + gone] = _NONE
            right = self.pairs(r, tokens[base + np.where(inner, end, i)])
            nodes[root + size + i] = np.where(inner & (right >= 0), right << _SHIFT | i, _NONE)
            left = lasts[base + i]
            has = np.flatnonzero(left >= 0)
            with_left = self.pairs(tokens[base[has] + left[has]], r[has])
            nodes[root[has] + size + left[has]] = np.where(with_left >= 0, with_left << _SHIFT | left[has], _NONE)
            low, middle, high = size + np.where(left >= 0, left, i), size + i, size + gone
            for _ in range(size.bit_length() - 1):
                low, middle, high = low >> 1, middle >> 1, high >> 1
                for node in (low, middle, high):
                    at = root + 2 * node
                    nodes[root + node] = np.minimum(nodes[at], nodes[at + 1])
        return token[live], live.sum(axis=1)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class DigestEncoder(SpacedEncoder):
    """A text's ids packed, and as decimal text with a space after each."""

    def __init__(self, bpe: SegmentTreeBpe) -> None:
        super().__init__(bpe.encode_piece, encode_pieces=bpe.encode_pieces)
        span = max(bpe.tokens, default=0) + 1
        self.decimals = pa.array([f"{i} " for i in range(span)], pa.large_binary())
        self.tokens = pa.array([bpe.tokens.get(i) for i in range(span)], pa.large_binary())

    def __call__(self, text: str) -> tuple[bytes, str]:
        data = super().__call__(text)
        return data, "".join([f"{i} " for i in words_le(data).tolist()])


def _bytes_of(table: pa.Array, ids: np.ndarray, ends: np.ndarray) -> tuple[memoryview, list[int]]:
    """The entries of ``ids`` in ``table`` one after another, and where each text's begin and end."""
    taken = table.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    return memoryview(data) if data else memoryview(b""), np.frombuffer(offsets, np.int64)[ends].tolist()


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> tuple[SegmentTreeBpe, DigestEncoder]:
    """Per worker."""
    bpe = SegmentTreeBpe(path)
    return bpe, DigestEncoder(bpe)


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text, without special tokens."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, enc = _encoder(path)
        for batch in batches:
            for doc, text in rows_of(batch, "doc_id", "text"):
                ids = words_le(enc(text)[0]).astype("int32")
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids))], schema=schema)

    return _input(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, data): the bytes of each list of ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = _encoder(path)
        for batch in batches:
            for doc, ids in rows_of(batch, "doc_id", "ids"):
                yield emit(schema, [[doc], [bpe.decode(ids or [])]])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, decode its ids, and return the digests of both: one
    map over the documents, nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, enc = _encoder(path)

        def digests(table: pa.Array, ids: np.ndarray, ends: np.ndarray, skip: int) -> list[str]:
            data, at = _bytes_of(table, ids, ends)
            return [hashlib.sha256(data[a : max(a, b - skip)]).hexdigest() for a, b in zip(at, at[1:])]

        for batch in batches:
            doc_ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
            ids, ends = enc.batch(texts)
            yield emit(_DIGEST, [doc_ids, np.diff(ends), digests(enc.decimals, ids, ends, 1), digests(enc.tokens, ids, ends, 0)])

    return _input(docs, id_col, text_col).mapInArrow(uncollected(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
