"""An FM-index over integer symbols: a wavelet matrix of the BWT with rank
directories, and capped matching statistics of many patterns at once."""

from __future__ import annotations

import numpy as np


class RankBits:
    """A bit vector with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray) -> None:
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words)[:-1], dtype=np.int32))).astype(np.int32)
        self.ones = int(bits.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, inside = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Rank of any symbol in a sequence, one bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, alphabet: int) -> None:
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.levels: list[tuple[RankBits, int]] = []
        rest, places = symbols, np.arange(alphabet)
        start = np.zeros(alphabet, np.int64)  # where each symbol's block begins at the bottom
        for b in range(self.bits - 1, -1, -1):
            bit = (rest >> b & 1).astype(bool)
            level = RankBits(bit)
            zeros = len(bit) - level.ones
            self.levels.append((level, zeros))
            one = (places >> b & 1).astype(bool)
            r = level.rank(start)
            start = np.where(one, zeros + r, start - r)
            rest = np.concatenate((rest[~bit], rest[bit]))
        self.start = start

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        for k, (level, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            r = level.rank(at)
            at = np.where(one, zeros + r, at - r)
        return at - self.start[symbol]


class FmIndex:
    """Index of a text of symbols 1..; 0 separates its parts.

    Suffixes are sorted by their first ``depth`` + 1 symbols or more, which is
    enough for patterns of up to so many: an interval's bounds depend on no
    symbol beyond the pattern's length. Kept are the wavelet
    matrix of the BWT, the symbols' counts, and for each suffix-array interval
    that shares ``depth`` symbols its end and its first place in the text; the
    text and the suffix array are not needed any more.
    """

    def __init__(self, text: np.ndarray, depth: int) -> None:
        n = len(text)
        self.depth = depth
        alphabet = int(text.max()) + 1
        covered = max(1, min(62 // alphabet.bit_length(), depth))  # symbols that fit in one number
        packed = np.zeros(n, np.int64)
        for j in range(covered):
            packed *= alphabet
            packed[: n - j] += text[j:]
        rank = np.unique(packed, return_inverse=True)[1].reshape(-1)
        of_depth = rank if covered == depth else None
        while covered <= depth:
            if of_depth is None and depth <= 2 * covered:  # the first ``depth`` symbols, from two overlapping halves
                of_depth = _pair(rank, depth - covered)
            rank = _pair(rank, covered)
            covered *= 2
        order = np.argsort(rank, kind="stable")
        group = of_depth[order]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        self.group = (np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))).astype(np.int32)
        self.lo, self.hi = first, np.append(first[1:], n)
        self.first_place = np.minimum.reduceat(order, first)
        counts = np.bincount(text, minlength=alphabet)
        self.below = np.concatenate(([0], np.cumsum(counts)[:-1]))
        self.size = n
        self.bwt = WaveletMatrix(text[order - 1], alphabet)  # place -1 is the last separator

    def statistics(self, patterns: list[np.ndarray] | tuple[np.ndarray, np.ndarray, np.ndarray]):
        """Yield (pattern numbers, offset from the end, first places) for all
        patterns whose ``depth`` symbols from there on occur in the text.

        patterns: (symbols, starts, lengths). All go right to left together,
        one symbol a step. Each keeps the interval of its longest match of at
        most ``depth`` symbols; one that can't go on is shortened at its right end.
        """
        symbols, starts, lengths = patterns
        order = np.argsort(-lengths, kind="stable")
        ends, sizes = (starts + lengths)[order], lengths[order]
        lo, hi, got = np.zeros(len(order), np.int64), np.full(len(order), self.size, np.int64), np.zeros(len(order), np.int64)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -step, side="left"))  # those longer than step
            c = symbols[ends[:live] - 1 - step]
            a, b = self._extended(c, lo[:live], hi[:live])
            lost = a >= b
            got[:live] += 1
            if lost.any():
                a[lost], b[lost], got[:live][lost] = self._longest(symbols, (ends[:live] - 1 - step)[lost], got[:live][lost] - 1)
            over = got[:live] > self.depth
            g = self.group[np.minimum(a, self.size - 1)]  # of matches of less than depth symbols it has no use
            a, b = np.where(over, self.lo[g], a), np.where(over, self.hi[g], b)
            got[:live][over] = self.depth
            lo[:live], hi[:live] = a, b
            full = np.flatnonzero(got[:live] >= self.depth)
            if len(full):
                yield order[full], step + 1, self.first_place[g[full]]

    def _interval(self, symbols: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array intervals of symbols[begin : begin + length], by backward search."""
        lo, hi = np.zeros(len(begins), np.int64), np.full(len(begins), self.size, np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((step < lengths) & (lo < hi))
            c = symbols[(begins + lengths - 1 - step)[live]]
            lo[live], hi[live] = self._extended(c, lo[live], hi[live])
        return lo, hi

    def _extended(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with symbol c before them."""
        both = self.bwt.rank(np.concatenate((c, c)), np.concatenate((lo, hi)))
        return self.below[c] + both[: len(c)], self.below[c] + both[len(c) :]

    def _longest(self, symbols: np.ndarray, begins: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval and length of the longest match from each place, of at most
        ``most`` symbols: halving, as every beginning of a match is one."""
        known, bound = np.zeros_like(most), most.copy()
        while (known < bound).any():
            middle = (known + bound + 1) // 2
            lo, hi = self._interval(symbols, begins, middle)
            found = lo < hi
            known, bound = np.where(found, middle, known), np.where(found, bound, middle - 1)
        return *self._interval(symbols, begins, known), known


def _pair(rank: np.ndarray, shift: int) -> np.ndarray:
    """Ranks of (rank at i, rank at i + shift); beyond the end counts as least."""
    other = np.zeros_like(rank)
    if shift < len(rank):
        other[: len(rank) - shift] = rank[shift:] + 1
    key = rank * (int(other.max()) + 1) + other
    return np.unique(key, return_inverse=True)[1].reshape(-1)
