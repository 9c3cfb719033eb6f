"""An FM-index over a sequence of small integers, vectorised over its queries."""

from __future__ import annotations

import numpy as np

#: Text positions between two sampled suffixes.
SAMPLE = 8
#: Longest sequence: three ranks fit into one sort key.
LONGEST = 1 << 21


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffixes of ``s`` in order. Zeros are separators: each is its own symbol, less than all others, by position.

    The sequence ends in a separator. Ranks by d symbols give ranks by 3 d
    symbols; after the first sort only suffixes that still share a rank are
    sorted again, and none is compared beyond a separator.
    """
    n = len(s)
    if n > LONGEST - 2:
        raise ValueError("sequence too long for one index")
    zero = s == 0
    zeros = int(zero.sum())
    rank = np.where(zero, np.cumsum(zero) - 1, 0).astype(np.int64)
    if zeros < n:
        counted = np.bincount(s)
        counted[0] = 0
        rank[~zero] = (zeros + np.cumsum(counted) - counted)[s[~zero]]
    order, slots, depth = np.arange(n), np.arange(n), 1
    while len(slots):
        own = order[slots]
        key = (rank[own] << 42) | (rank[np.minimum(own + depth, n - 1)] << 21) | rank[np.minimum(own + 2 * depth, n - 1)]
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[slots] = own
        new = np.ones(len(key), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        rank[own] = slots[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots = slots[~alone]
        depth *= 3
    return order


class Bits:
    """A bit vector with constant-time rank: 64-bit words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        word, below = i >> 6, (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """A wavelet tree in levels, highest bit first, zeros of a level before its ones."""

    def __init__(self, s: np.ndarray, most: int):
        self.depth = max(1, int(most).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for bit in range(self.depth - 1, -1, -1):
            ones = (s >> bit) & 1 == 1
            left = s[~ones]
            self.levels.append((Bits(ones), len(left)))
            s = np.concatenate([left, s[ones]])

    def descend(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where position i ends on the way to symbol c."""
        for k, (bits, zeros) in enumerate(self.levels):
            ones = bits.rank(i)
            i = np.where((c >> (self.depth - 1 - k)) & 1 == 1, zeros + ones, i - ones)
        return i

    def read(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at position i, and where i ends on the way to it."""
        c = np.zeros(len(i), np.int64)
        for bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            c = (c << 1) | one
            i = np.where(one, zeros + ones, i - ones)
        return c, i


class FMIndex:
    """Counts and locates patterns of symbols 1 .. ``most`` in ``s``, whose zeros are separators."""

    def __init__(self, s: np.ndarray, most: int):
        order = suffix_array(s)
        bwt = s[order - 1]  # before position 0 stands the last separator
        counted = np.bincount(s, minlength=most + 1)
        self.n = len(s)
        self.first = np.cumsum(counted) - counted
        self.tree = Wavelet(bwt, most)
        every = np.arange(most + 1)
        self.start = self.tree.descend(every, np.zeros(most + 1, np.int64))
        # A walk back from any suffix meets a sample before it would cross a separator.
        sampled = (order % SAMPLE == 0) | (bwt == 0)
        self.sampled, self.positions = Bits(sampled), order[sampled]

    def _step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        return self.first[c] + self.tree.descend(c, i) - self.start[c]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of equally long patterns, one a row: the range of suffixes that begin with each."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for c in patterns.T[::-1]:
            c = c[alive].astype(np.int64)
            low[alive], high[alive] = self._step(c, low[alive]), self._step(c, high[alive])
            alive = alive[low[alive] < high[alive]]
        found = np.zeros(len(patterns), bool)
        found[alive] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes in ``rows``."""
        out, at, back = np.zeros(len(rows), np.int64), rows.astype(np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            hit = self.sampled.get(at[open_])
            done = open_[hit]
            out[done] = self.positions[self.sampled.rank(at[done])] + back[done]
            open_ = open_[~hit]
            c, i = self.tree.read(at[open_])
            at[open_] = self.first[c] + i - self.start[c]
            back[open_] += 1
        return out
