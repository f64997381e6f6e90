"""An FM-index over integer symbols, in numpy: suffix array, wavelet matrix, sampled places."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``s`` in order, by doubling; a suffix that ends comes before longer ones."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k if k < n else 0] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key)
        key = key[order]
        step = np.empty(n, np.int64)
        step[0] = 0
        step[1:] = key[1:] != key[:-1]
        np.cumsum(step, out=step)
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1 or k >= n:
            return order
        k *= 2


class BitRank:
    """Bits with counts of the ones before any place."""

    def __init__(self, bits: np.ndarray):
        pad = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        pad[: len(bits)] = bits
        self.words = np.packbits(pad, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def ones(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Rank of any symbol before any place, and the symbol there, bit by bit from the top."""

    def __init__(self, s: np.ndarray, symbols: int):
        self.depth = max(1, int(symbols - 1).bit_length())
        self.levels, self.zeros = [], []
        for b in range(self.depth - 1, -1, -1):
            bit = (s >> b) & 1
            self.levels.append(BitRank(bit.astype(np.uint8)))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate([s[bit == 0], s[bit == 1]])

    def rank(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of c before lo and before hi, as the places they map to in the last level's order."""
        start = np.zeros_like(lo)
        for level, zeros, b in zip(self.levels, self.zeros, range(self.depth - 1, -1, -1), strict=True):
            one = ((c >> b) & 1).astype(bool)
            l1, h1, s1 = level.ones(lo), level.ones(hi), level.ones(start)
            lo = np.where(one, zeros + l1, lo - l1)
            hi = np.where(one, zeros + h1, hi - h1)
            start = np.where(one, zeros + s1, start - s1)
        return lo - start, hi - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and its rank before i."""
        c, start = np.zeros_like(i), np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            bit = level.at(i)
            l1, s1 = level.ones(i), level.ones(start)
            i = np.where(bit == 1, zeros + l1, i - l1)
            start = np.where(bit == 1, zeros + s1, start - s1)
            c = (c << 1) | bit
        return c, i - start


class FMIndex:
    """Backward search and location over ``text``, whose symbols are from 1 to ``symbols`` - 1; 0 ends it."""

    def __init__(self, text: np.ndarray, symbols: int):
        s = np.concatenate([text.astype(np.int64), [0]])
        sa = suffix_array(s)
        self.bwt = WaveletMatrix(s[sa - 1], symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
        kept = (sa % SAMPLE == 0).astype(np.uint8)
        self.marked, self.samples, self.n = BitRank(kept), sa[kept == 1], len(s)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges lo..hi of the suffixes that begin with each row of ``phrases`` (all of one length)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            if not len(live):
                break
            c = phrases[live, j]
            a, b = self.bwt.rank(c, lo[live], hi[live])
            lo[live], hi[live] = self.first[c] + a, self.first[c] + b
            gone = lo[live] >= hi[live]
            hi[live[gone]] = lo[live[gone]]
            live = live[~gone]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes at ``rows``: steps back to the next sampled one."""
        out, steps, at, open_ = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy(), np.arange(len(rows))
        while len(open_):
            here = at[open_]
            hit = self.marked.at(here) == 1
            done = open_[hit]
            out[done] = self.samples[self.marked.ones(here[hit])] + steps[done]
            open_ = open_[~hit]
            c, r = self.bwt.access(at[open_])
            at[open_] = self.first[c] + r
            steps[open_] += 1
        return out
