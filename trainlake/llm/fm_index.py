"""FM-index over an integer text of separated segments: suffix order, wavelet-tree ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


class Bits:
    """A bit vector with constant-time ranks."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & ONE

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        mask = (ONE << (i & 63).astype(np.uint64)) - ONE
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)


class Wavelet:
    """A wavelet tree laid out by levels (all nodes of a level in one bit vector)."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.depth = max(1, int(symbols - 1).bit_length())
        for k in range(self.depth - 1, -1, -1):
            bit = ((text >> k) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(text) - bit.sum()))
            text = np.concatenate([text[~bit], text[bit]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c[k] before position i[k]."""
        base = np.zeros_like(i)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            bit = ((c >> (self.depth - 1 - k)) & 1).astype(bool)
            up, low = level.ones(i), level.ones(base)
            i, base = np.where(bit, zeros + up, i - up), np.where(bit, zeros + low, base - low)
        return i - base

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at i, its occurrences before i)."""
        base, c = np.zeros_like(i), np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros):
            bit = level.get(i).astype(bool)
            up, low = level.ones(i), level.ones(base)
            i, base = np.where(bit, zeros + up, i - up), np.where(bit, zeros + low, base - low)
            c = 2 * c + bit
        return c, i - base


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling. Zeros are separators, each smaller than all symbols and different from the others, so that equal runs end there."""
    n = len(text)
    sep = text == 0
    rank = text.astype(np.int64) + int(sep.sum())
    rank[sep] = np.arange(int(sep.sum()))
    step = 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(key)
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Of text (symbols 1 and up; 0 ends every segment)."""

    def __init__(self, text: np.ndarray, symbols: int, sample: int = 8):
        order = suffix_order(text)
        self.n = len(text)
        self.wavelet = Wavelet(text[order - 1], symbols)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])[:symbols]
        # positions are kept at every sample-th place and at the start of each segment, where the walk must end
        kept = (order % sample == 0) | (text[order - 1] == 0)
        self.kept, self.positions = Bits(kept), order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of patterns[k, :lengths[k]] for all k at once: suffix ranges [low, high)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        at = lengths.astype(np.int64) - 1
        while len(live):
            c = patterns[live, at[live]]
            low[live] = self.first[c] + self.wavelet.rank(c, low[live])
            high[live] = self.first[c] + self.wavelet.rank(c, high[live])
            at[live] -= 1
            live = live[(at[live] >= 0) & (low[live] < high[live])]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix order, by walking back to kept positions."""
        out, steps = np.zeros(len(rows), np.int64), 0
        live, row = np.arange(len(rows)), rows.astype(np.int64)
        while len(live):
            known = self.kept.get(row).astype(bool)
            out[live[known]] = self.positions[self.kept.ones(row[known])] + steps
            live, row = live[~known], row[~known]
            if len(live):
                c, before = self.wavelet.access(row)
                row, steps = self.first[c] + before, steps + 1
        return out
