"""Vectorised pre-tokenisation of byte-level BPE, and a direct-mapped cache from pre-token hash to its tokens.

The public pattern is: contractions | optional space and letters | optional space and digits | optional space and
others | white space not before a non-space | white space. Here it is evaluated on arrays of character classes.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

SPECIAL = "<|endoftext|>"
LONGEST = 64  # longer pre-tokens are looked up by their text, not by a hash
SPACE, LETTER, DIGIT, OTHER = range(4)
# Unicode White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BASE = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = LETTER
        elif kind == "N":
            out[i] = DIGIT
    out[WHITE_SPACE] = SPACE
    return out


def starts(cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start positions of the pre-tokens of the texts cps[offsets[i]:offsets[i+1]]."""
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    cls = classes()[cps]
    first = np.zeros(n + 2, bool)  # starts of texts, and the ends of the last
    first[offsets] = True
    tok = first[: n + 2].copy()
    tok[1:n] |= cls[1:] != cls[:-1]
    space = np.zeros(n + 1, bool)
    space[:n] = cls == SPACE
    last = np.flatnonzero(space[:n] & ~space[1:] & ~first[1 : n + 1])  # last white space before a non-space
    tok[last] = True
    tok[last[cps[last] == 0x20] + 1] = False
    mark = np.flatnonzero((cps == 0x27) & tok[:n])
    if len(mark):
        padded = np.append(cps, np.zeros(3, np.uint32))
        one, two = padded[mark + 1], padded[mark + 2]
        in1, in2 = ~first[mark + 1], ~first[mark + 1] & ~first[mark + 2]
        short = in1 & ((one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d")))
        long = in2 & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        tok[mark[short] + 1] = tok[mark[long] + 1] = False
        tok[mark[short] + 2] = tok[mark[long] + 3 if len(mark) else mark] = True
    return np.flatnonzero(tok[:n])


class Hasher:
    """64-bit polynomial hashes of substrings from one running sum."""

    def __init__(self):
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, cps: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n = len(cps)
        if n >= len(self.power):
            with np.errstate(over="ignore"):
                self.power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n + n // 4 + 1024, BASE, np.uint64))])
                self.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n + n // 4 + 1024, np.uint64(pow(int(BASE), -1, 1 << 64)), np.uint64))])
        with np.errstate(over="ignore"):
            run = np.zeros(n + 1, np.uint64)
            value = (cps.astype(np.uint64) + np.uint64(0x5851F42D)) * np.uint64(0xD6E8FEB86659FD93)
            value ^= value >> np.uint64(29)
            np.cumsum(value * self.power[:n], out=run[1:])
            h = (run[at + lengths] - run[at]) * self.inverse[at]
            h ^= lengths.astype(np.uint64) << np.uint64(56)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return h ^ (h >> np.uint64(29))


class Cache:
    """Direct-mapped: a slot holds one hash and one value; a clash only costs a new computation. Memory is fixed."""

    def __init__(self, bits: int = 21):
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.zeros(1 << bits, np.int32)
        self.hash = Hasher()

    def clear(self) -> None:
        self.keys[:] = 0

    def lookup(self, text: str, cps: np.ndarray, at: np.ndarray, lengths: np.ndarray, compute) -> np.ndarray:
        """Values of the pre-tokens; compute(list of distinct strings) -> int32 values of those not cached."""
        h = self.hash(cps, at, lengths)
        h[h == 0] = 1
        long = np.flatnonzero(lengths > LONGEST)
        slot = (h >> self.shift).astype(np.int64)
        out = self.values[slot]
        miss = self.keys[slot] != h
        miss[long] = False
        miss = np.flatnonzero(miss)
        if len(miss):
            fresh, where, back = np.unique(h[miss], return_index=True, return_inverse=True)
            where = miss[where]
            a, b = at[where].tolist(), (at[where] + lengths[where]).tolist()
            got = compute([text[i:j] for i, j in zip(a, b)])
            out[miss] = got[back]
            slot = (fresh >> self.shift).astype(np.int64)
            self.keys[slot], self.values[slot] = fresh, got
        if len(long):
            words = [text[at[i] : at[i] + lengths[i]] for i in long.tolist()]
            distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
            got = compute(list(distinct))
            out[long] = got[[distinct[w] for w in words]]
        return out
