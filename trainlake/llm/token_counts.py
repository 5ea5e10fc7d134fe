"""Operator 10: token counts by rank-synchronous array merging.

The distinct pre-tokens of a batch are held as one ragged numpy array of symbols. In each step every sequence merges
all (non-overlapping, leftmost first) occurrences of its lowest-rank pair at the same time; the symbols that survive
are its tokens. Counts of pre-tokens already seen come from a fixed-size direct-mapped cache.

Defined results: null or empty text has 0 bytes and 0 tokens; the special string inside a text is one token and the
text before and after it is split on its own (the library's default); repeated rows give equal counts; other columns
of the input, whatever their names, are not read unless listed in `keep`.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import code_points, slices, utf8
from .pretokens import SPECIAL, Cache, starts

NO_PAIR = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: itself if visible, else the next from U+0100."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class Merger:
    """Merges of a byte-level BPE file, applied to ragged arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, self.size = model["vocab"], len(model["vocab"]) + 1
        self.byte_id = np.array([vocab[c] for c in byte_letters()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        order = np.argsort(key, kind="stable")
        self.keys, self.rank_of = key[order], order.astype(np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], NO_PAIR)

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words, number of tokens of each word); words must not be empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        ids: list[np.ndarray] = [np.zeros(0, np.int64)]
        whose: list[np.ndarray] = [np.zeros(0, np.int64)]
        word = np.arange(len(words))  # of each active sequence
        seq = np.repeat(word, lengths)
        counts = np.zeros(len(words), np.int64)
        rank = np.full(len(sym), NO_PAIR, np.int32)
        if len(sym) > 1:
            rank[:-1] = np.where(seq[:-1] == seq[1:], self.ranks(sym[:-1], sym[1:]), NO_PAIR)
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seq[1:] != seq[:-1]]))
            size = np.diff(np.append(first, len(seq)))
            best = np.minimum.reduceat(rank, first)
            done = best == NO_PAIR
            if done.any():
                gone = np.repeat(done, size)
                counts[seq[first[done]]] = size[done]
                ids.append(sym[gone])
                whose.append(seq[gone])
                stay = ~gone
                sym, seq, rank = sym[stay], seq[stay], rank[stay]
                best, size = best[~done], size[~done]
                if not len(sym):
                    break
            lowest = np.repeat(best, size)
            hit = rank == lowest
            at = np.flatnonzero(hit)
            touching = np.flatnonzero(at[1:] == at[:-1] + 1) + 1
            if len(touching):  # runs such as aaaa: every second pair
                head = np.ones(len(at), bool)
                head[touching] = False
                run = np.flatnonzero(head)
                nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
                at = at[nth % 2 == 0]
            sym[at] = self.made[lowest[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new = (np.cumsum(keep) - 1)[at]
            sym, seq, rank = sym[keep], seq[keep], rank[keep]
            for p in (new, new[new > 0] - 1):
                q = np.minimum(p + 1, len(sym) - 1)
                rank[p] = np.where((q > p) & (seq[p] == seq[q]), self.ranks(sym[p], sym[q]), NO_PAIR)
        ids_, whose_ = np.concatenate(ids), np.concatenate(whose)
        return ids_[np.argsort(whose_, kind="stable")], counts

    def counts(self, words: list[str]) -> np.ndarray:
        return self.symbols([w.encode("utf-8") for w in words])[1].astype(np.int32)


@functools.cache
def _worker(path: str) -> tuple[Merger, Cache]:
    return Merger(path), Cache()


def split_special(text: str, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """(text without special strings, offsets of its segments, text of each segment, special strings of each text)."""
    n = len(offsets) - 1
    if SPECIAL not in text:
        return text, offsets, np.arange(n), np.zeros(n, np.int64)
    parts, ends, owner, special = [], [0], [], np.zeros(n, np.int64)
    for i in range(n):
        own = text[offsets[i] : offsets[i + 1]].split(SPECIAL)
        special[i] = len(own) - 1
        for p in own:
            parts.append(p)
            ends.append(ends[-1] + len(p))
            owner.append(i)
    return "".join(parts), np.array(ends, np.int64), np.array(owner, np.int64), special


def count_batch(data: np.ndarray, offsets: np.ndarray, path: str) -> np.ndarray:
    merger, cache = _worker(path)
    text, cps, at = code_points(data, offsets)
    text, segments, owner, special = split_special(text, at)
    if special.any():
        cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begin = starts(cps, segments)
    if not len(begin):
        return special
    lengths = np.diff(np.append(begin, len(cps)))
    value = cache.lookup(text, cps, begin, lengths, merger.counts)
    run = np.concatenate([[0], np.cumsum(value.astype(np.int64))])
    edge = np.searchsorted(begin, segments)
    per = run[edge[1:]] - run[edge[:-1]]
    return special + np.bincount(owner, per, minlength=len(special)).astype(np.int64)


def token_counts(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 512) -> DataFrame:
    """keep columns, n_bytes, n_tokens, over_limit of every row; no shuffle."""
    from pyspark.sql import types as T

    inner = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].cast("string").alias("t"))
    schema = T.StructType([*inner.schema.fields[:-1], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches):
        for rb in slices(batches, "t"):
            data, offsets = utf8(rb.column(len(keep)))
            n = count_batch(data, offsets, path)
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(np.diff(offsets)), pa.array(n.astype(np.int64))], [*rb.schema.names[:-1], "n_bytes", "n_tokens"])

    out = inner.mapInArrow(run, schema)
    return out.select(*[out[f"k{i}"].alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens", (out.n_tokens > limit).alias("over_limit"))
