"""Operator 2: hierarchical multi-length packing of token sequences.

Every document becomes its token ids and one end id. Documents are routed to the smallest context tier that holds them
(longer ones give full windows of the largest tier first, and their rest is routed). Tiers are packed from long to
short: a window starts with a document of its own tier and its gap is filled from shorter tiers, best fit first, the
last gap by cutting a shorter document (or the next one of the tier if the shorter tiers are empty). What is left at
the end of a partition is laid out in windows of falling powers of two. So windows are full at a power of two and need
no padding. Windows of a tier are dealt to step groups of equal token budget, balanced by attention cost.

Packing is local to a partition and goes block by block, so there is no shuffle, memory is bounded by a block, and a
task that runs again gives the same sequences.

Defined results: null or empty text is the end id alone; a document longer than a window is cut; repeated rows are
packed once each; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import code_points, ragged, slices, trim, utf8
from .pretokens import SPECIAL, Cache, starts

TIERS = (256, 512, 1024, 2048)
BLOCK_TOKENS = 1 << 21


class Encoder:
    """Token ids by the tokenizers library; ids of pre-tokens seen before come from a bounded cache."""

    ARENA = 1 << 22

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.reset()

    def reset(self) -> None:
        self.cache = Cache(20)
        self.ids, self.used = np.zeros(self.ARENA, np.int32), 0
        self.offset, self.size, self.words = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int32), 0

    def _compute(self, words: list[str]) -> np.ndarray:
        encoded = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, encoded), np.int32, len(encoded))
        flat = np.fromiter((i for e in encoded for i in e), np.int32, int(sizes.sum()))
        a, b = self.words, self.words + len(words)
        while b > len(self.size):
            self.offset, self.size = np.resize(self.offset, 2 * len(self.offset)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.used : self.used + len(flat)] = flat
        self.size[a:b] = sizes
        self.offset[a:b] = self.used + np.cumsum(sizes) - sizes
        self.words, self.used = b, self.used + len(flat)
        return np.arange(a, b, dtype=np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts in them)."""
        if self.used > self.ARENA // 2 or self.words > 1 << 19:
            self.reset()
        text, cps, at = code_points(data, offsets)
        n = len(at) - 1
        if SPECIAL in text:  # rare: such a batch goes to the library as it is
            each = [e.ids for e in self.library.encode_batch([text[at[i] : at[i + 1]] for i in range(n)], add_special_tokens=False)]
            return np.array([i for e in each for i in e], np.int32), np.concatenate([[0], np.cumsum([len(e) for e in each])]).astype(np.int64)
        begin = starts(cps, at)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        value = self.cache.lookup(text, cps, begin, np.diff(np.append(begin, len(cps))), self._compute)
        sizes = self.size[value].astype(np.int64)
        run = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[ragged(self.offset[value], sizes)], run[np.searchsorted(begin, at)]


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Pool:
    """Pieces (document, start, length) kept in order of length; best fit takes the longest that fits."""

    def __init__(self):
        self.rows: list[tuple[int, int, int]] = []  # (length, document, start)

    def add(self, length: int, doc: int, start: int) -> None:
        insort(self.rows, (length, doc, start))

    def fit(self, room: int):
        at = bisect_right(self.rows, (room, 1 << 62, 0))
        return self.rows.pop(at - 1) if at else None

    def longest(self):
        return self.rows.pop() if self.rows else None


def pack_block(lengths: np.ndarray, tiers: tuple[int, ...], rest: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length); each is full at its tier, or at a smaller power of two for the last rest."""
    top = tiers[-1]
    windows = [[(d, s, top)] for d in np.flatnonzero(lengths >= top).tolist() for s in range(0, int(lengths[d]) // top * top, top)]
    tail = lengths % top
    pools = [Pool() for _ in tiers]
    tier_of = np.searchsorted(np.array(tiers), tail)
    order = np.flatnonzero(tail > 0)
    order = order[np.lexsort((order, tail[order]))]
    for d in order.tolist():
        pools[tier_of[d]].rows.append((int(tail[d]), d, int(lengths[d] - tail[d])))

    def route(length: int, doc: int, start: int) -> None:
        pools[int(np.searchsorted(tiers, length))].add(length, doc, start)

    for k in range(len(tiers) - 1, -1, -1):
        size = tiers[k]
        while sum(1 for p in pools[: k + 1] if p.rows) and pools[k].rows:
            length, doc, start = pools[k].longest()
            window, room = [(doc, start, length)], size - length
            while room:
                got = next((g for p in reversed(pools[:k]) if (g := p.fit(room))), None)
                if got is None:  # nothing fits whole: cut a shorter document, or else the next of this tier
                    got = next((g for p in pools[: k + 1] if (g := p.longest())), None)
                    if got is None:
                        break
                    if got[0] > room:
                        route(got[0] - room, got[1], got[2] + room)
                        got = (room, got[1], got[2])
                window.append((got[1], got[2], got[0]))
                room -= got[0]
            if not room:
                windows.append(window)
                continue
            total, part = size - room, 1  # the rest of the block: windows of falling powers of two
            queue = window[::-1]
            while total:
                part = 1 << (total.bit_length() - 1)
                out, need = [], part
                while need:
                    doc, start, length = queue.pop()
                    take = min(need, length)
                    out.append((doc, start, take))
                    if length > take:
                        queue.append((doc, start + take, length - take))
                    need -= take
                windows.append(out)
                total -= part
    return windows


def step_groups(windows: list[list[tuple[int, int, int]]], budget: int) -> list[int]:
    """A group for each window: windows of one size, about budget tokens a group, attention cost dealt in snake order."""
    sizes = [sum(p[2] for p in w) for w in windows]
    cost = [sum(p[2] ** 2 for p in w) for w in windows]
    out, used = [0] * len(windows), 0
    for size in sorted(set(sizes), reverse=True):
        own = sorted((i for i, s in enumerate(sizes) if s == size), key=lambda i: (-cost[i], i))
        groups = max(1, -(-len(own) * size // budget))
        for nth, i in enumerate(own):
            lap, at = divmod(nth, groups)
            out[i] = used + (at if lap % 2 == 0 else groups - 1 - at)
        used += groups
    return out


def pack(docs: DataFrame, path: str, *, text: str = "text", doc_id: str = "doc_id", tiers: tuple[int, ...] = TIERS, end_id: int = 1, step_tokens: int = 32768, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, tier, step_group (and ids)."""
    inner = docs.select(docs[doc_id].alias("d"), docs[text].cast("string").alias("t"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "tier", "step_group"]
    schema = T.StructType([T.StructField("d", inner.schema[0].dataType), *[T.StructField(c, T.LongType()) for c in names]] + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)
    tier_array = np.array(tiers)

    def emit(ids_, ends, who, counters, base):
        ids = np.concatenate(ids_)
        off = np.concatenate([[0], np.cumsum(np.concatenate(ends))])
        lengths = np.diff(off)
        windows = pack_block(lengths, tiers)
        groups = step_groups(windows, step_tokens)
        raw = memoryview(ids.astype("<u4").tobytes())
        doc, start, size, crc, seq, at, total, group, parts = [], [], [], [], [], [], [], [], []
        for k, w in enumerate(windows):
            here, whole = 0, sum(p[2] for p in w)
            for d, s, n in w:
                a = int(off[d]) + s
                doc.append(d)
                start.append(s)
                size.append(n)
                crc.append(zlib.crc32(raw[4 * a : 4 * (a + n)]))
                seq.append(base + counters[0] + k)
                at.append(here)
                total.append(whole)
                group.append(base + counters[1] + groups[k])
                if with_ids:
                    parts.append(ids[a : a + n])
                here += n
        counters[0] += len(windows)
        counters[1] += max(groups, default=-1) + 1
        doc = np.array(doc, np.int64)
        total = np.array(total, np.int64)
        tier = tier_array[np.minimum(np.searchsorted(tier_array, total), len(tiers) - 1)]
        cols = [pa.concat_arrays(who).take(pa.array(doc)), *[pa.array(np.array(c, np.int64)) for c in (start, size, crc, lengths[doc], seq, at, total, tier, group)]]
        if with_ids:
            cols.append(pa.array(parts, pa.list_(pa.int32())))
        for i in range(0, len(doc), 1 << 16):
            yield pa.RecordBatch.from_arrays([c[i : i + (1 << 16)] for c in cols], [f.name for f in schema.fields])

    def run(batches):
        encoder, counters, base = _encoder(path), [0, 0], TaskContext.get().partitionId() << 40
        held = ([], [], [])
        tokens = 0
        for rb in slices(batches, "t", 1 << 19):
            data, offsets = utf8(rb.column(1))
            ids, at = encoder.encode(data, offsets)
            n = np.diff(at) + 1
            out = np.full(int(n.sum()), end_id, np.int32)
            keep = np.ones(len(out), bool)
            keep[np.cumsum(n) - 1] = False
            out[keep] = ids
            held[0].append(out)
            held[1].append(n)
            held[2].append(rb.column(0))
            tokens += len(out)
            if tokens >= BLOCK_TOKENS:
                yield from emit(*held, counters, base)
                held, tokens = ([], [], []), 0
        if held[0]:
            yield from emit(*held, counters, base)
        # the worker lives on for other stages: nothing of this one stays in it
        _encoder.cache_clear()
        encoder = held = None
        trim()

    out = inner.mapInArrow(run, schema)
    return out.withColumnRenamed("d", doc_id)
