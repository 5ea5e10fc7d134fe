"""Operator 9: benchmark decontamination with an FM-index for each training shard.

A shard is a byte-bounded run of whole documents of one partition. Its text is the sequence of word numbers in the test
vocabulary; words outside it can be in no test phrase and end a segment, and so does the end of a document. Segments
shorter than the shortest test phrase hold no phrase and are left out of the index (that loses nothing). All windows of
the test items are searched backwards at once through wavelet-tree ranks, located by sampled suffix positions, and the
located spans of a document are merged. There is no shuffle: a document lies in one shard.

Test phrases are sent to the tasks in blocks of a checked size. A task searches each shard for one block after the other
and merges the spans, so a document gives one row whatever the number of blocks.

Defined results: null text has no words; a document or item without words has no hits; an item of fewer than `width`
words is one window; equal items are all named, an id that stands in several rows once; items without an id or with null text are left out; an empty test set
leaves all documents clean. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ragged, slices, utf8
from .fm_index import FMIndex
from .pretokens import Hasher

#: Bytes of test text that one block of phrases may hold (some 350,000 windows, about 150 MB while they are numbered); larger
#: test sets are searched block by block.
BLOCK_BYTES = 2 << 20
#: Bytes of documents that are indexed together.
SHARD_BYTES = 4 << 20

# word bytes: 0-9, a-z (after A-Z are lowered) and every byte of a character from U+0080
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def words(data: np.ndarray, offsets: np.ndarray, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of the first word of each text and the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = FOLD[data]
    inside = np.zeros(n + 1, bool)
    inside[:n] = WORD[low]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begin = inside[:n] & (cut[:n] | ~np.concatenate([[False], inside[: n - 1]]))
    end = inside[:n] & (cut[1:] | ~inside[1:])
    at, to = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return hasher(low, at, to - at), np.searchsorted(at, offsets)


class Phrases:
    """The windows of a block of test items (an id that occurs in several rows is one item)."""

    def __init__(self, ids: list, texts: list[str], width: int):
        self.width = width
        self.ids = sorted(set(ids))
        place = {x: i for i, x in enumerate(self.ids)}
        h, at = words(*utf8(pa.array(texts, pa.string())), Hasher())
        self.vocabulary = np.unique(h)
        number = np.searchsorted(self.vocabulary, h) + 1
        rows: dict[tuple[int, ...], set[int]] = {}
        for row, item in enumerate(ids):
            own = number[at[row] : at[row + 1]].tolist()
            for k in range(max(1, len(own) - width + 1) if own else 0):
                rows.setdefault(tuple(own[k : k + width]), set()).add(place[item])
        self.lengths = np.array([len(w) for w in rows], np.int64)
        self.patterns = np.zeros((len(rows), width), np.int64)
        for k, w in enumerate(rows):
            self.patterns[k, : len(w)] = w
        self.items = [np.array(sorted(v), np.int64) for v in rows.values()]
        self.shortest = int(self.lengths.min()) if rows else 1

    def number(self, h: np.ndarray) -> np.ndarray:
        """Word numbers, 0 outside the vocabulary."""
        if not len(self.vocabulary):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at + 1, 0)


class Shard:
    """A run of documents as word hashes, indexed and searched for one block of phrases at a time."""

    def __init__(self):
        self.hashes, self.sizes = [], []
        self.words = 0

    def add(self, h: np.ndarray, at: np.ndarray) -> None:
        self.hashes.append(h)
        self.sizes.append(np.diff(at))
        self.words += len(h)

    def segments(self, p: Phrases, h: np.ndarray, at: np.ndarray):
        """(symbols with a 0 after each segment, the document of each, its position in that) of the runs of known words."""
        number = p.number(h)
        n = len(number)
        doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
        place = np.arange(n) - at[doc]
        known = number > 0
        begin = np.flatnonzero(known & (np.concatenate([[True], ~known[:-1]]) | (place == 0)))
        end = np.flatnonzero(known & (np.concatenate([~known[1:], [True]]) | np.concatenate([place[1:] == 0, [True]]))) + 1
        length = end - begin
        begin, length = begin[length >= p.shortest], length[length >= p.shortest]
        rows, ends = ragged(begin, length), np.cumsum(length)
        return np.insert(number[rows], ends, 0), np.insert(doc[rows], ends, -1), np.insert(place[rows], ends, -1)

    def hits(self, blocks) -> tuple[list[np.ndarray], list[list[str]]]:
        """For each document: (merged spans [start, end) as an array, sorted items), over all blocks of phrases."""
        sizes = np.concatenate([np.zeros(0, np.int64), *self.sizes])
        h, at = np.concatenate([np.zeros(0, np.uint64), *self.hashes]), np.concatenate([[0], np.cumsum(sizes)])
        spans = [np.zeros((0, 2), np.int64)] * len(sizes)
        items: list[set[str]] = [set() for _ in sizes]
        for p in blocks:
            if not len(p.patterns) or not len(h):
                continue
            text, docs, places = self.segments(p, h, at)
            if not len(text):
                continue
            index = FMIndex(text, len(p.vocabulary) + 1)
            low, high = index.search(p.patterns, p.lengths)
            found = np.flatnonzero(low < high)
            each = (high - low)[found]
            position = index.locate(ragged(low[found], each))
            window = np.repeat(found, each)
            if not len(position):
                continue
            depth = np.zeros(len(text) + 1, np.int64)
            np.add.at(depth, position, 1)
            np.add.at(depth, position + p.lengths[window], -1)
            hit = np.cumsum(depth)[:-1] > 0
            open_, close = hit & ~np.concatenate([[False], hit[:-1]]), hit & ~np.concatenate([hit[1:], [False]])
            a, b = np.flatnonzero(open_), np.flatnonzero(close)
            owner = docs[a]
            both = np.stack([places[a], places[b] + 1], 1)
            edge = np.flatnonzero(np.diff(owner)) + 1
            for d, rows in zip(owner[np.concatenate([[0], edge])].tolist(), np.split(both, edge)):
                spans[d] = merged(np.concatenate([spans[d], rows]))
            # (document, window) pairs, each once
            for d, w in np.unique(np.stack([docs[position], window], 1), axis=0).tolist():
                items[d].update(p.ids[i] for i in p.items[w].tolist())
        return spans, [sorted(i) for i in items]


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of spans [start, end) that overlap or touch."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([new[1:], [True]])
    return np.stack([spans[new, 0], reach[last]], 1)


class Blocks:
    """Broadcast blocks of phrases; a task holds one of them at a time, unless there is only one."""

    def __init__(self, parts: list):
        self.parts = parts

    def __iter__(self):
        for part in self.parts:
            yield part.value
            if len(self.parts) > 1:
                part.__dict__.pop("_value", None)  # read again from the worker's disk by the next shard


def find(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 13, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep columns, n_words, spans (word positions [start, end) to remove, merged), items (ids as text) for every row."""
    rows = items.select(items[item_id].cast("string").alias("i"), items[item_text].cast("string").alias("t")).where("i is not null and t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    parts = []
    for b in range(blocks):
        got = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).distinct().orderBy("i", "t").collect()  # about BLOCK_BYTES
        part = docs.sparkSession.sparkContext.broadcast(Phrases([r.i for r in got], [r.t for r in got], width))
        if blocks > 1:
            part.__dict__.pop("_value", None)  # it is in the broadcast's file; the driver keeps one block at most
        parts.append(part)
    return _search(docs, Blocks(parts), doc_id, text, keep)


def _search(docs: DataFrame, blocks: Blocks, doc_id: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    inner = docs.select(docs[text].cast("string").alias("t"), docs[doc_id].alias("d"), *[docs[c].alias(f"k{i}") for i, c in enumerate(keep)])
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*inner.schema.fields[1:], T.StructField("n_words", T.LongType()), T.StructField("spans", span), T.StructField("items", T.ArrayType(T.StringType()))])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        hasher, shard, held = Hasher(), Shard(), []

        def flush():
            spans, items = shard.hits(blocks)
            done = 0
            for rest, n in zip(held, shard.sizes):
                own = range(done, done + len(n))
                sizes = np.cumsum([0, *(len(spans[i]) for i in own)])
                flat = np.concatenate([np.zeros((0, 2), np.int64), *(spans[i] for i in own)])
                pairs = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["start", "end"])
                cols = [*rest, pa.array(n), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs).cast(kind), pa.array([items[i] for i in own], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in schema.fields])
                done += len(n)

        seen = 0
        for rb in slices(batches, "t", 1 << 19):
            data, offsets = utf8(rb.column(0))
            shard.add(*words(data, offsets, hasher))
            held.append(rb.columns[1:])
            seen += len(data)
            if seen >= SHARD_BYTES:
                yield from flush()
                shard, held, seen = Shard(), [], 0
        if held:
            yield from flush()

    out = inner.mapInArrow(run, schema)
    names = {"d": doc_id, **{f"k{i}": c for i, c in enumerate(keep)}}
    return out.withColumnsRenamed(names)


def judge(found: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated from what find() returns."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    out = found.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    out = out.withColumn("items_sha256", F.sha2(F.array_join(F.array_sort("items"), ","), 256))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
