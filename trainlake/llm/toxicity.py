"""Operator 5: a linear-chain CRF tags toxic spans; forward-backward marginals make the document's score.

Token labels are derived from document labels: features (a word, or its first 4 to 7 bytes) that are frequent in toxic
documents and nearly absent from others are chosen greedily, each time the one that explains most toxic documents not yet
explained twice (so the other words of a toxic document that has many copies are not chosen). Tokens with a chosen
feature are labelled toxic, and the CRF is fitted on words, prefixes, suffixes and neighbours. A document's score is a
logistic of the summed and of the largest marginal; offending offsets are runs of tokens with a marginal over one half.

Fitting uses about 2 x `sample` labelled documents (a parameter; all if there are fewer). Defined results: a text without
words (null, empty) scores as one without toxic words; without usable labels every score is 0; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, slices, utf8
from .crf import Chain, fit, logistic, predict
from .decontamination import FOLD, WORD
from .labelled import LONGEST
from .labelled import sample as labelled
from .pretokens import Hasher

TABLE_BITS = 18
HASHER = Hasher()
#: Words whose features are built at once; bounds the memory that a long text takes.
BLOCK_WORDS = 1 << 15
#: Bytes of text that one step tags.
SLICE = 1 << 18


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and length in bytes of each word, index of the first word of each text and the end)."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1 : n + 1] = WORD[FOLD[data]]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    at = np.flatnonzero(inside[1 : n + 1] & (~inside[:n] | cut[:n]))
    to = np.flatnonzero(inside[1 : n + 1] & (~inside[2:] | cut[1:])) + 1
    return at, to - at, np.searchsorted(at, offsets)


class Model:
    def __init__(self):
        self.weights = np.zeros(1 << TABLE_BITS, np.float32)
        self.chain, self.top = Chain(), None

    @staticmethod
    def keys(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        """Hashes of the word and of its parts."""
        low = FOLD[data].astype(np.uint32)
        h = HASHER
        word = h(low, at, size)
        parts = [word]
        for k, salt in ((4, 0xA5), (5, 0xB7), (6, 0xD9), (7, 0xEB)):
            parts.append(np.where(size > k, h(low, at, np.minimum(size, k)) + np.uint64(salt), word + np.uint64(salt)))
        tail = np.minimum(size, 4)
        parts.append(h(low, at + size - tail, tail) + np.uint64(0xC3))
        return parts

    @classmethod
    def slots(cls, parts: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        prev, nxt = np.zeros_like(parts[0]), np.zeros_like(parts[0])
        prev[1:], nxt[:-1] = parts[0][:-1], parts[0][1:]
        edge = first[:-1][first[:-1] < len(prev)]
        prev[edge] = 0
        nxt[(first[1:] - 1)[first[1:] > first[:-1]]] = 0
        all_ = [*parts, prev + np.uint64(0x1D1), nxt + np.uint64(0x2E3)]
        with np.errstate(over="ignore"):
            return np.stack([((p * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int32) for p in all_], 1)

    def document(self, p: np.ndarray, first: np.ndarray) -> np.ndarray:
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        strong = np.where(p > 0.02, p, 0)
        total = np.bincount(owner, strong, minlength=len(first) - 1)
        top = np.zeros(len(first) - 1)
        np.maximum.at(top, owner, p)
        return np.column_stack([np.log(total + 0.01), top])

    def tag(self, data: np.ndarray, offsets: np.ndarray):
        """(marginal of each word, start, length, index of first words)."""
        at, size, first = tokens(data, offsets)
        begin = np.zeros(len(at), bool)
        begin[first[:-1][first[:-1] < len(at)]] = True
        return self.chain.marginals(self.scores(data, at, size, first), begin), at, size, first

    def scores(self, data: np.ndarray, at: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Summed weights of each word, worked off in blocks of words (each with a neighbour on both sides)."""
        out = np.zeros(len(at))
        for a in range(0, len(at), BLOCK_WORDS):
            b = min(a + BLOCK_WORDS, len(at))
            low, high = max(a - 1, 0), min(b + 1, len(at))
            base = int(at[low])
            own = data[base : int(at[high - 1] + size[high - 1])]
            edge = np.clip(first, low, high) - low
            edge = np.unique(np.concatenate([[0], edge, [high - low]]))
            rows = self.slots(self.keys(own, at[low:high] - base, size[low:high]), edge)[a - low : b - low]
            out[a:b] = self.weights[rows].sum(1)
        return out

    def fit(self, texts: list[str], toxic: list[int], lowest: int = 4, epochs: int = 3) -> None:
        y = np.array(toxic)
        if not len(y) or y.min() == y.max():
            return
        parts_of = lambda: slices(iter([pa.record_batch([pa.array(texts, pa.string())], ["t"])]), "t", 1 << 19)
        counts = np.concatenate([np.diff(tokens(*utf8(rb.column(0)))[2]) for rb in parts_of()])
        first = np.concatenate([[0], np.cumsum(counts)])
        parts = [np.empty(first[-1], np.uint64) for _ in range(5)]
        slots, done = np.empty((first[-1], 8), np.int32), 0
        for rb in parts_of():  # filled in place: the driver's memory holds each array once
            data, offsets = utf8(rb.column(0))
            at, size, own = tokens(data, offsets)
            k = self.keys(data, at, size)
            for part, new in zip(parts, k):
                part[done : done + len(at)] = new
            slots[done : done + len(at)] = self.slots(k, own)
            done += len(at)
        self.weights = np.zeros(1 << TABLE_BITS, np.float64)
        at = parts[0]
        owner = np.repeat(np.arange(len(y)), np.diff(first))
        chosen = self.features(parts, owner, y, lowest)
        label = np.zeros(len(at), bool)
        for k in parts:
            label |= np.isin(k, chosen)
        del parts
        label &= y[owner] == 1
        begin = np.zeros(len(at), bool)
        begin[first[:-1][first[:-1] < len(at)]] = True
        order = np.random.default_rng(7).permutation(len(y))
        batches, held, n = [], [], 0
        for d in order.tolist():
            held.append(np.arange(first[d], first[d + 1]))
            n += len(held[-1])
            if n > 30_000:
                batches.append(np.concatenate(held))
                held, n = [], 0
        if n:
            batches.append(np.concatenate(held))

        def update(rows, residual, ada):
            g = np.bincount(slots[rows].ravel(), np.repeat(residual, slots.shape[1]), minlength=len(self.weights))
            ada.step("w", self.weights, g)

        self.chain = fit(lambda rows: self.weights[slots[rows]].sum(1), update, label.astype(float), begin, batches, epochs, 0.5)
        p = np.zeros(len(at))
        for rows in batches:
            p[rows] = self.chain.marginals(self.weights[slots[rows]].sum(1), begin[rows])
        self.top = logistic(self.document(p, first), y.astype(float))
        self.weights = self.weights.astype(np.float32)

    @staticmethod
    def features(parts: list[np.ndarray], owner: np.ndarray, y: np.ndarray, lowest: int) -> np.ndarray:
        """Feature hashes chosen by greedy cover of the toxic documents."""
        n1, n0 = int(y.sum()), int((1 - y).sum())
        toxic = y[owner] == 1
        names_, pairs, base = [], [], 0
        for k in parts:  # one part at a time, for the driver's memory
            seen, count = np.unique(k[toxic], return_counts=True)
            seen = seen[count >= lowest]
            if not len(seen):
                continue
            at = np.minimum(np.searchsorted(seen, k), len(seen) - 1)
            rows = np.flatnonzero(seen[at] == k)
            pairs.append(np.unique((at[rows] + base) * len(y) + owner[rows]))
            names_.append(seen)
            base += len(seen)
        if not names_:
            return np.zeros(0, np.uint64)
        names, pair = np.concatenate(names_), np.concatenate(pairs)
        back, doc = pair // len(y), pair % len(y)
        df1 = np.bincount(back[y[doc] == 1], minlength=len(names))
        df0 = np.bincount(back[y[doc] == 0], minlength=len(names))
        pure = (df1 >= lowest) & ((df0 + 0.1) / n0 < 0.05 * df1 / n1)
        keep = pure[back] & (y[doc] == 1)
        back, doc = back[keep], doc[keep]
        order = np.argsort(back, kind="stable")
        back, doc = back[order], doc[order]
        edge = np.searchsorted(back, np.arange(len(names) + 1))
        need = np.full(len(y), 2)
        out = []
        for _ in range(2000):
            gain = np.bincount(back, (need[doc] > 0).astype(float), minlength=len(names))
            best = int(gain.argmax()) if len(gain) else 0
            if not len(gain) or gain[best] < max(lowest, 0.002 * n1):
                break
            out.append(best)
            need[doc[edge[best] : edge[best + 1]]] -= 1
        return names[np.array(out, np.int64)] if out else np.zeros(0, np.uint64)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.top is None:
            return np.zeros(len(offsets) - 1)
        p, _, _, first = self.tag(data, offsets)
        return predict(self.document(p, first), self.top)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample: int = 1500, longest: int = LONGEST) -> Model:
    """A model fitted on about 2 x `sample` documents of at most `longest` characters (both bound the driver's memory)."""
    model = Model()
    model.fit(*labelled(docs, labels, label, sample, longest))
    return model


def tag(docs: DataFrame, model: Model, *, text: str = "text", doc_id: str = "doc_id", cut: float = 0.5) -> DataFrame:
    """doc_id, score and the offending spans (byte offsets [start, end) of runs of toxic words) of every row; no shuffle."""
    inner = docs.select(docs[doc_id].alias("d"), docs[text].cast("string").alias("t"))
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([inner.schema[0], T.StructField("score", T.DoubleType()), T.StructField("spans", span)])

    def run(batches):
        for rb in slices(batches, "t", SLICE):
            data, offsets = utf8(rb.column(1))
            p, at, size, first = model.tag(data, offsets)
            s = predict(model.document(p, first), model.top) if model.top is not None else np.zeros(len(first) - 1)
            hot = p > cut
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            with_prev = np.zeros(len(hot), bool)
            with_prev[1:] = hot[:-1] & (owner[1:] == owner[:-1])
            with_next = np.zeros(len(hot), bool)
            with_next[:-1] = hot[1:] & (owner[1:] == owner[:-1])
            a, b = np.flatnonzero(hot & ~with_prev), np.flatnonzero(hot & ~with_next)
            base = offsets[owner[a]]
            pairs = pa.StructArray.from_arrays([pa.array(at[a] - base), pa.array(at[b] + size[b] - base)], ["start", "end"])
            edge = np.searchsorted(owner[a], np.arange(len(first)))
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(s), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pairs)], ["d", "score", "spans"])

    return inner.mapInArrow(run, schema).withColumnRenamed("d", doc_id)


def score(docs: DataFrame, model: Model, *, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    out = tag(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score_rows(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of every row, and score."""
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    at = docs.columns.index(text)

    def run(batches):
        for rb in slices(batches, text, SLICE):
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(model.score(*utf8(rb.column(at))))], [*rb.schema.names, "score"])

    return docs.mapInArrow(run, schema)
