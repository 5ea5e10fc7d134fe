"""Operator 4: a linear-chain CRF labels every line good or bad; length-weighted marginals make the document's score.

Line features are shares of character classes, length, repetition within the document, and the same of the previous and
next line. Line labels are learnt from document labels: the lines of a good document are good; those of a bad one start
as bad, and those that the first fit takes for good are relabelled before the second. The score is a logistic of
the length-weighted mean badness and the largest one.

Fitting uses about 2 x `sample` labelled documents (a parameter; all if there are fewer). Defined results: null and
empty texts have one empty line and get that line's score; without usable labels every score is 0.5; extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, slices, utf8
from .crf import Chain, fit, logistic, predict
from .labelled import LONGEST
from .labelled import sample as labelled
from .pretokens import Hasher


HASHER = Hasher()


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


KINDS = [
    _table(bytes(range(97, 123)) + bytes(range(128, 256))), _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b" \t"), _table(b".,;:'\"-()"),
    _table(b"!?"), _table(b"|/\\_=<>[]{}~^+"), _table(b"#$%&*@"),
]


def line_columns(data: np.ndarray, offsets: np.ndarray):
    """(index of the first line of each text and the end, line lengths, an iterator over the features of every line)."""
    n = len(data)
    newline = np.flatnonzero(data == 10)
    texts = len(offsets) - 1
    # a text's lines: one more than its newlines; empty lines and texts keep a line of length 0
    per = np.searchsorted(newline, offsets[1:]) - np.searchsorted(newline, offsets[:-1]) + 1
    first = np.concatenate([[0], np.cumsum(per)])
    begin = np.zeros(first[-1], np.int64)
    end = np.zeros(first[-1], np.int64)
    own = np.ones(first[-1], bool)
    own[first[:-1]] = False
    begin[first[:-1]], begin[own] = offsets[:-1], newline + 1
    last = np.ones(first[-1], bool)
    last[first[1:] - 1] = False
    end[first[1:] - 1], end[last] = offsets[1:], newline
    size = end - begin

    def columns():
        for nth, kind in enumerate(KINDS):
            run = np.zeros(n + 1, np.int32)
            np.cumsum(kind[data], out=run[1:])
            inside = run[end] - run[begin]
            if nth == 3:
                space = inside
            yield inside / np.maximum(size, 1)
        yield np.log1p(size) / 6
        yield np.minimum(size / (space + 1), 30) / 10
        yield (size == 0).astype(float)
        tail = np.where(size > 0, data[np.maximum(end - 1, 0)] if n else 0, 0)
        yield np.isin(tail, list(b".!?")).astype(float)
        h = HASHER(data.astype(np.uint32), begin, size)
        owner = np.repeat(np.arange(texts), per)
        full = np.flatnonzero(size > 0)
        order = full[np.lexsort((h[full], owner[full]))]
        same = (owner[order][1:] == owner[order][:-1]) & (h[order][1:] == h[order][:-1])
        twin = np.zeros(len(size))
        twin[order[1:][same]] = twin[order[:-1][same]] = 1.0
        yield twin

    return first, size, columns()


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of every line with those of its neighbours, index of the first line of each text and the end, line lengths)."""
    first, size, columns = line_columns(data, offsets)
    x = np.column_stack(list(columns))
    prev, nxt = np.zeros_like(x), np.zeros_like(x)
    prev[1:], nxt[:-1] = x[:-1], x[1:]
    prev[first[:-1]] = 0
    nxt[first[1:] - 1] = 0
    return np.column_stack([x, x**2, prev, nxt, np.ones(len(x))]), first, size


def line_scores(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line_features @ weights, first lines, lengths), one feature at a time: a text of many short lines takes a few arrays."""
    first, size, columns = line_columns(data, offsets)
    k = (len(weights) - 1) // 4
    own, prev, nxt = np.full(len(size), weights[-1]), np.zeros(len(size)), np.zeros(len(size))
    for i, x in enumerate(columns):
        own += x * weights[i] + x**2 * weights[k + i]
        prev += x * weights[2 * k + i]
        nxt += x * weights[3 * k + i]
    inner = np.ones(len(size), bool)
    inner[first[:-1]] = False
    at = np.flatnonzero(inner)
    own[at] += prev[at - 1]
    own[at - 1] += nxt[at]
    return own, first, size


class Model:
    def __init__(self):
        self.weights, self.chain, self.top = None, Chain(), None

    def document(self, scores: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Per document: length-weighted mean and largest badness of its lines."""
        begin = np.zeros(len(scores), bool)
        begin[first[:-1]] = True
        bad = self.chain.marginals(scores, begin)
        weight = size + 1.0
        mean = np.add.reduceat(bad * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])
        return np.column_stack([mean, np.maximum.reduceat(np.where(size >= 10, bad, 0), first[:-1])])

    def fit(self, texts: list[str], good: list[int]) -> None:
        y = 1 - np.array(good, float)
        if not len(y) or y.min() == y.max():
            return
        each = [line_features(*utf8(rb.column(0))) for rb in slices(iter([pa.record_batch([pa.array(texts, pa.string())], ["t"])]), "t", 1 << 19)]
        x, size = np.concatenate([e[0] for e in each]), np.concatenate([e[2] for e in each])
        first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(e[1]) for e in each]))])
        per = np.diff(first)
        label = np.repeat(y, per)
        begin = np.zeros(len(x), bool)
        begin[first[:-1]] = True
        for _ in range(2):
            self.weights = np.zeros(x.shape[1])

            def update(rows, residual, ada):
                ada.step("w", self.weights, x[rows].T @ residual - 1e-5 * self.weights)

            self.chain = fit(lambda rows: x[rows] @ self.weights, update, label, begin, [np.arange(len(x))], 80, 0.3)
            bad = self.chain.marginals(x @ self.weights, begin)
            label = np.where(np.repeat(y, per) > 0, bad > 0.5, 0).astype(float)
        self.top = logistic(self.document(x @ self.weights, first, size), 1 - y)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.top is None:
            return np.full(len(offsets) - 1, 0.5)
        return predict(self.document(*line_scores(data, offsets, self.weights)), self.top)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = 2000, longest: int = LONGEST) -> Model:
    """A model fitted on about 2 x `sample` documents of at most `longest` characters (both bound the driver's memory)."""
    model = Model()
    model.fit(*labelled(docs, labels, label, sample, longest))
    return model


def score(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; no shuffle."""
    inner = docs.select(docs["doc_id"].alias("d"), docs[text].cast("string").alias("t"))
    schema = T.StructType([inner.schema[0], T.StructField("score", T.DoubleType())])

    def run(batches):
        for rb in slices(batches, "t", 1 << 19):
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(model.score(*utf8(rb.column(1))))], ["d", "score"])

    out = inner.mapInArrow(run, schema).withColumnRenamed("d", "doc_id")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
