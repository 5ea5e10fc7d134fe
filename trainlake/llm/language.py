"""Operator 6: language identification by rank-order n-gram profiles.

A profile is the list of the most frequent character n-grams (1 to 4 letters, word ends marked) in order of count; a
document's language is the one whose profile has the smallest out-of-place distance to the document's own: the sum over
the document's n-grams of the difference in rank, or the profile's size where the language lacks the n-gram. The score is
the runner-up's share of the two smallest distances (0.5: undecided, 1: certain).

Profiles are learnt from about `sample` documents a language (a parameter; all if there are fewer). Defined results: a
null text or one without letters is `und` with score 0; ties go to the first language in alphabetical order; without
profiles all are `und`; extra columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import code_points, held_out, slices, utf8
from .pretokens import LETTER, classes

SIZE = 300


@functools.cache
def lower() -> np.ndarray:
    """Lower-case code point of each letter (0 for others), within 16 bits."""
    out = np.zeros(0x110000, np.uint16)
    letters = np.flatnonzero(classes() == LETTER)
    small = [chr(i).lower() for i in letters.tolist()]
    out[letters] = [ord(c[0]) & 0xFFFF or 1 for c in small]
    return out


MARK = 0xFFFF


def laid(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters with a mark before and after each word, text number of each, word number of each)."""
    c = lower()[cps]
    letter = c > 0
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] |= letter[starts]
    keep = np.flatnonzero(letter)
    if not len(keep):
        return np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = np.cumsum(first)[keep] - 1
    begin = np.flatnonzero(first[keep])
    line = np.full(len(keep) + 2 * len(begin), MARK, np.uint16)
    line[np.arange(len(keep)) + 2 * word + 1] = c[keep]
    tag = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(keep))) + 2)
    doc = (np.searchsorted(offsets, keep[begin], "right") - 1)[tag]
    return line, doc, tag


def grams(line: np.ndarray, tag: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the line, codes) of the n-grams of 1 to 4 symbols, `bits` a symbol; single marks are none."""
    value = line.astype(np.uint64)
    mark = line.max()
    one = np.flatnonzero(line != mark)
    yield one, value[one]
    single = value
    for n in (2, 3, 4):
        value = (value[:-1] << np.uint64(bits)) | single[n - 1 :]
        at = np.flatnonzero(tag[: len(value)] == tag[n - 1 :])
        yield at, value[at]


def counted_grams(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram code, count) in order of text and code; a code holds n letters in 16 bits each.

    The letters that occur are numbered in order, so that text and code fit into one number and one sort of values does;
    with a very large alphabet the texts are halved until they do."""
    line, doc, tag = laid(cps, offsets)
    if not len(line):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    used = np.flatnonzero(np.bincount(line, minlength=1 << 16))
    bits, texts = len(used).bit_length(), len(offsets) - 1
    if texts > 1 and (texts - 1).bit_length() + 4 * bits > 64:
        mid = texts // 2
        low, high = counted_grams(cps[: offsets[mid]], offsets[: mid + 1]), counted_grams(cps[offsets[mid] :], offsets[mid:] - offsets[mid])
        return np.concatenate([low[0], high[0] + mid]), np.concatenate([low[1], high[1]]), np.concatenate([low[2], high[2]])
    dense = np.zeros(1 << 16, np.uint16)
    dense[used] = np.arange(1, len(used) + 1)
    shift = np.uint64(4 * bits)
    base = doc.astype(np.uint64) << shift if texts > 1 else None
    parts = [code if base is None else code | base[at] for at, code in grams(dense[line], tag, bits)]
    key = np.concatenate(parts)
    del parts, base
    key.sort()
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    text = (key >> shift).astype(np.int64) if texts > 1 else np.zeros(len(key), np.int64)
    letters = np.concatenate([[0], used]).astype(np.uint64)
    code = np.zeros(len(key), np.uint64)
    for j in range(4):
        code |= letters[(key >> np.uint64(j * bits)) & np.uint64((1 << bits) - 1)] << np.uint64(16 * j)
    return text, code, count


def most_frequent(text: np.ndarray, count: np.ndarray, size: int, texts: int) -> np.ndarray:
    """Positions of each text's `size` largest counts, in order of text and falling count (ties in order of position)."""
    often = count > 1
    at = np.flatnonzero(often | (np.bincount(text[often], minlength=texts) < size)[text])  # enough others: single ones cannot rank
    text, count = text[at], count[at]
    top = int(count.max())
    place_bits, count_bits = len(at).bit_length(), top.bit_length()
    if place_bits + count_bits + texts.bit_length() <= 64:
        key = (((text << count_bits) | (top - count)).astype(np.uint64) << np.uint64(place_bits)) | np.arange(len(at), dtype=np.uint64)
        key.sort()
        order = (key & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    else:
        order = np.lexsort((-count, text))
    text = text[order]
    place = np.arange(len(text)) - np.searchsorted(text, np.arange(texts))[text]
    return at[order[place < size]]


class Profiles:
    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.names, self.size = sorted(ranked), size
        self.codes = np.unique(np.array([c for v in ranked.values() for c in v], np.uint64))
        self.rank = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            own = np.array(ranked[name], np.uint64)
            self.rank[i, np.searchsorted(self.codes, own)] = np.arange(len(own))

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        _, cps, at = code_points(data, offsets)
        n = len(at) - 1
        text, code, count = counted_grams(cps, at)
        if not self.names or not len(text):
            return ["und"] * n, np.zeros(n)
        top = most_frequent(text, count, self.size, n)
        text, code = text[top], code[top]
        place = np.arange(len(text)) - np.searchsorted(text, np.arange(n))[text]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        at = np.where(self.codes[at] == code, at, len(self.codes))
        distance = np.stack([np.bincount(text, np.where(r[at] < 0, self.size, np.abs(r[at] - place)), minlength=n) for r in self.rank], 1)
        best = distance.argmin(1)
        has = np.bincount(text, minlength=n) > 0
        near = distance[np.arange(n), best]
        if len(self.names) > 1:
            second = np.partition(distance, 1, 1)[:, 1]
        else:
            second = np.bincount(text, minlength=n) * float(self.size)
        score = np.where(near + second > 0, second / np.maximum(near + second, 1e-9), 0.5)
        return [self.names[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())], np.where(has, score, 0.0)


def train(docs: DataFrame, *, sample: int = 1500, size: int = SIZE) -> Profiles:
    """Profiles from documents outside the held-out fifth that have a language."""
    rows = docs.where(~held_out()).where("lang is not null and text is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return Profiles({}, size)
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample / n))) for k, n in counts.items()])
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003).select("lang", "text")

    def run(batches):
        for rb in slices(batches, "text"):
            langs = rb.column(0).to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            _, cps, at = code_points(*utf8(rb.column(1)))
            text, code, count = counted_grams(cps, at)
            for k, name in enumerate(names):
                own = number[text] == k
                c, back = np.unique(code[own], return_inverse=True)
                n = np.bincount(back, count[own], minlength=len(c)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(c), pa.string()), pa.array(c.view(np.int64)), pa.array(n)], ["lang", "code", "n"])

    counted = picked.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.expr("cast(code as decimal(20,0)) + if(code < 0, 18446744073709551616BD, 0BD)"))
    got = counted.withColumn("r", F.row_number().over(w)).where(F.col("r") <= size).orderBy("lang", "r").collect()
    ranked: dict[str, list[int]] = {}
    for r in got:
        ranked.setdefault(r.lang, []).append(r.code & (2**64 - 1))
    return Profiles(ranked, size)


def identify(docs: DataFrame, profiles: Profiles, *, text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; no shuffle."""
    inner = docs.select(docs["doc_id"].alias("d"), docs[text].cast("string").alias("t"))
    schema = T.StructType([inner.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        for rb in slices(batches, "t", 1 << 19):
            names, score = profiles.judge(*utf8(rb.column(1)))
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(names, pa.string()), pa.array(score)], ["d", "lang_pred", "score"])

    out = inner.mapInArrow(run, schema).withColumnRenamed("d", "doc_id")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
