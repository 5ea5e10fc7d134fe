"""Operator 13: phrase collocations by Apriori passes over the levels of 1, 2, … words.

Pass k reads all texts and counts runs of k words, but emits a run only where both of its overlapping runs of k-1 words are
frequent. Tasks number their words exactly (Arrow's dictionary encoding), so a run is a pair of numbers and is counted in
its batch before it is sent; the shuffle adds the batches' counts up. What is frequent is broadcast as a bit set of at most
2^28 bits (two bits a run, sized by the level): where it says yes by chance a run is counted in vain and dropped by its
count, so results do not depend on it. Every part of a frequent phrase is frequent itself, so the cuts of a phrase are
scored by joins with the level tables.

Defined results: a null text has no words, a null lang is `und`; repeated rows count each; an empty table gives no rows;
other columns, whatever their names, are not read. A text of any length is read in blocks that end at words (the next block
starts k-1 words before); memory is bounded by a block and the longest word. Products are decimals of 38 digits: exact for
counts below 10^15.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, cut, ragged, slices, utf8

# The contract's separators of pieces and of words.
PIECE_ENDS, WORD_ENDS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
MOST_BITS = 28
BATCH_ROWS = 1 << 14
COUNTS = "lang string, phrase string, n long"
#: Groups a language is ranked in, round by round; each keeps its first rows.
ROUNDS = (4096, 64, 1)
ODD, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def byte_kinds() -> np.ndarray:
    """0 for bytes of words, 1 between words, 2 between pieces."""
    out = np.zeros(256, np.uint8)
    out[list(WORD_ENDS)], out[list(PIECE_ENDS)] = 1, 2
    return out


KIND = byte_kinds()


def lowered(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def pieces_of_text(data: np.ndarray, k: int, limit: int) -> Iterator[np.ndarray]:
    """Blocks of one text that end at a word's end and start k-1 words before the last one's end, so that each run of k words lies in one block."""
    at, n = 0, len(data)
    while at < n:
        size = limit
        while True:
            end = min(at + size, n)
            while end < n and not KIND[data[end]]:
                rest = np.flatnonzero(KIND[data[end : end + 4096]])
                end = end + int(rest[0]) if len(rest) else min(end + 4096, n)
            inside = KIND[data[at:end]] == 0
            begin = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
            if end == n or len(begin) >= k:
                break
            size *= 2
        yield data[at:end]
        at = n if end == n else (at + int(begin[len(begin) - k + 1]) if k > 1 else end)


class Words:
    """The words of a batch: symbols (a number for each language and word), pieces, and the words' bytes, each with a space after it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str], lang_of: np.ndarray):
        data = np.insert(lowered(data), offsets[1:], PIECE_ENDS[0])
        bounds = offsets + np.arange(len(offsets))
        kind = KIND[data]
        inside = kind == 0
        before = np.concatenate([[False], inside[:-1]])
        start = np.flatnonzero(inside & ~before)
        tiles = inside | before
        self.bytes = np.where(inside, data, np.uint8(0x20))[tiles]
        size = np.flatnonzero(~inside & before) - start + 1
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.piece = np.cumsum(kind == 2)[start]
        doc = np.searchsorted(bounds, start, "right") - 1
        words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(self.at.astype(np.int32)), pa.py_buffer(self.bytes)]).dictionary_encode()
        distinct, width = words.dictionary, max(1, len(words.dictionary))
        own = lang_of[doc] * width + words.indices.to_numpy(zero_copy_only=False)
        counts = np.bincount(own, minlength=len(langs) * width)
        used = np.flatnonzero(counts)
        number = np.zeros(len(counts), np.int64)
        number[used] = np.arange(len(used))
        self.symbol, self.counts, self.langs = number[own], counts[used], langs
        self.lang, self.word = used // width, used % width
        self.distinct = distinct

    def hashes(self) -> np.ndarray:
        """A hash for each symbol."""
        raw = np.fromiter((xxhash.xxh64_intdigest(w.as_py()) for w in self.distinct), np.uint64, len(self.distinct))
        return seeded(np.array([xxhash.xxh64_intdigest(x) for x in self.langs], np.uint64)[self.lang], raw[self.word])

    def rows(self, first: np.ndarray, k: int, counts: np.ndarray) -> pa.RecordBatch:
        """(lang, phrase, n) of the runs of k words that start at these words."""
        begin, size = self.at[first], self.at[first + k] - 1 - self.at[first]
        data = self.bytes[ragged(begin, size)]
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        phrase = pa.StringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(data))
        lang = pa.DictionaryArray.from_arrays(self.lang[self.symbol[first]].astype(np.int32), pa.array(self.langs, pa.string())).cast(pa.string())
        return pa.RecordBatch.from_arrays([lang, phrase, pa.array(counts.astype(np.int64))], ["lang", "phrase", "n"])


def seeded(lang: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a language's word."""
    return mixed(lang * ODD + word)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * SPREAD
    return h ^ (h >> np.uint64(29))


def longer(run: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a run and the word after it."""
    return mixed(run * ODD + word)


class BitSet:
    """Two bits for each member; says yes to all members and, by chance, to a few others."""

    def __init__(self, bits: int):
        self.bits, self.cells = bits, np.zeros(1 << (bits - 6), np.uint64)

    @staticmethod
    def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << bits) - 1)
        return h & mask, (h >> np.uint64(64 - bits)) & mask

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for p in self.places(h, self.bits):
            out &= (self.cells[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def frequent_bits(level: DataFrame, k: int) -> BitSet:
    """The bit set of a level table (lang, phrase). Tasks join the bits of each cell; the driver gets at most 2^bits / 64 cells."""
    bits = min(MOST_BITS, max(16, (32 * level.count()).bit_length()))

    def run(batches):
        for rb in batches:
            if not rb.num_rows:
                continue
            lang = np.array([xxhash.xxh64_intdigest(x) for x in rb.column(0).to_pylist()], np.uint64)
            h = None
            words = [p.split(" ") for p in rb.column(1).to_pylist()]
            for i in range(k):
                w = seeded(lang, np.array([xxhash.xxh64_intdigest(x[i] + " ") for x in words], np.uint64))
                h = w if h is None else longer(h, w)
            places = np.concatenate(BitSet.places(h, bits))
            cell, bit = (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63))
            order = np.argsort(cell, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], cell[order][1:] != cell[order][:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(cell[order][first]), pa.array(np.bitwise_or.reduceat(bit[order], first).view(np.int64))], ["cell", "bits"])

    cells = level.select("lang", "phrase").mapInArrow(run, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = BitSet(bits)
    out.cells[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return out


def runs_of(words: Words, k: int, filters: list[BitSet]) -> pa.RecordBatch:
    """(lang, phrase, n) of a batch's runs of k words whose two overlapping runs of k-1 words may be frequent."""
    n, symbol, piece = len(words.symbol), words.symbol, words.piece
    base = words.hashes()
    run, h = symbol, base
    ok = filters[0].has(base)[symbol]
    for j in range(2, k + 1):
        m = n - j + 1
        if m <= 0:
            return words.rows(np.zeros(0, np.int64), k, np.zeros(0, np.int64))
        at = np.flatnonzero(ok[:m] & ok[1 : m + 1] & (piece[:m] == piece[j - 1 :]))
        _, first, back, counts = np.unique(run[at] * len(base) + symbol[at + j - 1], return_index=True, return_inverse=True, return_counts=True)
        lead = at[first]
        if j == k:
            return words.rows(lead, k, counts)
        h = longer(h[run[lead]], base[symbol[lead + j - 1]])
        yes = filters[j - 1].has(h)
        run, ok = np.zeros(n, np.int64), np.zeros(n, bool)
        run[at], ok[at] = back, yes[back]
    raise ValueError("k must be 2 or more")


def batch_words(batches, k: int, limit: int) -> Iterator[Words]:
    """Words of (lang, t) rows in slices of about `limit` bytes; a longer text in blocks."""
    for rb in slices(batches, "t", limit):
        data, offsets = utf8(rb.column(1))
        coded = rb.column(0).dictionary_encode()
        langs, lang_of = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if rb.num_rows == 1 and len(data) > 2 * limit:
            for block in pieces_of_text(data, k, limit):
                yield Words(block, np.array([0, len(block)]), langs, lang_of)
        else:
            yield Words(data, offsets, langs, lang_of)


def small(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in batches that keep the JVM's Arrow buffers small."""
    for at in range(0, rows.num_rows, BATCH_ROWS):
        yield rows.slice(at, BATCH_ROWS)


def level_counts(texts: DataFrame, k: int, least: int, filters: list, *, limit: int = CHUNK_BYTES) -> DataFrame:
    """lang, phrase, n of all runs of k words that occur `least` times or more in a language; k = 1 also gives a row without a phrase for each language, with all its words."""
    def run(batches):
        for words in batch_words(batches, k, limit):
            if k > 1:
                yield from small(runs_of(words, k, [f.value for f in filters]))
                continue
            _, first = np.unique(words.symbol, return_index=True)
            yield from small(words.rows(first, 1, words.counts))
            per = np.bincount(words.lang, words.counts, minlength=len(words.langs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words.langs, pa.string()), pa.nulls(len(per), pa.string()), pa.array(per)], ["lang", "phrase", "n"])

    counts = texts.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return counts.where((F.col("n") >= least) | F.col("phrase").isNull())


def scored(level: DataFrame, k: int, levels: dict[int, DataFrame]) -> DataFrame:
    """lang, phrase, a, l, r, score of phrases of k words: the cut with the lowest score, the first of equal ones."""
    out, cuts = level.withColumnRenamed("n", "a"), []
    exact = lambda c: f"cast({c} as decimal(18,0))"
    for c in range(1, k):
        for side, part, size in (("l", F.substring_index("phrase", " ", c), c), ("r", F.substring_index("phrase", " ", c - k), k - c)):
            name = f"{side}{c}"
            found = levels[size].select(F.col("lang").alias("lang_"), F.col("phrase").alias("part_"), F.col("n").alias(name))
            out = out.join(found, (out["lang"] == found["lang_"]) & (part == found["part_"])).drop("lang_", "part_")
        value = F.expr(f"(({exact('a')} * {exact('a')}) * cast(1000000 as decimal(7,0))) div ({exact(f'l{c}')} * {exact(f'r{c}')})").cast("long")
        cuts.append(F.struct(value.alias("score"), F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")))
    best = F.array_min(F.array(*cuts))
    return out.select("lang", "phrase", "a", best.alias("b")).select("lang", "phrase", "a", "b.l", "b.r", "b.score")


def covered(levels: dict[int, DataFrame]) -> DataFrame | None:
    """lang, phrase, most: the highest count of a longer phrase that holds this one."""
    parts = []
    for k, level in levels.items():
        for m in range(2, k):
            inner = [F.substring_index(F.substring_index("phrase", " ", i + m), " ", -m) for i in range(k - m + 1)]
            parts.append(level.select("lang", F.explode(F.array(*inner)).alias("phrase"), "n"))
    return reduce(DataFrame.unionByName, parts).groupBy("lang", "phrase").agg(F.max("n").alias("most")) if parts else None


def first_of_each(rows: DataFrame, n: int) -> DataFrame:
    """rank and the first n rows of each lang, chosen in rounds over fewer and fewer groups, so that no task sorts a language's phrases."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    for groups in ROUNDS:
        by = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= n)
    return rows


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, cover_percent: int = 50, first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first phrases of 2 to `longest` words by score, count and phrase.

    Phrases of fewer than `least` occurrences are no candidates; a candidate goes where a longer one that holds it has
    `cover_percent` of its occurrences."""
    texts = docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].cast("string").alias("t"))
    spark, levels, filters = docs.sparkSession, {}, []
    for k in range(1, longest + 1):
        table = cut(level_counts(texts, k, least, filters))
        levels[k] = table.where("phrase is not null") if k == 1 else table
        if k == 1:
            totals = table.where("phrase is null").select("lang", "n")
        if k < longest:
            filters.append(spark.sparkContext.broadcast(frequent_bits(levels[k], k)))
    found = reduce(DataFrame.unionByName, [scored(levels[k], k, levels) for k in range(2, longest + 1)])
    inside = covered({k: v for k, v in levels.items() if k > 2})
    if inside is not None:
        exact = "cast({} as decimal(30,0))"
        found = found.join(inside, ["lang", "phrase"], "left").where(F.expr(f"most is null or {exact.format('most')} * 100 < {exact.format('a')} * {cover_percent}")).drop("most")
    return first_of_each(found, first).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
