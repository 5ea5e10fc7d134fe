"""Operator 12: byte-level BPE encoding and decoding by folds of Spark's higher-order functions.

Tasks split texts into blocks; a block's row holds its distinct pre-tokens and, for each document, the numbers of its own.
Spark's functions then fold the merges over each distinct word once: the state is an array of token ids, at first one a byte,
each with the rank of the pair that it begins; a step joins the leftmost pair of lowest rank and looks up the ranks of the two
pairs that this makes. Ranks come from a literal map of pairs, dealt into
buckets because Spark looks a map up from front to back. The documents' ids are put together inside the block's row;
decoding joins the ids' byte pieces. A block has `block` bytes of text and one document at least.

A word that is a token is that token, without a fold (as the library does it). Most other words come again in every block, so
the `common` most frequent ones of the corpus are counted and folded first, once each, and their ids sent to all tasks
(packed by the tasks that fold them, and only passed on by the driver); this only saves folds, any word that is not among them is folded in its block. Words of more than `fold_limit` bytes would
make the fold (quadratic in a word's length) too slow; they are merged by a heap in the task that reads them, with the same
result.

Defined results: a null or empty text has no tokens, digests are then those of the empty string; nothing in a text is
special; repeated rows give equal results; an empty table gives no rows; columns other than the text and `keep` are not
read, whatever their names. A long text is one document of its block: memory grows with the longest text.
"""

from __future__ import annotations

import base64
import functools
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import code_points, cut, slices, utf8
from .pretokens import starts
from .resampling import kth

#: A prime, so that pairs with one side in common are spread.
BUCKETS = 25_013
BLOCK_BYTES = 32 << 20
COMMON = 1 << 20
#: Rows that the common words are folded in.
ROWS = 24
PLACES = 1 << 20
#: Ids are below this, so two make one number.
IDS = 1 << 17
#: A part of a word that is being merged is one number: the rank of the pair that it and the next part make, its place, its id. So the
#: least number is the leftmost pair of lowest rank, and a merge looks up two ranks only.
ID_BITS, RANK_AT = 17, 37
#: As a rank: no such pair. In front of a state: no pair is left.
NO_PAIR, ENDED = IDS << RANK_AT, -1


@functools.cache
def ranks_of(path: str) -> dict[bytes, int]:
    """The rank file: a line for each token, its bytes in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def bind(value: Column, f) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


@functools.cache
def rank_map(path: str) -> dict[str, str]:
    """The ranks as constants of a plan, written as texts of numbers: the pairs of ids that make a token, in order of buckets, their
    ranks at the place that a state has them, and where each bucket begins; the bytes of each id in base64.

    Texts, because a constant array of so many numbers costs every task seconds to read."""
    ranks = ranks_of(path)
    buckets: list[list[tuple[int, int]]] = [[] for _ in range(BUCKETS)]
    pieces = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = base64.b64encode(token).decode()
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                pair = left * IDS + right
                buckets[pair % BUCKETS].append((pair, rank << RANK_AT))
    flat = [x for b in buckets for x in b]
    ends = itertools.accumulate(map(len, buckets), initial=0)
    parts = {"keys": [k for k, _ in flat], "values": [v for _, v in flat], "ends": ends, "pieces": pieces}
    return {k: ",".join(map(str, v)) for k, v in parts.items()}


def unpacked(constants: dict[str, str], row: str, f) -> Column:
    """f of the constants, the ranks of pairs as maps and the bytes of ids, made once a row. `row` names a column without nulls: what
    depends on it is not worked out while planning."""
    numbers = lambda k, kind: F.split(F.when(F.col(row).isNotNull(), F.lit(constants[k])), ",").cast(f"array<{kind}>")

    def pairs(t: Column) -> Column:
        part = lambda c, i: F.slice(t[c], F.get(t["ends"], i) + 1, F.get(t["ends"], i + 1) - F.get(t["ends"], i))
        return F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.map_from_arrays(part("keys", i), part("values", i)))

    table = F.struct(numbers("keys", "bigint").alias("keys"), numbers("values", "bigint").alias("values"), numbers("ends", "int").alias("ends"))
    pieces = F.transform(F.split(F.when(F.col(row).isNotNull(), F.lit(constants["pieces"])), ","), F.unbase64)
    return bind(bind(table, pairs), lambda p: bind(pieces, lambda b: f(p, b)))


def fold(pairs: Column, begin: Column) -> Column:
    """Ids of a word, given by its first state (`first_states`)."""
    low_bits = lambda v, bits: v.bitwiseAND(F.lit((1 << bits) - 1))

    def rank(left: Column, right: Column) -> Column:
        number = F.shiftleft(left, ID_BITS).bitwiseOR(right)  # null at the end
        return F.coalesce(F.get(pairs, number % BUCKETS)[number], F.lit(NO_PAIR))

    def step(state: Column, _: Column) -> Column:
        def merge(low: Column) -> Column:
            new, at = F.shiftright(low, RANK_AT), F.shiftright(low_bits(low, RANK_AT), ID_BITS).cast("int")
            before, after = F.get(state, at - 1), F.get(state, at + 2)
            pair = F.array(
                rank(low_bits(before, ID_BITS), new).bitwiseOR(low_bits(before, RANK_AT)),
                rank(new, low_bits(after, ID_BITS)).bitwiseOR(low.bitwiseAND(F.lit((PLACES - 1) << ID_BITS))).bitwiseOR(new),
            )
            rest = F.transform(F.slice(state, at + 3, F.lit(PLACES)), lambda v: v - F.lit(1 << ID_BITS))  # one place further to the front
            ended = F.flatten(F.array(F.array(F.lit(ENDED)), state))
            return F.when(low >= F.lit(NO_PAIR), ended).otherwise(F.flatten(F.array(F.slice(state, F.lit(1), at - 1), pair, rest)))

        return F.when(F.get(state, 0) == F.lit(ENDED), state).otherwise(bind(F.array_min(state), merge))

    # a state has one part more than a word has bytes, so that the last step finds no pair and puts ENDED in front
    return F.aggregate(begin, begin, step, lambda s: F.transform(F.slice(s, F.lit(3), F.lit(PLACES)), lambda v: low_bits(v, ID_BITS)))


def decode(pieces: Column, ids: Column) -> Column:
    """The bytes that ids stand for."""
    return joined(ids, pieces, "").cast("binary")


def joined(numbers: Column, values: Column, between: str) -> Column:
    """The values (array of binary) of the numbers, as one text. Spark copies each text that a function returns, but not bytes."""
    return F.array_join(F.transform(numbers, lambda i: F.get(values, i)).cast("array<string>"), between)


@functools.cache
def byte_pairs(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the bytes, and the ranks of each two as a state has them."""
    ranks = ranks_of(path)
    one = [bytes([i]) for i in range(256)]
    pairs = [[ranks[a + b] << RANK_AT if a + b in ranks else NO_PAIR for b in one] for a in one]
    return np.array([ranks[a] for a in one], np.int64), np.array(pairs, np.int64)


def first_states(words: pa.Array, path: str) -> pa.Array:
    """What the merges of each word (binary) begin with: its bytes as parts, after one that is in no pair."""
    (ids, pairs), n, some = byte_pairs(path), len(words), 1 << 14
    if not n:
        return pa.array([], pa.list_(pa.int64()))
    ends, data = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + n + 1], np.frombuffer(words.buffers()[2] or b"", np.uint8)
    ends, data = ends - ends[0], data[ends[0] : ends[-1]]
    out = np.full(len(data) + n, NO_PAIR | (IDS - 1), np.int64)
    for first in range(0, n, some):  # some words at a time, for little memory
        own = ends[first : first + some + 1]
        part, sizes, at = data[own[0] : own[-1]], np.diff(own), np.arange(own[0], own[-1])
        ranks = np.append(pairs[part[:-1], part[1:]], NO_PAIR)[: len(part)]
        ranks[own[1:][sizes > 0] - own[0] - 1] = NO_PAIR
        place = at + 1 - np.repeat(own[:-1], sizes)
        out[at + first + np.repeat(np.arange(1, len(own)), sizes)] = ranks | place << ID_BITS | ids[part]
    return pa.ListArray.from_arrays(pa.array(ends + np.arange(n + 1, dtype=np.int32)), pa.array(out))


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: the leftmost pair of lowest rank first, by a heap of pairs."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = after[i] if i < n else n
        if after[i] < 0 or j >= n or after[j] != end:
            continue  # one of the two was merged meanwhile
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
            if (r := ranks.get(word[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if before[i] >= 0 and (r := ranks.get(word[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : after[i]]])
        i = after[i]
    return out


def packed(batches) -> Iterator[pa.RecordBatch]:
    """One compressed value of all words (list of strings) and their ids of a batch."""
    for rb in batches:
        words, ids = pc.list_flatten(rb.column(0)).cast(pa.binary()), pc.list_flatten(rb.column(1)).cast(pa.list_(pa.int32()))
        own, sink = pa.RecordBatch.from_arrays([words, ids], ["words", "ids"]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(own)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["packed"])


class Known:
    """Words whose ids are known: the tokens, and words that were folded before, sent as they were packed and unpacked by the tasks."""

    def __init__(self, path: str, parts: list[bytes]):
        self.path, self.parts = path, parts

    @functools.cached_property
    def arrays(self) -> tuple[pa.Array, pa.Array]:
        """(words, ids)"""
        ranks = ranks_of(self.path)
        one = pa.ListArray.from_arrays(pa.array(np.arange(len(ranks) + 1, dtype=np.int32)), pa.array(list(ranks.values()), pa.int32()))
        words, ids = [pa.array(list(ranks), pa.binary())], [one.cast(pa.list_(pa.int32()))]
        for part in self.parts:
            for rb in pa.ipc.open_stream(part):
                words.append(rb.column(0))
                ids.append(rb.column(1))
        self.parts = []
        return pa.concat_arrays(words), pa.concat_arrays(ids)


class Block:
    """Distinct words of a run of documents, and each document's words by their numbers."""

    def __init__(self, keep: int):
        self.coded: list[pa.DictionaryArray] = []
        self.sizes: list[np.ndarray] = []
        self.kept: list[list[pa.Array]] = [[] for _ in range(keep)]
        self.bytes = 0

    def add(self, rb: pa.RecordBatch, text: int) -> None:
        data, offsets = utf8(rb.column(text))
        _, cps, at = code_points(data, offsets)
        begin = starts(cps, at)
        lead = np.flatnonzero((data & 0xC0) != 0x80) if len(cps) != len(data) else None
        ends = np.append(begin if lead is None else lead[begin], len(data)).astype(np.int32)
        self.coded.append(pa.StringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode())
        self.sizes.append(np.diff(np.searchsorted(begin, at)))
        for i, col in enumerate(self.kept):
            col.append(rb.column(i))
        self.bytes += len(data)

    def words(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words, and the number of each word of the documents; once, what was added is given up."""
        coded, self.coded = pa.chunked_array(self.coded).unify_dictionaries().chunks, []
        return coded[0].dictionary.cast(pa.binary()), np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in coded])

    def row(self, limit: int, path: str, kinds: list[pa.DataType], known: Known) -> pa.RecordBatch:
        (words, of), (names, ids) = self.words(), known.arrays
        long = [w for w in words.filter(pc.greater(pc.binary_length(words), limit)).to_pylist() if w not in ranks_of(path)]
        if long:
            names = pa.concat_arrays([names, pa.array(long, pa.binary())])
            ids = pa.concat_arrays([ids, pa.array([heap_merge(w, ranks_of(path)) for w in long], ids.type)])
        given = ids.take(pc.index_in(words, value_set=names)).cast(pa.list_(pa.int64()))
        distinct = first_states(pc.if_else(given.is_valid(), pa.scalar(b"", pa.binary()), words), path)
        sizes = np.concatenate(self.sizes)
        numbers = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(of.astype(np.int32, copy=False)))
        kept = [pa.concat_arrays(c).cast(k) for c, k in zip(self.kept, kinds)]
        docs = pa.StructArray.from_arrays([*kept, numbers], [*[f"k{i}" for i in range(len(kept))], "words"])
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        return pa.RecordBatch.from_arrays([one(distinct), one(given), one(docs)], ["distinct", "given", "docs"])


def counted_words(docs: DataFrame, path: str, text: str, block: int, limit: int) -> DataFrame:
    """word, n of all pre-tokens that are no tokens, have at most `limit` bytes and occur more than once; counted in blocks before the shuffle."""
    def rows(now: Block) -> Iterator[pa.RecordBatch]:
        words, of = now.words()
        n = np.bincount(of, minlength=len(words))
        tokens = pa.array(list(ranks_of(path)), pa.binary())
        keep = pc.and_(pc.less_equal(pc.binary_length(words), limit), pc.invert(pc.is_in(words, value_set=tokens)))
        out = pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n.astype(np.int64))], ["word", "n"]).filter(keep)
        for at in range(0, out.num_rows, 1 << 14):
            yield out.slice(at, 1 << 14)

    def run(batches) -> Iterator[pa.RecordBatch]:
        now = Block(0)
        for rb in slices(batches, "t"):
            now.add(rb, 0)
            if now.bytes >= block:
                yield from rows(now)
                now = Block(0)
        if now.sizes:
            yield from rows(now)

    return docs.select(docs[text].cast("string").alias("t")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")


def common_words(docs: DataFrame, path: str, text: str, common: int, block: int, limit: int) -> list[bytes]:
    """Packed words and ids of fewer than `common` words: those that occur more often than the word at that place."""
    counts = cut(counted_words(docs, path, text, block, limit).select("word", (-F.col("n")).alias("down")))
    if counts.count() > common:
        counts = counts.where(F.col("down") < F.lit(kth(counts, ["down"], common)[0]))

    def states(batches) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            yield pa.RecordBatch.from_arrays([rb.column(0), first_states(rb.column(0).cast(pa.binary()), path)], ["word", "state"])

    coded = counts.select("word").mapInArrow(states, "word string, state array<long>")
    # in rows of many words, so that the rank map is unpacked once a row
    grouped = coded.groupBy(F.pmod(F.xxhash64("word"), F.lit(ROWS))).agg(F.collect_list(F.struct("word", "state")).alias("w"))
    folded = unpacked(rank_map(path), "w", lambda pairs, _: F.transform("w", lambda x: fold(pairs, x["state"])))
    return grouped.select(F.transform("w", lambda x: x["word"]).alias("words"), folded.alias("ids")).mapInArrow(packed, "packed binary").toArrow().column(0).to_pylist()


def blocks(docs: DataFrame, path: str, keep: tuple[str, ...], text: str, block: int, fold_limit: int, common: int = 0) -> DataFrame:
    """A row for each block of documents: distinct (first states of words), given (ids of words that are known or long, else null), docs (kept columns and the words' numbers)."""
    inner = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].cast("string").alias("t"))
    own = T.StructType([*inner.schema.fields[:-1], T.StructField("words", T.ArrayType(T.IntegerType()))])
    schema = T.StructType([T.StructField("distinct", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("given", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("docs", T.ArrayType(own))])
    sent = docs.sparkSession.sparkContext.broadcast(Known(path, common_words(docs, path, text, common, block, fold_limit) if common else []))

    def run(batches) -> Iterator[pa.RecordBatch]:
        now, kinds = Block(len(keep)), None
        for rb in slices(batches, "t"):
            kinds = kinds or [c.type for c in rb.columns[:-1]]
            now.add(rb, len(keep))
            if now.bytes >= block:
                yield now.row(fold_limit, path, kinds, sent.value)
                now = Block(len(keep))
        if now.sizes:
            yield now.row(fold_limit, path, kinds, sent.value)

    return inner.mapInArrow(run, schema)


def each_document(docs: DataFrame, path: str, text: str, keep: tuple[str, ...], block: int, fold_limit: int, common: int, results) -> DataFrame:
    """The keep columns of every row, and what results(bytes of ids, ids of a block's distinct words, f) makes of it: it calls f with a
    function that gives a document's columns by name from the numbers of its words. So what is the same for each occurrence of a
    word is made once a block, and wide arrays need not leave it."""
    rows = blocks(docs, path, keep, text, block, fold_limit, common)

    def of_block(document) -> Column:
        kept = lambda d: [d[f"k{i}"].alias(f"k{i}") for i in range(len(keep))]
        return F.transform("docs", lambda d: bind(document(d["words"]), lambda x: F.struct(*kept(d), x.alias("x"))))

    def whole(pairs: Column, pieces: Column) -> Column:
        folded = F.zip_with("distinct", "given", lambda w, g: F.when(g.isNotNull(), g).otherwise(fold(pairs, w)))
        return bind(folded, lambda ids: results(pieces, ids, of_block))

    out = rows.select(F.explode(unpacked(rank_map(path), "docs", whole)).alias("d"))
    return out.select(*[F.col(f"d.k{i}").alias(c) for i, c in enumerate(keep)], "d.x.*")


def encode(docs: DataFrame, path: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block: int = BLOCK_BYTES, fold_limit: int = 128, common: int = COMMON) -> DataFrame:
    """The keep columns and ids (array<bigint>) of every row."""
    def results(_, ids: Column, f) -> Column:
        return f(lambda words: F.struct(F.flatten(F.transform(words, lambda i: F.get(ids, i))).alias("ids")))

    return each_document(docs, path, text, keep, block, fold_limit, common, results)


def digests(docs: DataFrame, path: str, *, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK_BYTES, fold_limit: int = 128, common: int = COMMON) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by spaces), decoded_sha256 (of the decoded bytes)."""
    def results(pieces: Column, ids: Column, f) -> Column:
        # a word's ids as a text, and its decoded bytes, once a block; a document only joins them
        texts = F.transform(ids, lambda x: F.array_join(x.cast("array<string>"), " ").cast("binary"))
        decoded = F.transform(ids, lambda x: decode(pieces, x))
        return bind(texts, lambda t: bind(decoded, lambda b: f(lambda words: document(words, t, b))))

    def document(words: Column, texts: Column, decoded: Column) -> Column:
        raw = decode(decoded, words)

        def columns(t: Column) -> Column:
            spaces = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit("")))
            n = F.when(t == "", 0).otherwise(spaces + 1)
            return F.struct(n.cast("long").alias("n_tokens"), F.sha2(t.cast("binary"), 256).alias("ids_sha256"), F.sha2(raw, 256).alias("decoded_sha256"))

        return bind(joined(words, texts, " "), columns)

    return each_document(docs, path, text, (doc_id,), block, fold_limit, common, results)
