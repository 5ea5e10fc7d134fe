"""Operator 1: winnowing fingerprints.

Rolling hashes of all k-grams of code points; in each window of w consecutive k-grams the smallest hash is chosen, the
rightmost of equal ones; choices are kept with their positions. So two texts that share a passage of at least k + w - 1
code points share a chosen hash. A text with fewer than w k-grams is one window; one shorter than k is one gram.

Likeness of two fingerprints is the Jaccard index of their sets of hashes (1 for two empty ones).

Defined results: null text is empty, and an empty text has the empty fingerprint; equal texts have equal fingerprints;
rows with equal ids are ordered by the hash of their text; null ids come last; ids that are no integers fail the query
(compare_with_next orders by number; fingerprint takes any id); extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import shuffle_partitions
from .pretokens import Hasher

GRAM, WINDOW = 16, 33


def slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every window of width values; the result is shorter by width - 1."""
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[: len(out) - have], out[have:])
        have *= 2
    if have < width:
        out = pick(out[: len(values) - width + 1], out[width - have : width - have + len(values) - width + 1])
    return out


def winnow(cps: np.ndarray, offsets: np.ndarray, gram: int, window: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, positions in their text, offsets by text) chosen in the texts cps[offsets[i]:offsets[i+1]]."""
    size = np.diff(offsets)
    grams = np.where(size == 0, 0, np.maximum(size - gram + 1, 1))
    total = int(grams.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(size) + 1, np.int64)
    base = np.cumsum(grams) - grams
    owner = np.repeat(np.arange(len(size)), grams)
    place = np.arange(total) - base[owner]
    h = hasher(cps, offsets[owner] + place, np.minimum(gram, size[owner]))
    top = np.uint64(2**64 - 1)
    # texts are laid out with window - 1 fillers between them, so that no window with a choice spans two texts
    at = np.arange(total) + owner * window + window
    line = np.full(total + (len(size) + 1) * window + window, top)
    line[at] = np.minimum(h, top - np.uint64(1))
    low = slide(line, window, np.minimum)
    # a window counts if it lies within its text; a text with fewer k-grams has one, from its first k-gram
    inside = np.zeros(len(low), bool)
    inside[at] = (place + window <= grams[owner]) | ((place == 0) & (grams[owner] < window))
    won = np.where(inside, low, np.uint64(0))
    best = np.concatenate([np.zeros(window - 1, np.uint64), won])
    best = slide(best, window, np.maximum)  # best[p]: the largest minimum of the windows that hold p
    chosen = np.flatnonzero(line[at] == best[at])
    if len(chosen):  # equal hashes within a window: only the rightmost counts
        values = line[at[chosen]]
        order = np.lexsort((chosen, values))
        same = (values[order][1:] == values[order][:-1]) & (owner[chosen[order]][1:] == owner[chosen[order]][:-1]) & (chosen[order][1:] - chosen[order][:-1] < window)
        left, right = chosen[order][:-1][same], chosen[order][1:][same]
        if len(left):
            # left survives if a window that ends before right has it as minimum
            drop = np.ones(len(left), bool)
            for back in range(window):
                s = at[left] - back
                ok = inside[s] & (s + window <= at[right]) & (low[s] == line[at[left]])
                drop &= ~ok
            chosen = np.setdiff1d(chosen, left[drop], assume_unique=True)
    edge = np.searchsorted(owner[chosen], np.arange(len(size) + 1))
    return h[chosen], place[chosen], edge


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def rendered(h: np.ndarray, place: np.ndarray) -> str:
    """position:hash pairs in order of position."""
    return ",".join([f"{p:x}:{v:016x}" for p, v in zip(place.tolist(), h.tolist())])


def fingerprint(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id and an array of struct(position, hash) for every row; no shuffle."""
    from .common import code_points, slices, utf8

    inner = docs.select(docs[doc_id].alias("d"), docs[text].cast("string").alias("t"))
    kind = T.ArrayType(T.StructType([T.StructField("position", T.LongType()), T.StructField("hash", T.LongType())]))
    schema = T.StructType([inner.schema[0], T.StructField("fingerprint", kind)])

    def run(batches):
        hasher = Hasher()
        for rb in slices(batches, "t"):
            _, cps, at = code_points(*utf8(rb.column(1)))
            h, place, edge = winnow(cps, at, gram, window, hasher)
            pairs = pa.StructArray.from_arrays([pa.array(place), pa.array(h.view(np.int64))], ["position", "hash"])
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pairs)], ["d", "fingerprint"])

    return inner.mapInArrow(run, schema).withColumnRenamed("d", doc_id)


def compare_with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text (its last third replaced from the next document in descending order of id, the last taking the first), with their likeness.

    Ids are cut into ranges by quantiles. The first document of a range is also sent to the range above it, whose last
    document needs it as its next, so each range is worked off on its own in one sorted pass, whatever the number of rows.
    """
    spark = docs.sparkSession
    parts = 4 * shuffle_partitions(spark)
    inner = docs.select(docs[doc_id].cast("long").alias("d"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("t"))
    bounds = inner.agg(F.percentile_approx("d", [i / parts for i in range(1, parts)], 20 * parts)).first()[0] or []
    bounds = sorted(set(bounds))
    # range 0 has the largest ids; null ids come after all
    def range_of(c):
        return F.when(c.isNull(), F.lit(len(bounds) + 1)).otherwise(F.expr(f"size(filter(transform(array({','.join(map(str, bounds)) or 'cast(null as bigint)'}), x -> x >= d), x -> x))") if bounds else F.lit(0))

    ranged = inner.withColumn("r", range_of(F.col("d")))
    first = [(r.r, r.d, r.h) for r in ranged.groupBy("r").agg(F.max(F.struct("d", F.xxhash64("t").alias("h"))).alias("x")).select("r", "x.d", "x.h").collect()]  # one small row a range
    first.sort()
    above = {r: first[k - 1][0] for k, (r, *_) in enumerate(first)}  # the range that needs this one's first document (the last needs the first's)
    if not first:
        copies = ranged.limit(0).withColumn("helper", F.lit(1))
    else:
        small = spark.createDataFrame([(r, above[r], d, h) for r, d, h in first], "r int, to int, hd long, hh long")
        hit = F.broadcast(small)  # one row for each range, at most 4 * shuffle partitions
        copies = ranged.join(hit, "r").where((F.col("d").eqNullSafe(F.col("hd"))) & (F.xxhash64("t") == F.col("hh"))).dropDuplicates(["r"]).select("d", "t", F.col("to").alias("r"), F.lit(1).alias("helper"))
    rows = ranged.withColumn("helper", F.lit(0)).unionByName(copies)
    rows = rows.repartition(shuffle_partitions(spark), "r").withColumn("h", F.xxhash64("t"))
    rows = rows.sortWithinPartitions("r", "helper", F.col("d").desc_nulls_last(), F.col("h").desc())
    rows = rows.select("r", "helper", "d", "t")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def work(ids: list, texts: list[str], hasher: Hasher) -> pa.RecordBatch:
        """Results for all but the last text, which is the next of the one before it."""
        edited = []
        for own, nxt in zip(texts, texts[1:]):
            n = len(own) // 3
            edited.append((own[: len(own) - n] + nxt[:n]) if n else own)
        every = texts + edited
        off = np.concatenate([[0], np.cumsum([len(x) for x in every])]).astype(np.int64)
        cps = np.frombuffer("".join(every).encode("utf-32-le"), np.uint32)
        h, place, edge = winnow(cps, off, gram, window, hasher)
        prints = [(h[edge[i] : edge[i + 1]], place[edge[i] : edge[i + 1]]) for i in range(len(every))]
        n = len(edited)
        cols = [
            ids[:n], [len(x) for x in texts[:n]], [hashlib.sha256(x.encode()).hexdigest() for x in edited],
            [rendered(*prints[i]) for i in range(n)], [rendered(*prints[n + 1 + i]) for i in range(n)],
            [likeness(prints[i][0], prints[n + 1 + i][0]) for i in range(n)], [likeness(prints[i][0], prints[i + 1][0]) for i in range(n)],
        ]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches):
        hasher, ids, texts, size, last = Hasher(), [], [], 0, None
        for rb in batches:
            for r, d, t in zip(rb.column(0).to_pylist(), rb.column(2).to_pylist(), rb.column(3)):
                t = t.as_py()
                if r != last and len(texts) > 0:  # the helper of a range closes it
                    if len(texts) > 1:
                        yield work(ids, texts, hasher)
                    ids, texts, size = [], [], 0
                last = r
                ids.append(d)
                texts.append(t)
                size += len(t)
                if size > 1 << 19 and len(texts) > 1:
                    yield work(ids, texts, hasher)
                    ids, texts, size = [d], [t], len(t)
        if len(texts) > 1:
            yield work(ids, texts, hasher)

    return rows.mapInArrow(run, schema)
