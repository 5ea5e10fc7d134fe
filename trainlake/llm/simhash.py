"""Operator 3: SimHash near-duplicates with pigeonring filtering.

Fingerprints are cut into m segments on a ring. If two differ in at most t bits, some segment starts a chain in which
every run of l consecutive segments differs in at most l*t/m bits (the pigeonring principle). Candidates are therefore
keyed by a chain's first segments, which must be equal, and by the next ones with the one that may hold the allowed
difference masked out. Within a key's group the chain condition is tested before the full Hamming distance.

Equal fingerprints are one node. A group's links are found by growing components from one member (a member is compared
only with those not yet reached), so a group gives a spanning forest, never all its pairs. The members of a group above
`limit` are keyed again by a finer, again complete, set of tables, so that at larger scale groups stay small.

Defined results: null or empty text, or only white space, has fingerprint zero, linked like any other; fewer words than
a shingle are one shingle; repeated rows and copies share a component; a null id is never a component's name unless all
ids of the component are null; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, hot_join, shuffle_partitions, slices, utf8
from .components import Forest, components, star_batch

BITS = 64


def fingerprints(texts: pa.Array, words: int, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if it is set in over half of the XXH64 of all shingles."""
    data, offsets = utf8(texts)
    raw, off = data.tobytes(), offsets.tolist()
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i in range(len(texts)):
        parts = raw[off[i] : off[i + 1]].lower().split()
        if len(parts) <= words:
            if parts:
                hashes.append(digest(b" ".join(parts), seed))
                counts[i] = 1
            continue
        joined = b" ".join(parts)
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        begin = [0, *(gaps[: len(parts) - words] + 1).tolist()]
        end = [*gaps[words - 1 :].tolist(), len(joined)]
        hashes += [digest(joined[a:b], seed) for a, b in zip(begin, end)]
        counts[i] = len(begin)
    out = np.zeros(len(texts), np.uint64)
    if not hashes:
        return out
    h = np.array(hashes, np.uint64)
    owner = np.repeat(np.arange(len(texts)), counts)
    table = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    for byte in range(8):
        value = ((h >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)
        set_ = np.bincount(owner * 256 + value, minlength=256 * len(texts)).reshape(-1, 256) @ table
        on = 2 * set_ > counts[:, None]
        for k in range(8):
            out |= on[:, k].astype(np.uint64) << np.uint64(8 * byte + k)
    return out


def edges_of(m: int) -> list[int]:
    return [round(i * BITS / m) for i in range(m + 1)]


def segment_masks(m: int) -> list[int]:
    e = edges_of(m)
    return [(1 << e[i + 1]) - (1 << e[i]) for i in range(m)]


def chain_tables(m: int, t: int) -> list[int]:
    """Masks of the keys that the pigeonring's chains give: leading segments without difference, then those that share one difference, each left out in turn."""
    seg = segment_masks(m)
    lead = next(n for n in range(1, m + 1) if (n + 1) * t // m >= 1)
    last = next(n for n in range(lead + 1, m + 1) if n == m or (n + 1) * t // m >= 2)
    out = []
    for start in range(m):
        ring = [seg[(start + k) % m] for k in range(last)]
        for left_out in range(lead, last):
            out.append(sum(ring) - ring[left_out])
    return out


def block_tables(m: int, t: int) -> list[int]:
    """Masks of all choices of m - t blocks: two fingerprints within t bits are equal on one of them."""
    seg = segment_masks(m)
    return [sum(c) for c in combinations(seg, m - t)]


def viable(diff: np.ndarray, m: int, t: int) -> np.ndarray:
    """Which XORs have a start from which every run of l segments differs in at most l*t/m bits."""
    parts = np.stack([np.bitwise_count(diff & np.uint64(s)) for s in segment_masks(m)]).astype(np.int16)
    ok = np.ones((m, len(diff)), bool)
    run = np.zeros((m, len(diff)), np.int16)
    for length in range(1, m + 1):
        run += np.roll(parts, 1 - length, axis=0)
        ok &= run * m <= length * t
    return ok.any(0)


def forest_of(values: np.ndarray, m: int, t: int):
    """Links (a spanning forest) between the values of one group; every linked pair of the group ends in one tree."""
    rest = values
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.zeros(len(rest), bool)
            diff = rest ^ x
            maybe = np.flatnonzero(viable(diff, m, t)) if len(rest) > 0 else np.zeros(0, int)
            near[maybe[np.bitwise_count(diff[maybe]) <= t]] = True
            if near.any():
                new = rest[near]
                rest = rest[~near]
                for y in new:
                    yield x, y
                queue.extend(new)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _groups(nodes: DataFrame, masks: list[int], m: int, t: int, limit: int | None) -> DataFrame:
    """(u, v) links found in the groups of these key tables; u = v marks a member of a group over the limit."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("f").bitwiseAND(F.lit(_signed(k))).alias("key")) for i, k in enumerate(masks)]))
    rows = nodes.select("f", keys.alias("k")).select("k.i", "k.key", "f")
    rows = rows.repartition(shuffle_partitions(nodes.sparkSession), "i", "key").sortWithinPartitions("i", "key")

    def run(batches):
        forest, held, over = Forest(), [], False
        last = None

        def close():
            if over or not held:
                return
            values = np.concatenate(held)
            if len(values) > 1:
                for a, b in forest_of(values.view(np.uint64), m, t):
                    forest.join(int(np.int64(a.view(np.int64))), int(np.int64(b.view(np.int64))))

        def big(values):
            return pa.RecordBatch.from_arrays([pa.array(values)] * 2, ["u", "v"])

        for rb in batches:
            i, key, f = (np.asarray(rb.column(k)) for k in range(3))
            if not len(f):
                continue
            change = np.flatnonzero((i[1:] != i[:-1]) | (key[1:] != key[:-1])) + 1
            first = np.concatenate([[0], change])
            end = np.append(change, len(f))
            # groups of one are skipped without a step each; the first and last may go on in another batch
            busy = (end - first > 1) | (first == 0) | (end == len(f))
            for a, b in zip(first[busy].tolist(), end[busy].tolist()):
                own = (i[a], key[a])
                if own != last:
                    close()
                    if forest.full():
                        yield star_batch(forest.take())
                    held, over, last = [], False, own
                if over:
                    yield big(f[a:b])
                    continue
                held.append(f[a:b])
                if limit is not None and sum(map(len, held)) > limit:
                    yield big(np.concatenate(held))
                    held, over = [], True
        close()
        yield star_batch(forest.take())

    return rows.mapInArrow(run, "u long, v long")


def balls(nodes: DataFrame, bits: int) -> DataFrame:
    """Links (u, v) that connect all pairs within an even number of bits, whatever the size of a crowd.

    Each fingerprint gives a row for every value within half the bits; two are within `bits` just if they share such a value,
    so each value's fingerprints are linked to its smallest. The work grows with the fingerprints, not with their pairs."""
    flips = np.array([sum(1 << x for x in c) for n in range(bits // 2 + 1) for c in combinations(range(BITS), n)], np.uint64)

    def run(batches):
        for rb in batches:
            f = np.asarray(rb.column(0)).view(np.uint64)
            for at in range(0, len(f), 64):
                own = f[at : at + 64]
                yield pa.RecordBatch.from_arrays([pa.array((own[:, None] ^ flips[None, :]).ravel().view(np.int64)), pa.array(np.repeat(own, len(flips)).view(np.int64))], ["key", "u"])

    rows = nodes.select("f").mapInArrow(run, "key long, u long")
    least = rows.groupBy("key").agg(F.min("u").alias("v"), F.max("u").alias("w")).where("v != w").select("key", "v")
    return rows.join(least, "key").where("u != v").select("u", "v").distinct()


def links(nodes: DataFrame, *, bits: int = 4, segments: int = 12, fine_segments: int = 8, limit: int = 4096, most: int = 1 << 15) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column f, long) that connect all pairs within `bits`.

    Groups of more than `limit` are keyed again by finer tables, and crowds of more than `most` there by balls (for an even
    number of bits; for an odd one they are compared in one task)."""
    found = cut(_groups(nodes, chain_tables(segments, bits), segments, bits, limit))
    crowd = found.where("u = v").select(F.col("u").alias("f")).distinct()
    if bits % 2:
        return found.where("u != v").unionByName(_groups(crowd, block_tables(fine_segments, bits), segments, bits, None))
    more = cut(_groups(crowd, block_tables(fine_segments, bits), segments, bits, most))
    every = found.unionByName(more).where("u != v")
    dense = more.where("u = v").select(F.col("u").alias("f")).distinct()
    return every if dense.isEmpty() else every.unionByName(balls(dense, bits))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = 4, bits: int = 4, limit: int = 4096) -> DataFrame:
    """doc_id, f (fingerprint as long), component_id (smallest id reachable by links of at most `bits` differing bits)."""
    inner = docs.select(docs[doc_id].alias("d"), docs[text].cast("string").alias("t"))
    schema = T.StructType([inner.schema[0], T.StructField("f", T.LongType())])

    def run(batches):
        for rb in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(fingerprints(rb.column(1), words).view(np.int64))], ["d", "f"])

    marked = cut(inner.mapInArrow(run, schema))
    # copies are one node; the smallest id of each is gathered with partial sums, so a large group moves few rows
    nodes = cut(marked.groupBy("f").agg(F.min("d").alias("least"), F.count("*").alias("n")))
    groups = components(links(nodes.select("f"), bits=bits, limit=limit))
    named = cut(nodes.join(groups, nodes.f == groups.node, "left").select("f", "least", "n", F.coalesce("component", "f").alias("c")))
    names = named.groupBy("c").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    of = cut(hot_join(named, names, "c").select("f", "component_id", "n"))
    return hot_join(marked, of, "f").select(F.col("d").alias(doc_id), "f", "component_id")


def hexadecimal(f):
    """16 lower-case hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(f), 16, "0"))
