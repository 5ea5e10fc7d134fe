"""Operator 7: fuzzy line deduplication by MinHash.

Lines of at least `shortest` characters take part (the op7 query and the pipeline set 1: all but empty ones; a line
shorter than a shingle has only exact copies). Each distinct line gets a MinHash signature of its character
shingles (the line itself if it is shorter than one), cut into bands; equal band keys make candidate groups; groups with
equal members are taken once. Links are verified by exact Jaccard of the shingle sets: first between each group's centre (the member
found in most groups) and the others (the same pairs mostly come from many bands and are checked once), then, only in groups that still hold more
than one component, between the other members of different components. Shingles are compared as sorted hashes; where the
count is so near the threshold that a collision could matter, as strings. So a large group of similar lines costs few comparisons and
output is linear. Distributed union-find joins the links; the first occurrence (smallest document,
then hash of its text, then line) of each component stays.

Copies of a line are one node from the start (their occurrences are counted with partial sums), so a very frequent line
costs no more than one. Only line hashes and band keys are shuffled for all lines (in packed runs, which Spark moves and orders as few
rows; tasks sort their values); texts only once for each distinct line.

Defined results: null text has no lines; shorter lines always stay; an empty table gives an empty result; rows with
equal id and text keep the same lines, rows that share only one of them lose only their own; a null id comes before all others; extra columns are carried by `apply` only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import code_points, cut, ragged, release, shuffle_partitions, slices, utf8
from .components import Forest, components, star_batch

SHINGLE, BANDS, ROWS, SIMILARITY, SHORTEST = 5, 16, 5, 0.8, 20
#: A band's key goes with a sketch: one bit each of SKETCH signature values outside the band (LOW of them in the key's low
#: bits, the others beside it). At similarity 0.8 a bit differs with probability 0.1, so a pair that shares a band has over
#: APART different bits there with probability 0.003 (and most pairs share several bands, each with other bits); at 0.1,
#: with probability 0.9997. So what unlike lines cost does not grow with their number.
SKETCH, LOW, APART = 56, 24, 12
#: Members of a group that are compared one by one before the rest of it is compared at once; the result does not depend on it.
NEIGHBOURS = 64
#: Shingle hashes that one MinHash step handles at once.
BLOCK = 1 << 16
#: Bytes of text that a task cuts into lines or shingles at once: small enough that the memory of its arrays is used again, not
#: given back and fetched anew. A longer text or line stays whole.
SLICE = 1 << 17
#: Bits of the filter that keeps lines without a candidate out of the text shuffle; its size is fixed.
FILTER_BITS = 1 << 22
#: How far from the threshold the count of shared hashes must be to be taken without the shingles. One colliding 48-bit hash
#: changes it by less than 2; two in one pair of lines do not happen (about 1e-19).
MARGIN = 2
#: Bits of the sets by which pairs that cannot be like are left out before their shingles are compared.
SET_BITS = 2048
#: Bits of two lines' 64-bit sketches that may differ before a pair is compared: at similarity 0.8 more do with probability
#: 1e-4, at 0.1 with probability 0.999.
FAR = 16
MASK = (1 << 64) - 1
#: Members of a centre that one task compares at most, about.
STAR = 512
#: Lines whose keys a task remembers to have sent, to save sending them again; bounds the set's memory.
SENT = 1 << 18
#: Band keys are shuffled in packed runs, one a bucket of bands: so many keys a task packs at once, so many buckets at least
#: (more where there are more partitions), and so many keys, in whole buckets, are sorted at once.
PACK, BUCKETS, RUN = 1 << 19, 1 << 12, 1 << 17


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_240_601).integers(1, 2**32, size=(n, 2), dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def signatures(h: np.ndarray, count: np.ndarray, steps: int) -> np.ndarray:
    """(steps, lines) MinHash values of lines whose shingle hashes (uint32) lie one after the other, count[i] of line i.

    All steps run over one block of whole lines after the other, so that a block stays in the processor's cache. Each step
    permutes the values of the one before it in place, by an odd factor and now and then by a mask."""
    out = np.empty((steps, len(count)), np.uint32)
    edge = np.concatenate([[0], np.cumsum(count)])
    multipliers = _multipliers(steps)
    at = 0
    while at < len(count):
        to = max(at + 1, int(np.searchsorted(edge, edge[at] + BLOCK, "right")) - 1)
        block, first = h[edge[at] : edge[to]], edge[at:to] - edge[at]
        x = block.copy()
        for k, (a, b) in enumerate(multipliers):
            if k % 8 == 0:
                np.bitwise_xor(x, b, out=x)
            np.multiply(x, a, out=x)
            np.minimum.reduceat(x, first, out=out[k, at:to])
        at = to
    return out


def shingle_hashes(cps: np.ndarray, begin: np.ndarray, size: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes of the shingles of lines cps[begin:begin+size], one line after the other, their count a line). A shorter line is one shingle.

    Only the lines' own code points are read. A line has as many hashes as code points (an empty one has one): where no shingle starts, its first hash again."""
    none, count = np.zeros(1, np.uint32), np.maximum(size, 1)
    own = np.concatenate([none[:0], *(cps[a : a + n] if n else none for a, n in zip(begin.tolist(), size.tolist()))])
    out = np.empty(len(own), np.uint32)
    for at in range(0, len(own), BLOCK):
        part = own[at : at + BLOCK + shingle - 1]
        h = np.zeros(len(part), np.uint32)  # of the shingle that starts here, by Horner's rule over shifted arrays
        for k in range(shingle):
            h *= np.uint32(0x9E3779B1)
            h[: max(len(part) - k, 0)] += part[k:]
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA77)
        h ^= h >> np.uint32(13)
        out[at : at + BLOCK] = h[:BLOCK]
    end = np.cumsum(count)
    first = end - count
    whole = size >= shingle
    for k in range(1, shingle):
        out[end[whole] - k] = out[first[whole]]
    for i in np.flatnonzero(~whole).tolist():  # few lines
        out[first[i] : end[i]] = xxhash.xxh32_intdigest(cps[begin[i] : begin[i] + size[i]].tobytes(), 42)
    return out, count


def band_keys(cps: np.ndarray, begin: np.ndarray, size: np.ndarray, shingle: int, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(lines, bands) keys from the MinHash signatures of lines cps[begin:begin+size], and the upper part of their sketches; the low LOW bits of a key are the lower part."""
    low = signatures(*shingle_hashes(cps, begin, size, shingle), bands * rows)
    by_band = low.reshape(bands, rows, -1)
    key, salt = np.zeros((bands, len(size)), np.uint64), np.arange(1, bands + 1, dtype=np.uint64)[:, None]
    for k in range(rows):
        key = (key ^ by_band[:, k]) * np.uint64(0x9E3779B97F4A7C15) + salt
        key ^= key >> np.uint64(29)
    n = min(SKETCH, (bands - 1) * rows)
    weight = np.zeros((2, bands, bands * rows))
    for band in range(bands):
        at = (np.arange(n) + (band + 1) * rows) % (bands * rows)
        weight[0, band, at[:LOW]] = 2.0 ** np.arange(len(at[:LOW]))
        weight[1, band, at[LOW:]] = 2.0 ** np.arange(len(at[LOW:]))
    sketch = (weight @ sketch_bits(low)).astype(np.uint64)  # sums below 2 ** 32: exact
    key = (key & ~np.uint64((1 << LOW) - 1)) | sketch[0]
    return np.ascontiguousarray(key.T).view(np.int64), np.ascontiguousarray(sketch[1].T.astype(np.uint32)).view(np.int32)


def sketch_bits(low: np.ndarray) -> np.ndarray:
    """One bit of each MinHash value."""
    return ((low >> np.uint32(9)) & np.uint32(1)).astype(np.float64)


def sketches(cps: np.ndarray, begin: np.ndarray, size: np.ndarray, shingle: int) -> np.ndarray:
    """64 bits a line, each from another MinHash value. At similarity 0.8 a bit differs with probability 0.1."""
    low = signatures(*shingle_hashes(cps, begin, size, shingle), 64)
    bits = ((low >> np.uint32(9)) & np.uint32(1)).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)[:, None]).sum(0, dtype=np.uint64).view(np.int64)


def lines_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shortest: int = SHORTEST) -> DataFrame:
    """d, t, pos, h of every line that takes part (t, h: XXH64 of the whole text and of the line). A row's first line, or a
    row without lines, is always there, with n_lines (null elsewhere), and with a null h if it takes no part."""
    body = docs[text].cast("string")
    parts = docs.select(docs[doc_id].alias("d"), F.xxhash64(body).alias("t"), F.split(body, "\n").alias("parts"))
    n_lines = F.when(F.col("parts").isNull(), 0).otherwise(F.size("parts")).cast("long")
    lines = parts.select("d", "t", n_lines.alias("n_lines"), "parts").select("d", "t", "n_lines", F.posexplode_outer("parts").alias("pos", "line"))
    first, takes = F.coalesce(F.col("pos") == 0, F.lit(True)), F.coalesce(F.length("line") >= shortest, F.lit(False))
    return lines.where(first | takes).select("d", "t", F.when(first, F.col("n_lines")).alias("n_lines"), "pos", F.when(takes, F.xxhash64("line")).alias("h"))


def shingles(line: str, k: int) -> frozenset[str]:
    return frozenset(line[i : i + k] for i in range(max(1, len(line) - k + 1)))


def plausible(sketch: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which members of groups (of the given sizes, in a row) have a sketch near to another member's.

    Members not yet found near are compared with the next, the one after it, and so on around their group; those that are
    alone after NEIGHBOURS steps with the whole group at once."""
    wide = np.repeat(size, size)
    base = np.repeat(np.cumsum(size) - size, size)
    ok = np.zeros(len(sketch), bool)
    at = np.arange(len(sketch))
    for step in range(1, NEIGHBOURS + 1):
        at = at[~ok[at] & (wide[at] > step)]
        if not len(at):
            return ok
        other = base[at] + (at - base[at] + step) % wide[at]
        near = np.bitwise_count(sketch[at] ^ sketch[other]) <= APART
        ok[at[near]] = ok[other[near]] = True
    for i in at[~ok[at] & (wide[at] > NEIGHBOURS + 1)].tolist():  # alone so far in a large group: all its members
        near = np.bitwise_count(sketch[base[i] : base[i] + wide[i]] ^ sketch[i]) <= APART
        ok[i] = np.count_nonzero(near) > 1
    return ok


def packed_keys(key: np.ndarray, x: np.ndarray, h: np.ndarray, buckets: int):
    """Batches of (bucket, keys, sketches, lines): a row for each bucket of bands, its values' bytes one after the other."""
    own = ((key >> LOW).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(own.astype(np.uint16), kind="stable") if buckets <= 1 << 16 else np.argsort(own)  # 16 bits are sorted by radix
    own = own[order].astype(np.int32)
    edge = np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own))
    pack = lambda v: pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer((edge * v.itemsize).astype(np.int32)), pa.py_buffer(v[order])])
    out = pa.RecordBatch.from_arrays([pa.array(own[edge[:-1]]), pack(key), pack(x), pack(h)], ["bucket", "key", "x", "h"])
    for at in range(0, out.num_rows, 512):
        yield out.slice(at, 512)


def unpacked(col: pa.Array, kind) -> np.ndarray:
    """The values of all rows of a packed column."""
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]].view(kind)


def _groups(packed: DataFrame) -> DataFrame:
    """(g, h): members of band-key groups of two or more distinct lines; g depends on the members only."""
    rows = packed.repartition(shuffle_partitions(packed.sparkSession), "bucket").sortWithinPartitions("bucket")

    def starts(band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.append(True, band[1:] != band[:-1])) if len(band) else np.zeros(0, np.int64)
        return first, np.diff(np.append(first, len(band)))

    def groups(key: np.ndarray, x: np.ndarray, h: np.ndarray):
        order = np.argsort(key)
        key, x, h = key[order], x[order], h[order]
        band = key >> LOW
        _, size = starts(band)
        many = np.repeat(size > 1, size)
        band, key, x, h = band[many], key[many], x[many], h[many]
        order = np.lexsort((h, band))
        band, key, x, h = band[order], key[order], x[order], h[order]
        fresh = np.append(True, (h[1:] != h[:-1]) | (band[1:] != band[:-1]))[: len(h)]
        band, key, x, h = band[fresh], key[fresh], x[fresh], h[fresh]
        sketch = (key & ((1 << LOW) - 1)) | (x.astype(np.int64) & 0xFFFFFFFF) << LOW
        kept = plausible(sketch, starts(band)[1])
        band, h = band[kept], h[kept]
        if not len(band):
            return None
        first, size = starts(band)
        u = h.view(np.uint64)
        g = np.bitwise_xor.reduceat((u ^ (u >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9), first) + size.astype(np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(g, size).view(np.int64)), pa.array(h)], ["g", "h"])

    def run(batches):
        held, n, last = [], 0, None
        for rb in batches:
            if not rb.num_rows:
                continue
            bucket = np.asarray(rb.column(0))
            key, x, h = (unpacked(rb.column(i), kind) for i, kind in ((1, np.int64), (2, np.int32), (3, np.int64)))
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            at = np.append(0, np.cumsum(pc.binary_length(rb.column(1)).to_numpy(zero_copy_only=False) // 8))
            for own, a, b in zip(bucket[first].tolist(), at[first].tolist(), at[np.append(first[1:], len(bucket))].tolist()):
                if n >= RUN and own != last:  # a bucket may go on in another batch
                    if (out := groups(*map(np.concatenate, zip(*held)))) is not None:
                        yield out
                    held, n = [], 0
                held.append((key[a:b], x[a:b], h[a:b]))
                n, last = n + b - a, own
        if held and (out := groups(*map(np.concatenate, zip(*held)))) is not None:
            yield out

    return rows.mapInArrow(run, "g long, h long")


def similar(a: frozenset, b: frozenset, least: float) -> bool:
    small, large = (len(a), len(b)) if len(a) < len(b) else (len(b), len(a))
    return small >= least * large and (both := len(a & b)) >= least * (len(a) + len(b) - both)


def shingle_keys(lines: list[str], k: int) -> list[np.ndarray]:
    """Sorted distinct 48-bit hashes of each line's shingles, for many lines at once."""
    out = []
    for start in range(0, len(lines), 1 << 15):
        part = lines[start : start + (1 << 15)]
        size = np.fromiter(map(len, part), np.int64, len(part))
        cps = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
        begin, count = np.cumsum(size) - size, np.maximum(size - k + 1, 1)
        h = np.empty(len(cps), np.uint64)  # of the shingle that starts here
        for at in range(0, len(cps), BLOCK):
            piece = cps[at : at + BLOCK + k - 1]
            x = np.zeros(len(piece), np.uint64)
            for i in range(k):
                x *= np.uint64(0x9E3779B97F4A7C15)
                x[: max(len(piece) - i, 0)] += piece[i:]
                x ^= x >> np.uint64(32)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            h[at : at + BLOCK] = x[:BLOCK]
        owner = np.repeat(np.arange(len(part)), count)
        own = h[np.minimum(ragged(begin, count), max(len(cps) - 1, 0))] if len(cps) else np.zeros(len(owner), np.uint64)
        for i in np.flatnonzero(size < k).tolist():
            own[int(count[:i].sum())] = xxhash.xxh64_intdigest(part[i].encode("utf-8", "surrogatepass"), 42)
        both = np.sort((owner.astype(np.uint64) << np.uint64(48)) | (own >> np.uint64(16)))
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        edge = np.searchsorted(both, np.arange(len(part) + 1, dtype=np.uint64) << np.uint64(48))
        both &= np.uint64((1 << 48) - 1)
        out += [both[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
    return out


def bit_sets(keys: list[np.ndarray]) -> list[tuple[int, int]]:
    """(bits of the keys by their lowest SET_BITS, how many keys share a bit with an earlier one) of each line."""
    out = []
    for start in range(0, len(keys), 512):
        part = keys[start : start + 512]
        size = np.fromiter(map(len, part), np.int64, len(part))
        flags = np.zeros((len(part), SET_BITS), bool)
        if size.sum():
            flags[np.repeat(np.arange(len(part)), size), np.concatenate(part).astype(np.int64) & (SET_BITS - 1)] = True
        lost = (size - flags.sum(1)).tolist()
        out += [(int.from_bytes(x.tobytes(), "little"), n) for x, n in zip(np.packbits(flags, axis=1, bitorder="little"), lost)]
    return out


def may_be_alike(a: tuple[int, int], b: tuple[int, int], size_a: int, size_b: int, least: float) -> bool:
    """Whether the sets may share enough keys: shared ones share a bit, except those that are lost to another of their own set; so this never says no to like lines."""
    shared = min((a[0] & b[0]).bit_count() + min(a[1], b[1]), size_a, size_b)
    return shared + MARGIN >= least * (size_a + size_b - shared)


def alike(a: np.ndarray, b: np.ndarray, line_a: str, line_b: str, k: int, least: float) -> bool:
    """similar() by the lines' shingle_keys; with the shingles themselves where a colliding hash could change the answer."""
    small, large = (len(a), len(b)) if len(a) < len(b) else (len(b), len(a))
    if small + MARGIN < least * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = np.count_nonzero(both[1:] == both[:-1])
    over = shared - least * (len(a) + len(b) - shared)
    if abs(over) > MARGIN:
        return bool(over > 0)
    return similar(shingles(line_a, k), shingles(line_b, k), least)


def _stars(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(u, v, ok) of pairs (c, h): whether the lines are similar. A centre's text comes before its members' in one sorted run."""
    # a centre with many members is dealt to several tasks, each with the centre's text
    sized = pairs.groupBy("c").agg(F.ceil(F.count("*") / STAR).cast("int").alias("shares"))
    own = sized.join(texts, F.col("c") == F.col("h")).select("c", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("h"), "line", "s")
    rest = pairs.join(sized, "c").join(texts, "h").select("c", F.pmod(F.xxhash64("h"), "shares").cast("int").alias("share"), "h", "line", "s")
    rows = own.unionByName(rest).repartition(shuffle_partitions(pairs.sparkSession), "c", "share").sortWithinPartitions("c", "share", F.col("h").asc_nulls_first()).select("c", "h", "line", "s")

    def run(batches):
        centre, text, sketch, parts = None, "", 0, None
        for rb in slices(batches, "line", SLICE):
            c, h, s = (rb.column(i).to_pylist() for i in (0, 1, 3))
            u, v, ok, near = [], [], [], []  # near: a centre's row, or a member with a sketch that is near to its centre's
            for i in range(len(c)):
                if h[i] is None:
                    centre, sketch = c[i], s[i] & MASK
                    near.append(i)
                elif c[i] == centre:
                    u.append(h[i])
                    v.append(centre)
                    ok.append(False)
                    if ((s[i] & MASK) ^ sketch).bit_count() <= FAR:
                        near.append(i)
            lines = rb.column(2).take(pa.array(near, pa.int64())).to_pylist()
            own = shingle_keys(lines, shingle)
            at = {i: n for n, i in enumerate(near)}
            m = 0
            for i in range(len(c)):
                if h[i] is None:
                    text, parts = lines[at[i]], own[at[i]].copy()
                elif m < len(u) and h[i] == u[m]:
                    n = at.get(i)
                    ok[m] = n is not None and alike(parts, own[n], text, lines[n], shingle, least)
                    m += 1
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(ok, pa.bool_())], ["u", "v", "ok"])

    return rows.mapInArrow(run, "u long, v long, ok boolean")


def _forests(rows: DataFrame, shingle: int, least: float) -> DataFrame:
    """(u, v) links between the known components (column k) of each group g of lines."""
    rows = rows.repartition(shuffle_partitions(rows.sparkSession), "g").sortWithinPartitions("g", "h")

    def run(batches):
        forest, last, held = Forest(), None, {}

        def same(one, two) -> bool:
            return (one[0] ^ two[0]).bit_count() <= FAR and may_be_alike(one[1], two[1], len(one[2]), len(two[2]), least) and alike(one[2], two[2], one[3], two[3], shingle, least)

        def close():
            rest = sorted(held)
            while len(rest) > 1:
                queue, rest = [rest[0]], rest[1:]
                while queue and rest:
                    u = queue.pop()
                    new = {v for v in rest if any(same(one, two) for one in held[u] for two in held[v])}
                    for v in new:
                        forest.join(u, v)
                    queue.extend(new)
                    rest = [v for v in rest if v not in new]

        for rb in slices(batches, "line", SLICE):
            lines = rb.column(4).to_pylist()
            keys = shingle_keys(lines, shingle)
            for g, k, s, line, own, bits in zip(*(rb.column(i).to_pylist() for i in (0, 2, 3)), lines, keys, bit_sets(keys)):
                if g != last:
                    if len(held) > 1:
                        close()
                    if forest.full():
                        yield star_batch(forest.take())
                    held, last = {}, g
                held.setdefault(k, []).append((s & MASK, bits, own.copy(), line))
        if len(held) > 1:
            close()
        yield star_batch(forest.take())

    return rows.select("g", "h", "k", "s", "line").mapInArrow(run, "u long, v long")


def distinct_lines(texts: pa.Array, shortest: int):
    """(string, its code points, start and length of each distinct line of at least `shortest` characters, in their order, XXH64 of each)."""
    data, offsets = utf8(texts)
    string, cps, at = code_points(data, offsets)
    if at[-1] != len(cps):  # bytes that are no UTF-8: each text is mended by itself
        data, offsets = utf8(pa.array([None if x is None else x.decode("utf-8", "replace") for x in texts.cast(pa.binary()).to_pylist()], pa.string()))
        string, cps, at = code_points(data, offsets)
    # each text has a line from its start, and one after each of its newlines; places are in bytes, whose hashes need no text encoded again
    newline = np.flatnonzero(data == 10)
    a = np.concatenate([offsets[:-1], newline + 1])
    nth = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, newline, "right") - 1])
    order = np.lexsort((a, nth))
    a, nth = a[order], nth[order]
    b = np.append(a[1:] - 1, 0)
    last = np.append(nth[1:] != nth[:-1], True) if len(nth) else np.zeros(0, bool)
    b[last] = offsets[1:][nth[last]]
    begin, end = a, b
    if len(cps) != len(data):
        inner = np.flatnonzero((data & 0xC0) == 0x80)
        begin, end = a - np.searchsorted(inner, a), b - np.searchsorted(inner, b)
    size = end - begin
    taken = size >= shortest
    begin, size, a, b = begin[taken], size[taken], a[taken], b[taken]
    digest, raw = xxhash.xxh64_intdigest, memoryview(data)
    h = np.array([digest(raw[x:y], 42) for x, y in zip(a.tolist(), b.tolist())], np.uint64)
    one = np.sort(np.unique(h, return_index=True)[1])
    return string, cps, begin[one], size[one], h[one].view(np.int64)


def filter_of(hashes: DataFrame) -> np.ndarray:
    """A bit set of FILTER_BITS bits with those of the hashes (column h) set; at most FILTER_BITS / 64 rows reach the driver."""
    bit = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = hashes.select(F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    got = words.toArrow()
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)
    return out


def links(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, similarity: float = SIMILARITY, shortest: int = SHORTEST) -> DataFrame:
    """(u, v) between distinct lines (by hash): each line with the smallest one of those that links with group centres
    connect it to, and the links found across those components; together they have the components of all verified links."""
    inner = docs.select(docs[text].cast("string").alias("t"))

    buckets = max(BUCKETS, 16 * shuffle_partitions(docs.sparkSession))

    def keys(batches):
        sent, held, n = set(), [], 0
        for rb in slices(batches, "t", SLICE):
            string, cps, begin, size, h = distinct_lines(rb.column(0), shortest)
            new = np.array([x not in sent for x in h.tolist()], bool)  # others' keys are on their way already
            begin, size, h = begin[new], size[new], h[new]
            if len(sent) > SENT:
                sent.clear()
            sent.update(h.tolist())
            if len(h):
                key, x = band_keys(cps, begin, size, shingle, bands, rows)
                held.append((key.ravel(), x.ravel(), np.repeat(h, bands)))
                n += key.size
            if n >= PACK:
                yield from packed_keys(*map(np.concatenate, zip(*held)), buckets)
                held, n = [], 0
        if held:
            yield from packed_keys(*map(np.concatenate, zip(*held)), buckets)

    found = cut(_groups(inner.mapInArrow(keys, "bucket int, key binary, x binary, h binary")).distinct())
    release(docs.sparkSession)  # the band keys' shuffle
    # a group's centre is the member found in most groups: the text that the others are variants of
    degree = found.groupBy("h").agg(F.count("*").alias("n"))
    centre = found.join(degree, "h").groupBy("g").agg(F.max(F.struct("n", "h")).alias("c")).select("g", F.col("c.h").alias("c"))
    members = cut(found.join(centre, "g"))
    wanted = members.select("h").distinct()
    mask = filter_of(wanted)

    def candidates(batches):
        for rb in slices(batches, "t", 2 * SLICE):
            string, cps, begin, size, h = distinct_lines(rb.column(0), shortest)
            bit = h & (FILTER_BITS - 1)
            on = ((mask[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            lines = [string[a : a + n] for a, n in zip(begin[on].tolist(), size[on].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(h[on]), pa.array(lines, pa.string()), pa.array(sketches(cps, begin[on], size[on], shingle))], ["h", "line", "s"])

    own = inner.mapInArrow(candidates, "h long, line string, s long").groupBy("h").agg(F.first("line").alias("line"), F.first("s").alias("s"))
    texts = cut(own.join(wanted, "h", "left_semi"))
    release(docs.sparkSession)
    pairs = members.where("c != h").select("c", "h").distinct()
    checked = cut(_stars(pairs, texts, shingle, similarity))
    release(docs.sparkSession)
    sure = checked.where("ok").select("u", "v")
    # a group whose members are one component by now is settled; in the others the members besides the centre, whose pairs are all known, are compared across components
    known = cut(components(sure))
    failed = checked.where(~F.col("ok")).select(F.col("u").alias("h"), F.col("v").alias("c"))
    open_ = members.join(failed, ["h", "c"], "left_semi").select("g").distinct()
    left = members.where("c != h").select("g", "h").join(open_, "g", "left_semi").join(known, F.col("h") == F.col("node"), "left")
    left = cut(left.select("g", "h", F.coalesce("component", "h").alias("k")))
    apart = left.groupBy("g").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a != b").select("g")
    more = _forests(left.join(apart, "g", "left_semi").join(texts, "h"), shingle, similarity)
    return known.where("node != component").select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)


def _repeated(docs: DataFrame, text: str, doc_id: str, shortest: int = SHORTEST, **settings) -> tuple[DataFrame, DataFrame]:
    """(lines_of() the documents, checkpointed, repeated() of them)."""
    groups = components(links(docs, text=text, doc_id=doc_id, shortest=shortest, **settings))
    rows = cut(lines_of(docs, text, doc_id, shortest))  # read three times
    lines = rows.where("h is not null").select("d", "t", "pos", "h")
    times = lines.groupBy("h").agg(F.count("*").alias("n"))
    many = times.join(groups, times.h == groups.node, "left").where("component is not null or n > 1")
    many = cut(many.select("h", F.coalesce("component", "h").alias("component")))  # by itself, so that Spark can split a frequent line's rows in the join below
    # lines that are alone in their component go before places are compared; a line without links has its own hash as component
    some = cut(lines.join(many, "h").select("d", "t", "pos", "component"))
    best = cut(some.groupBy("component").agg(F.min(F.struct("d", "t", "pos")).alias("best")))  # by itself, as above
    found = some.join(best, "component").where(~(F.col("best.d").eqNullSafe(F.col("d")) & (F.col("best.t") == F.col("t")) & (F.col("best.pos") == F.col("pos"))))
    return rows, found.select("d", "t", "pos", "component", F.col("best.d").alias("keep_doc"), F.col("best.pos").alias("keep_pos"))


def repeated(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """d, t, pos, component, keep_doc, keep_pos of every line that is not the first of its component; d and t name the row."""
    return _repeated(docs, text, doc_id, **settings)[1]


def report(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """One row a document: doc_id, n_lines, n_removed, removed (line numbers from 0, with the document and line that stay)."""
    rows, gone = _repeated(docs, text, doc_id, **settings)
    gone = gone.groupBy("d", "t").agg(F.array_sort(F.collect_set(F.struct("pos", "keep_doc", "keep_pos"))).alias("removed"))
    base = rows.where("n_lines is not null").select("d", "t", "n_lines")
    out = base.join(gone, base.d.eqNullSafe(gone.d) & (base.t == gone.t), "left").select(base.d.alias(doc_id), "n_lines", "removed")
    none = F.array().cast(gone.schema["removed"].dataType)
    return out.select(doc_id, "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", none).alias("removed"))


def apply(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """The documents with repeated lines taken out of their text; all rows and columns stay."""
    gone = repeated(docs, text=text, doc_id=doc_id, **settings).groupBy("d", "t").agg(F.collect_set("pos").alias("gone_"))
    joined = docs.join(gone, docs[doc_id].eqNullSafe(gone.d) & (F.xxhash64(docs[text].cast("string")) == gone.t), "left")
    # positions that stay by one hashed difference; the lines are split once, then picked by place
    stay = F.array_except(F.sequence(F.lit(0), F.size(F.split(docs[text], "\n")) - 1), F.transform("gone_", lambda i: i.cast("int")))
    both = F.struct(F.split(docs[text], "\n").alias("lines"), stay.alias("stay"))
    left = F.element_at(F.transform(F.array(both), lambda b: F.array_join(F.transform(b["stay"], lambda i: F.get(b["lines"], i)), "\n")), 1)
    new = F.when(F.col("gone_").isNull() | docs[text].isNull(), docs[text]).otherwise(left)
    return joined.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns])
