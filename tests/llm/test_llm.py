"""The operators against brute force, and on nulls, empty texts, ties, repeated rows, empty tables and extra columns."""

import itertools
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from trainlake.llm import decontamination, language, line_dedup, link_trust, packing, quality, simhash, token_counts, toxicity, winnowing
from trainlake.llm.common import utf8
from trainlake.llm.components import components
from trainlake.llm.crf import Chain
from trainlake.llm.fm_index import FMIndex
from trainlake.llm.pretokens import Hasher

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ODD = ["", None, "a", " ", "it's  'll\n\n x''s", "a<|endoftext|> b", "a" * 3000, "ünï　😀 x\x85y", "same text here", "same text here", "The cat sat. " * 30 + "\nThe cat sat."]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", "s", i, "clash") for i, t in enumerate(ODD)] + [(None, "null id", None, None, None, None), (3, "again", "de", "s", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_token_counts(odd):
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in token_counts.token_counts(odd, PATH).collect()}
    for i, t in enumerate(ODD):
        assert got[i, len((t or "").encode())] == len(ids(t)), t


def test_packing(odd, docs):
    for table in (odd.where("doc_id is not null").dropDuplicates(["doc_id"]), docs):
        want = {r.doc_id: ids(r.text) + [1] for r in table.collect()}
        rows = packing.pack(table, PATH).collect()
        ends, at = dict.fromkeys(want, 0), {}
        for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
            own = want[r.doc_id][r.start : r.start + r.length]
            assert ends[r.doc_id] == r.start and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
            ends[r.doc_id] += r.length
        assert all(ends[d] == len(w) for d, w in want.items())
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert at.get(r.sequence_id, 0) == r.offset
            at[r.sequence_id] = r.offset + r.length
        assert all(n <= 2048 and n & (n - 1) == 0 for n in at.values())


def brute_winnow(text, k, w):
    if not text:
        return []
    n = max(1, len(text) - k + 1)
    h = Hasher()(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.arange(n), np.full(n, min(k, len(text)))).tolist()
    return sorted({max((a + i for i, x in enumerate(h[a : a + w]) if x == min(h[a : a + w]))) for a in range(max(1, n - w + 1))})


@pytest.mark.parametrize("text", ["", "a", "abc" * 40, "a" * 90, "the quick brown fox jumps over the lazy dog " * 4 + "!"])
def test_winnowing(text):
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    for k, w in ((5, 4), (16, 33), (3, 7)):
        assert winnowing.winnow(cps, np.array([0, len(text)]), k, w, Hasher())[1].tolist() == brute_winnow(text, k, w)


def test_winnowing_next(odd):
    rows = winnowing.compare_with_next(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows if r.doc_id not in (None, 3)}
    assert by[8].fingerprint == by[9].fingerprint and by[9].near_next == 1.0 and by[0].fingerprint == "" and by[2].n_chars == 1


def brute_simhash(text, words):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), 42) for i in range(max(1, len(parts) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(odd, docs):
    texts = ODD + [r.text for r in docs.collect()]
    assert simhash.fingerprints(pa.array(texts, pa.string()), 4).tolist() == [brute_simhash(t, 4) for t in texts]
    rows = simhash.near_duplicates(odd).collect()
    got = {r.doc_id: r.component_id for r in rows if r.doc_id not in (None, 3)}
    assert got[8] == got[9] == 8 and got[0] == got[1] == 0 and len(rows) == odd.count()
    assert sorted(r.component_id for r in rows if r.doc_id == 3)[0] == 0


def test_simhash_links(spark):
    rng = np.random.default_rng(3)
    values = set()
    for base in rng.integers(0, 2**63, 6).tolist():
        for _ in range(60):
            x = base
            for b in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                x ^= 1 << b
            values.add(x)
    v = np.array(sorted(values), np.uint64)
    nodes = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "f long")
    parent = list(range(len(v)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(v)), 2):
        if (int(v[i]) ^ int(v[j])).bit_count() <= 4:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    want = {frozenset(int(v.view(np.int64)[i]) for i in range(len(v)) if find(i) == r) for r in {find(i) for i in range(len(v))}}
    for limit, most in ((4096, 1 << 15), (10, 1 << 15), (10, 20), (2, 1)):
        got: dict = {}
        for r in components(simhash.links(nodes, limit=limit, most=most)).collect():
            got.setdefault(r.component, set()).add(r.node)
        assert {frozenset(x) for x in got.values()} == {w for w in want if len(w) > 1}


def test_crf_marginals():
    rng = np.random.default_rng(1)
    scores, first = rng.normal(size=9), np.array([1, 0, 0, 0, 1, 1, 0, 0, 0], bool)
    chain = Chain(rng.normal(size=(2, 2)), rng.normal(size=2))
    want = []
    for s in (scores[:4], scores[4:5], scores[5:]):
        total, ones = 0.0, np.zeros(len(s))
        for y in itertools.product((0, 1), repeat=len(s)):
            e = np.exp(chain.start[y[0]] + sum(a * b for a, b in zip(s, y)) + sum(chain.edges[a, b] for a, b in zip(y, y[1:])))
            total, ones = total + e, ones + e * np.array(y)
        want.append(ones / total)
    assert np.allclose(chain.marginals(scores, first), np.concatenate(want))


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers(spark, odd, module, label):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = module.train(docs, labels)
    rows = module.score(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) > 0.9
    out = module.score(odd, model).collect()
    assert len(out) == odd.count() and all(0 <= r.score <= 1 for r in out)
    untrained = module.score(odd, module.train(docs.limit(0), labels.limit(0))).collect()
    assert len(untrained) == odd.count()


def test_language(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = language.train(docs)
    rows = language.identify(docs, p).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    got = {r.doc_id: r.lang_pred for r in language.identify(odd, p).collect()}
    assert got[0] == got[1] == "und" and got[8] == got[9] != "und"
    assert {r.lang_pred for r in language.identify(odd, language.train(docs.limit(0))).collect()} == {"und"}


def test_fm_index():
    rng = np.random.default_rng(0)
    text = rng.integers(0, 6, 400)
    text[-1] = 0
    index = FMIndex(text, 6)
    patterns = rng.integers(1, 6, (60, 3))
    low, high = index.search(patterns, np.full(60, 3))
    for p, a, b in zip(patterns, low, high):
        assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(398) if (text[i : i + 3] == p).all()]


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (10, "Same TEXT here"), (2, None), (None, "here")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontamination.judge(decontamination.find(odd, items)).collect()}
    assert rows[8].n_hit == 3 and rows[8].contaminated and rows[8].n_items == 1 and rows[1].n_words == 0 and not rows[2].contaminated
    assert not any(r.contaminated for r in decontamination.judge(decontamination.find(odd, items.limit(0))).collect())


def test_hashed_shingles():
    base, lines = "".join(np.random.default_rng(3).choice(list("abcdé 漢"), 600)), ["", "a", "abcd", "😀" * 30, "x" * 5000]
    rng = np.random.default_rng(4)
    for n in (20, 21, 60, 200, 600) * 20:
        line = list(base[:n])
        for at in rng.integers(0, n, rng.integers(0, n // 15 + 1)):
            line[at] = "x"
        lines.append("".join(line))
    keys = line_dedup.shingle_keys(lines, 5)
    bits = line_dedup.bit_sets(keys)
    for a, b in itertools.combinations(range(len(lines)), 2):
        want = line_dedup.similar(line_dedup.shingles(lines[a], 5), line_dedup.shingles(lines[b], 5), 0.8)
        assert line_dedup.alike(keys[a], keys[b], lines[a], lines[b], 5, 0.8) == want
        assert not want or line_dedup.may_be_alike(bits[a], bits[b], len(keys[a]), len(keys[b]), 0.8)
    assert line_dedup.shingle_keys([], 5) == []


def test_line_dedup(spark, odd):
    a = "a line that is long enough to take part in this, with many words of its own kind"
    rows = spark.createDataFrame([(1, a + "\nshort"), (2, "short\n" + a.replace("many", "some")), (3, a), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.report(rows).collect()}
    assert got == {1: (2, 0), 2: (2, 1), 3: (1, 1), 4: (0, 0), 5: (1, 0)}
    assert {r.doc_id: r.text for r in line_dedup.apply(rows).collect()} == {1: a + "\nshort", 2: "short", 3: "", 4: None, 5: ""}
    assert line_dedup.apply(odd).columns == odd.columns and line_dedup.report(rows.limit(0)).count() == 0


def test_link_trust(spark):
    pages = spark.createDataFrame([
        (1, "http://Good.com/a", '<a href="http://b.org/x">'), (2, "https://b.org/", ""), (3, "http://s.net/fr/", ""), (4, "http://c.org/", '<a href="//s.net/z">'),
        (5, None, None), (6, "nothing", None), (7, "http://www.example.com/en/1", None), (8, "http://x.example.com/en/1", None), (9, "http://a.net/es?x", None),
    ], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in link_trust.judge(pages).collect()}
    assert got[1] == ("good.com", "/a", "com/", "allow") and got[2][3] == "allow" and got[3][2:] == ("net/fr/", "block") and got[4][3] == "block"
    assert got[5] == got[6] == ("", "", None, "allow") and got[7][2] == "www.example.com/en/" and got[8][2:] == ("example.com/en/", "block") and got[9][2] is None


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {r.length for r in rows} and len(corpus_pipeline.STAGES) == 5


def test_line_dedup_sketches():
    rng = np.random.default_rng(5)
    size = np.array([2, 3, 40, 5, 2, 32, 2, 300])
    sketch = rng.integers(0, 1 << line_dedup.SKETCH, size.sum())
    sketch[1] = sketch[0] ^ 0b111  # three bits apart
    sketch[-300:] = np.repeat([0, (1 << 56) - 1, (1 << 28) - 1], [298, 1, 1])  # two alone in a large group
    at = np.repeat(np.arange(len(size)), size)
    want = [any(j != i and at[i] == at[j] and bin(int(sketch[i] ^ sketch[j])).count("1") <= line_dedup.APART for j in range(len(sketch))) for i in range(len(sketch))]
    assert line_dedup.plausible(sketch, size).tolist() == want and want[0] and want[1] and not want[-1]
    none = np.zeros(0, np.int64)
    assert line_dedup.plausible(none, none).tolist() == []


def test_packed_band_keys(spark):
    """Band keys move in few rows, and give the groups that a plain search over the single keys gives."""
    rng = np.random.default_rng(3)
    band = rng.integers(-(1 << 39), 1 << 39, 3000)[rng.integers(0, 3000, 20_000)]
    key, x, h = band << line_dedup.LOW | rng.integers(0, 4, len(band)), np.zeros(len(band), np.int32), rng.integers(0, 5000, len(band))
    rows = [rb for part in np.array_split(np.arange(len(key)), 3) for rb in line_dedup.packed_keys(key[part], x[part], h[part], 8)]
    assert sum(rb.num_rows for rb in rows) == 24
    frame = spark.createDataFrame(pa.Table.from_batches(rows))
    assert frame.schema.simpleString() == "struct<bucket:int,key:binary,x:binary,h:binary>"
    want = {}
    for k, one in zip(key.tolist(), h.tolist()):
        want.setdefault(k >> line_dedup.LOW, set()).add(one)
    got = {}
    for r in line_dedup._groups(frame).collect():
        got.setdefault(r.g, []).append(r.h)
    assert sorted(map(sorted, map(set, got.values()))) == sorted(map(sorted, {frozenset(w) for w in want.values() if len(w) > 1}))


def test_line_dedup_reads_few(spark):
    """The report takes its rows from the checkpointed lines, not from the texts again; hashes are made of the asked lines alone."""
    plan = line_dedup.report(spark.read.parquet(f"{SF}/documents.parquet"), shortest=1)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and "parquet" not in plan
    cps = np.random.default_rng(3).integers(32, 127, 1 << 20).astype(np.uint32)
    begin, size = np.array([0, 1000, 500_000, len(cps) - 3]), np.array([7, 8000, 0, 3])
    tracemalloc.start()
    hashes, count = line_dedup.shingle_hashes(cps, begin, size, 5)
    assert tracemalloc.get_traced_memory()[1] < 2 << 20
    tracemalloc.stop()
    assert count.tolist() == [7, 8000, 1, 3] and len(hashes) == count.sum()
    for k, (a, n) in enumerate(zip(begin.tolist(), size.tolist())):  # by itself, or with others: the same shingles
        alone = line_dedup.shingle_hashes(cps[a : a + n], np.array([0]), np.array([n]), 5)[0]
        assert set(alone.tolist()) == set(hashes[count[:k].sum() : count[: k + 1].sum()].tolist()) and len(set(alone.tolist())) == max(1, n - 4)

    assert [len(x) for x in line_dedup.shingle_keys(["ab"], 5)] == [1]
    long = "".join(map(chr, cps[: line_dedup.BLOCK + 2]))  # ends with a piece of fewer code points than a shingle
    assert line_dedup.shingle_keys([long], 5)[0].size == len({long[i : i + 5] for i in range(len(long) - 4)})


def test_line_dedup_broken_bytes():
    texts = pa.array([b"a\x80b\nxx", b"", None, "é\nyy".encode(), b"zz\xe6"], pa.binary()).view(pa.string())
    string, cps, begin, size, h = line_dedup.distinct_lines(texts, 1)
    lines = [string[a : a + n] for a, n in zip(begin.tolist(), size.tolist())]
    assert lines == ["a\ufffdb", "xx", "é", "yy", "zz\ufffd"]
    assert h.view(np.uint64).tolist() == [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]


def test_line_dedup_recall(spark):
    """Candidates against all pairs: every pair of like lines is in one component."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = sorted({x for r in docs.collect() for x in (r.text or "").split("\n") if x})
    sets = [line_dedup.shingles(x, 5) for x in lines]
    by: dict = {}
    for i, own in enumerate(sets):
        for x in own:
            by.setdefault(x, []).append(i)
    seen, pairs = set(), []
    for i, own in enumerate(sets):
        for j in {j for x in own for j in by[x] if j > i}:
            if line_dedup.similar(own, sets[j], 0.8):
                pairs.append((i, j))
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.d: r.component for r in line_dedup.repeated(rows, shortest=1).collect()}
    keep = {r.component: r.keep_doc for r in line_dedup.repeated(rows, shortest=1).collect()}
    of = {**{d: keep[c] for d, c in got.items()}, **{k: k for k in keep.values()}}
    found = sum(i in of and j in of and of[i] == of[j] for i, j in pairs)
    assert len(pairs) > 30 and found >= 0.99 * len(pairs), (found, len(pairs))


def test_line_dedup_query_takes_short_lines(spark, tmp_path):
    import corpus_pipeline
    from trainlake.llm.queries import QUERIES

    rows = [(1, "Les.\n\none line of its own"), (2, "Les.\n\nanother text, not like it\nLes."), (3, "x\nshort boilerplate 1"), (4, "y\nx\nshort boilerplate 1\nshort boilerplate 1z")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: [x.pos for x in r.removed] for r in QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: [], 2: [0, 3], 3: [], 4: [1, 2, 3]}
    left = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, docs, str(tmp_path)).collect()}
    assert left == {1: (rows[0][1], 25), 2: ("\nanother text, not like it", 26), 3: (rows[2][1], 21), 4: ("y", 1)}


def test_near_copies_null_and_repeated_ids(spark):
    import corpus_pipeline

    rng = np.random.default_rng(8)
    t = [" ".join(f"w{x}" for x in rng.integers(0, 9999, 60)) for _ in range(6)]
    rows = [(1, t[0]), (2, t[0]), (None, t[0]), (None, t[1]), (None, t[2]), (None, t[2]), (3, t[3]), (3, t[4]), (4, t[4]), (5, t[5]), (5, t[5]), (6, None), (None, "")]
    docs = spark.createDataFrame([(i, x, "en") for i, x in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.near_copies(spark, docs, SF)
    want = [(1, t[0]), (None, t[1]), (None, t[2]), (3, t[3]), (3, t[4]), (5, t[5]), (6, None)]
    assert got.columns == docs.columns and sorted(map(repr, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(repr, want))


def test_line_dedup_by_row(spark):
    a, b, c, x, y = (f"{w} line of many words, long enough to take part, about {w} only" for w in ("apple", "brick", "cedar", "xenon", "yacht"))
    rows = [(None, f"{a}\n{x}"), (None, f"{b}\n{a}"), (7, f"{c}\n{y}"), (7, f"{y}\nclean\n{c}"), (8, c), (9, None), (None, None), (5, f"{a}\nown"), (5, f"{a}\nown")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.apply(docs).collect()
    assert len(got) == len(rows)
    left = sorted(line for r in got for line in (r.text or "").split("\n") if line)
    # each of a, b, c, x, y is left exactly once, and clean rows lose nothing
    assert left == sorted([a, b, c, x, y, "clean", "own", "own"])
    report = line_dedup.report(docs).collect()
    assert len(report) == len(rows) and sum(r.n_removed for r in report) == 1 + 2 + 1 + 2
    assert sorted(r.n_removed for r in report if r.doc_id is None) == [0, 0, 1]


def test_rank_reaches_far_hosts(spark):
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(24)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("h0", 1.0)], "host string, w double")
    got = {r.host: r.rank for r in link_trust.rank(edges, seeds, tolerance=0.02).collect()}
    assert got["h24"] > 0 and abs(sum(got.values()) - 1) < 1e-9
    with pytest.raises(RuntimeError):
        link_trust.rank(edges, seeds, rounds=3)
