"""Operators 11 to 13 against plain Python versions, the tokenizer library, and on odd tables."""

import collections
import hashlib
import itertools
import math
import pickle
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from trainlake.llm import byte_bpe, phrases, resampling

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, k0 string, t string, words string, n string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), *["x"] * 6) for i, t, g in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- resampling


def brute_resample(docs, target, longest, percent, least):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    features = lambda w: [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = collections.Counter(bucket(f) for _, t, _ in docs for f in features(words(t)))
    t = collections.Counter(bucket(f) for x in target for f in features(words(x)))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000.0) / ((s[b] + 1.0) * (all_t + 10_000.0))))
    out = []
    for i, text, _ in docs:
        f = features(words(text))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, map(bucket, f)))
        out.append((i, len(words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    k = len(able) * percent // 100
    ranks = collections.defaultdict(list)
    for r, x in enumerate(able[:k], 1):
        ranks[x].append(r)
    return [(x, ranks[x].pop(0) if ranks[x] else None) for x in out]


@pytest.mark.parametrize(("longest", "percent", "least"), [(1, 10, 20), (2, 50, 3), (1, 100, 0), (3, 0, 1)])
def test_resampling(spark, longest, percent, least):
    rng = np.random.default_rng(longest)
    vocabulary = ["the", "Cat", "ünï", "x9", "漢字", "of", "that", "mat"]
    rows = [(int(i), " ".join(rng.choice(vocabulary, rng.integers(0, 60))), "en") for i in rng.permutation(np.concatenate([np.arange(-40, 60), [1 << 62, 1 << 33]]))]
    rows += [(None, "null id of the cat " * 9, "en"), (7, None, None), (8, "", "en"), (9, rows[0][1], "en"), rows[0], rows[0]]
    target = ["the cat sat on the mat", None, "", "the ünï"]
    got = resampling.resample(table(spark, rows), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"), longest=longest, percent=percent, least_words=least).collect()
    want = brute_resample(rows, target, longest, percent, least)
    assert sorted(repr((tuple(r)[:5], r["rank"])) for r in got) == sorted(map(repr, want))


def test_resampling_of_nothing(spark):
    empty = table(spark, [])
    target = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert resampling.resample(empty, target).collect() == []
    got = resampling.resample(table(spark, [(1, "a b c", "en")]), target.limit(0), percent=100, least_words=1).collect()
    assert [(r.doc_id, r["rank"]) for r in got] == [(1, 1)]


def test_kth_of_wide_keys(spark):
    rng = np.random.default_rng(5)
    values = np.unique(np.concatenate([rng.integers(-(1 << 63), (1 << 63) - 1, 500), [-(1 << 63), (1 << 63) - 1, 0, -1]]))
    rows = [(int(a), int(b)) for a, b in zip(rng.choice(values, 2000), rng.choice(values, 2000))]
    rows = sorted(set(rows) | {(5, x) for x in range(-100, 100)})
    df = spark.createDataFrame(rows, "a long, b long").cache()
    for k in (1, 2, 777, 1500, len(rows)):
        assert resampling.kth(df, ["a", "b"], k) == list(rows[k - 1])


# --- byte-level BPE

TEXTS = [
    "", None, "a", " ", "  \n\t x", "it's  'll\n\n x''s we've I'D", "a<|endoftext|> b", "a" * 3000, "ünï　😀 x\x85y", "The cat sat. " * 30, "漢字かな交じり文" * 40, "0123456789" * 30, "\x00\x01​﻿", "=" * 500 + "\n" + "-" * 129 + " " * 400,
    "Donaudampfschifffahrtsgesellschaftskapitän" * 5, "é   naïve", " the the thethe", "١٢٣ ४५ Ⅷ ½",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})


def digest(ids, raw):
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


@pytest.mark.parametrize(("block", "fold_limit", "common"), [(1, 128, 4), (1 << 20, 128, 0), (1 << 20, 1, 1000)])
def test_byte_bpe(spark, library, block, fold_limit, common):
    rows = [(i, t, "en") for i, t in enumerate(TEXTS)] + [(None, "null id", None), (3, "again", "de"), (3, "again", "de")]
    got = byte_bpe.digests(table(spark, rows).repartition(2), PATH, block=block, fold_limit=fold_limit, common=common).collect()
    want = [(i, *digest(library.encode_ordinary(t or ""), (t or "").encode())) for i, t, _ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_byte_bpe_of_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in byte_bpe.digests(docs, PATH).collect()}
    assert got == {r.doc_id: digest(library.encode_ordinary(r.text), r.text.encode()) for r in docs.collect()}


def test_byte_bpe_ids_and_keep(spark, library):
    rows = byte_bpe.encode(table(spark, [(1, "the cat", "en"), (2, None, None)]), PATH, keep=("lang", "doc_id")).collect()
    assert {(r.doc_id, r.lang, tuple(r.ids)) for r in rows} == {(1, "en", tuple(library.encode_ordinary("the cat"))), (2, None, ())}
    assert byte_bpe.digests(table(spark, []), PATH).collect() == []


def test_byte_bpe_common_words_stay_packed(spark, library):
    words = [f" q{i:x}zx" for i in range(4000)]
    docs = table(spark, [(i, "".join(words), "en") for i in range(2)])
    known = byte_bpe.Known(PATH, byte_bpe.common_words(docs, PATH, "text", 1 << 20, 1 << 20, 128))
    # what the driver holds and sends: a few bytes a word, and no table of tokens
    assert len(pickle.dumps(known)) < 30 * 4 * len(words)
    names, ids = known.arrays
    at = {w: i for i, w in enumerate(names.to_pylist())}
    pieces = {m for w in words for m in re.findall(r" ?[a-z]+|[0-9]+", w)} - {w.decode() for w in byte_bpe.ranks_of(PATH) if w.isascii()}
    assert pieces and all(ids[at[p.encode()]].as_py() == library._encode_single_piece(p.encode()) for p in pieces)


def test_byte_bpe_block_holds_no_python_words():
    word = lambda i: " " + "".join(chr(97 + i // 26**k % 26) for k in range(4))
    texts = pa.array(["".join(map(word, range(j, j + 60_000))) for j in (0, 30_000)])
    block = byte_bpe.Block(0)
    block.add(pa.RecordBatch.from_arrays([texts.slice(0, 1)], ["t"]), 0)  # tables are made
    tracemalloc.start()
    block.add(pa.RecordBatch.from_arrays([texts], ["t"]), 0)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 20 * 90_000
    words, of = block.words()
    assert len(words) == len(set(words.to_pylist())) == 90_000
    assert b"".join(words.take(pa.array(of)).to_pylist()).decode() == "".join([texts[0].as_py(), *texts.to_pylist()])


def test_byte_bpe_fold(spark, library):
    rng = np.random.default_rng(2)
    words = [b"", b"a", b"\xff", b" the", *[bytes(rng.choice(list(b" aeinrsth\xc3\xa9"), n).astype(np.uint8)) for n in [*range(1, 40)] * 3 + [128]]]
    state = byte_bpe.first_states(pa.array(words, pa.binary()), PATH)
    assert state.slice(4).to_pylist() == byte_bpe.first_states(pa.array(words, pa.binary()).slice(4), PATH).to_pylist()
    rows = spark.createDataFrame(pa.table({"w": pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), state)}))
    got = rows.select(byte_bpe.unpacked(byte_bpe.rank_map(PATH), "w", lambda pairs, _: F.transform("w", lambda x: byte_bpe.fold(pairs, x)))).first()[0]
    assert [list(x) for x in got] == [library._encode_single_piece(w) if w else [] for w in words]


def test_heap_merge(library):
    rng = np.random.default_rng(1)
    ranks = byte_bpe.ranks_of(PATH)
    for n in (1, 2, 5, 40, 700):
        for _ in range(30):
            word = bytes(rng.choice(list(b"aeinrsth \xc3\xa9"), n).astype(np.uint8))
            assert byte_bpe.heap_merge(word, ranks) == library._encode_single_piece(word)


# --- phrases


def brute_phrases(rows, longest, least, cover, first):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    found = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    covered = collections.Counter()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                covered[lang, w[i : i + k]] = max(covered[lang, w[i : i + k]], a)
    out = []
    for (lang, w), a in found.items():
        if 100 * covered[lang, w] >= cover * a:
            continue
        s, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.append((lang, -s, -a, " ".join(w).encode(), left, right))
    result = []
    for lang, own in itertools.groupby(sorted(out), key=lambda x: x[0]):
        result += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (_, s, a, p, left, right) in enumerate(list(own)[:first], 1)]
    return result


@pytest.mark.parametrize(("longest", "least", "cover", "first", "limit"), [(3, 10, 50, 2000, 1 << 20), (4, 2, 80, 30, 64), (2, 1, 50, 5, 16), (5, 3, 50, 2000, 200)])
def test_phrases(spark, monkeypatch, longest, least, cover, first, limit):
    rng = np.random.default_rng(longest)
    vocabulary, weights = np.array(["the", "Cat", "ünï", "x9", "漢字", "of", "that", "a\xa0b", "mat", "z" * 50]), np.array([30, 20, 10, 8, 8, 8, 6, 5, 3, 2]) / 100
    marks = np.array([" ", "  ", "\t", ", ", ".\n", "!"])
    text = lambda n: "".join(w + m for w, m in zip(rng.choice(vocabulary, n, p=weights), rng.choice(marks, n, p=[0.6, 0.1, 0.1, 0.1, 0.05, 0.05])))
    rows = [(i, text(int(rng.integers(0, 60))), [None, "en", "de", "und"][i % 4]) for i in range(60)]
    rows += [(100, text(4000), "en"), (101, None, "en"), (102, "", None), (103, ".,;\n", "fr"), (104, "only", "it"), rows[3], rows[3], (None, " the cat", "en"), (105, "w" * 5000 + " the cat", "en"), (106, " " * 500 + "the" + " " * 500 + "cat", "en")]
    counts = phrases.level_counts
    monkeypatch.setattr(phrases, "level_counts", lambda *a: counts(*a, limit=limit))
    got = phrases.collocations(table(spark, rows).repartition(3), longest=longest, least=least, cover_percent=cover, first=first).collect()
    assert sorted(map(tuple, got)) == sorted(brute_phrases(rows, longest, least, cover, first))


def test_phrases_of_nothing(spark):
    assert phrases.collocations(table(spark, [])).collect() == []
    assert phrases.collocations(table(spark, [(1, None, None)])).collect() == []


def test_bit_set_size_does_not_change_results(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = sorted(map(tuple, phrases.collocations(docs, least=4).collect()))
    monkeypatch.setattr(phrases, "MOST_BITS", 8)  # nearly all bits set
    assert sorted(map(tuple, phrases.collocations(docs, least=4).collect())) == whole
