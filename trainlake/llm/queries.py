"""The operators' queries over the test tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary())


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary(), limit=512)


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import find, judge

    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=13)
    return judge(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL["op9_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, len(w[k:k+12]) AS n, array_to_string(w[k:k+12], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS k FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, k, array_to_string(w[k:k+n-1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT dw.doc_id, dw.k, dw.n, bw.item FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n
), h AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM m)) GROUP BY doc_id
), i AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .winnowing import compare_with_next

    return compare_with_next(table(spark, sf_dir, "documents"))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import hexadecimal, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)
    return found.select("doc_id", hexadecimal("f").alias("fingerprint"), "component_id")


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")), threshold=0.3)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), threshold=0.5)


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language

    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_dedup

    return line_dedup.report(table(spark, sf_dir, "documents"), shortest=1)


@query
def op8_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import link_trust

    return link_trust.judge(table(spark, sf_dir, "pages"))


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample

    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), longest=1, buckets=10_000, seed="2024", percent=10, least_words=20)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by its table: 256 entries made by eight steps each, then one step for each byte of a distinct word
SQL["op11_resampling"] = r"""
WITH RECURSIVE steps AS (
  SELECT 0 AS k, i, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL SELECT k + 1, i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), lookup AS MATERIALIZED (SELECT list(c ORDER BY i) AS l FROM steps WHERE k = 8),
dw AS MATERIALIZED (
  SELECT doc_id, unnest(w) AS w FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents)
), bw AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM benchmark
), words AS MATERIALIZED (
  SELECT w, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, strlen(w) + 1), lambda p: ('0x' || substr(hex(w), 2 * p - 1, 2))::BIGINT), lambda c, b: xor(c >> 8, l[1 + xor(c & 255, b)])), 4294967295) % 10000 AS b
  FROM (SELECT w FROM dw UNION SELECT w FROM bw), lookup
), s AS (SELECT b, count(*) AS n FROM dw JOIN words USING (w) GROUP BY b), t AS (SELECT b, count(*) AS n FROM bw JOIN words USING (w) GROUP BY b),
g AS (
  SELECT words.w, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM words LEFT JOIN s USING (b) LEFT JOIN t USING (b)
), f AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS weight FROM dw JOIN g USING (w) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN f USING (doc_id)
), able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN able USING (doc_id)
"""


@query
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrases import collocations

    return collocations(table(spark, sf_dir, "documents"), longest=3, least=10, cover_percent=50, first=2000)


SQL["op13_phrases"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)
  GROUP BY ALL
), n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.k, a, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN g l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN g r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(w[cut+1:], ' ')
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT lang, sub, max(a) AS most FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS sub FROM c WHERE k = 3) GROUP BY ALL
), ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.sub = best.phrase
  WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import digests

    return digests(table(spark, sf_dir, "documents"), rank_file())
