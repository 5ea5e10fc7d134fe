"""Operator 11: resampling towards a target distribution (importance weights over hashed features, Gumbel top-k).

Features are runs of 1 to n words, hashed into a fixed number of buckets. One pass counts the buckets of the corpus, one
those of the target; the buckets' log ratios ("gains") form one array, a constant of the scoring pass. A document's weight is the sum of its features' gains; with seeded Gumbel noise added, the k highest scores are
a draw without replacement.

The k-th key is found exactly by radix selection: 16-bit digits of (score descending, id, row) are counted from the top,
one small count of at most 65,536 groups for each digit that can still differ. Only the chosen rows are sorted by range and
ranked; all others pass as they are.

Defined results: null texts have no words, weight 0 and are never drawn where least_words is positive; a null id counts as
the text '' in the seed and comes after all others among equal scores; repeated rows take part on their own, equal ones in
any order; an empty corpus gives an empty table, an empty target gives gains from counts of 0. Ids must be integers. Other
columns, whatever their names, are not read. All of it runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import numbered
from .common import constant, cut

# The contract's words and its lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGIT = 16
LAST = (1 << 63) - 1


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def buckets_of(words: Column, longest: int, buckets: int) -> Column:
    """The bucket of each run of 1 to `longest` words."""
    def bucket(x: Column) -> Column:
        return F.pmod(F.crc32(x.cast("binary")), F.lit(buckets)).cast("int")

    if longest == 1:
        return F.transform(words, bucket)

    def runs_of(n: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: bucket(F.array_join(F.slice(words, i, F.lit(n)), " ")))
        return F.when(F.size(words) >= n, every).otherwise(F.expr("cast(array() as array<int>)"))

    runs = [runs_of(n) for n in range(1, longest + 1)]
    return F.concat(*runs)


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    """bucket, n: at most `buckets` rows, summed within tasks before the shuffle."""
    return texts.select(F.explode(buckets_of(words_of(F.col(text).cast("string")), longest, buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, *, text: str = "text", target_text: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """bucket (all of them), gain: floor of 1000 times the smoothed log ratio of target and corpus."""
    own = bucket_counts(docs, text, longest, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
    aim = bucket_counts(target, target_text, longest, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    none = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    both = cut(own.unionByName(aim).unionByName(none).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    corpus, aimed = (float(x) for x in both.agg(F.sum("s"), F.sum("t")).first())
    real = lambda c: F.col(c).cast("double")
    ratio = ((real("t") + 1) * F.lit(corpus + buckets)) / ((real("s") + 1) * F.lit(aimed + buckets))
    return both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def score(docs: DataFrame, table: DataFrame, *, text: str = "text", doc_id: str = "doc_id", longest: int = 1, buckets: int = 10_000, seed: str = "2024") -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    array = constant([r["gain"] for r in table.orderBy("bucket").collect()], "array<bigint>")  # `buckets` numbers
    rows = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text).cast("string")).alias("w_"))
    b = buckets_of(F.col("w_"), longest, buckets)
    sizes = F.size("w_")
    features = sum((F.greatest(sizes - n, F.lit(0)) for n in range(1, longest)), sizes)
    weight = F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + F.element_at(array, x + 1))
    h = F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), F.lit(8)), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return rows.select("doc_id", sizes.cast("long").alias("n_words"), features.cast("long").alias("n_features"), weight.alias("weight")).withColumn("score", F.col("weight") + noise)


def kth(rows: DataFrame, keys: list[str], k: int) -> list[int]:
    """The k-th smallest (from 1) of the keys' tuples of longs, by counted digits. rows must be materialised and hold k or more."""
    halves = {f"{c}{h}": F.shiftright(c, 32) if h == "h" else F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)) for c in keys for h in "hl"}
    rows = rows.select(*[x.alias(n) for n, x in halves.items()])
    span = rows.agg(*[f(n).alias(f"{f.__name__}_{n}") for n in halves for f in (F.min, F.max)]).first()
    found, left = [], k
    for n in halves:
        low, width = span[f"min_{n}"], (span[f"max_{n}"] - span[f"min_{n}"]).bit_length()
        place = 0  # distance from the least value
        for shift in range(-(-width // DIGIT) * DIGIT - DIGIT, -1, -DIGIT):
            counts = rows.groupBy(F.shiftright(F.col(n) - F.lit(low + place), shift).alias("d")).agg(F.count("*").alias("n")).collect()
            for d, m in sorted(map(tuple, counts)):
                if left <= m:
                    place += d << shift
                    break
                left -= m
            rows = rows.where(F.shiftright(F.col(n) - F.lit(low), shift) == F.lit(place >> shift))
        found.append(low + place)
    return [(h << 32) | x for h, x in zip(found[::2], found[1::2])]


def resample(docs: DataFrame, target: DataFrame, *, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", longest: int = 1, buckets: int = 10_000, seed: str = "2024", percent: int = 10, least_words: int = 20) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row; rank (1, 2, … by score descending, then id) for the drawn percentage of the rows with least_words or more."""
    table = gains(docs, target, text=text, target_text=target_text, longest=longest, buckets=buckets)
    scored = score(docs, table, text=text, doc_id=doc_id, longest=longest, buckets=buckets, seed=seed)
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    scored = cut(scored.withColumns({"down_": -F.col("score"), "id_": ids, "row_": F.monotonically_increasing_id()}))
    able = scored.where(F.col("n_words") >= least_words)
    k = able.count() * percent // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    keys = ["down_", "id_", "row_"]
    last = kth(able, keys, k)
    chosen = F.lit(True)
    for c, x in list(zip(keys, last))[::-1]:
        chosen = (F.col(c) < F.lit(x)) | ((F.col(c) == F.lit(x)) & chosen)
    chosen = chosen & (F.col("n_words") >= least_words)
    drawn = numbered(scored.where(chosen), *keys, name="at_rank").select(*columns, (F.col("at_rank") + 1).cast("long").alias("rank"))
    return drawn.unionByName(scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank")))
