"""Numbers stay consecutive and no row is lost over many shuffle partitions."""

import pytest
from pyspark.sql import functions as F

from trainlake.operators import mix
from trainlake.operators.numbering import in_given_order, numbered
from trainlake.sources import datasets
from trainlake.sources.jsonl import parquet_rows

SMALL = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}


@pytest.fixture
def many(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def gapless(rows, column, n):
    got = rows.agg(F.count("*").alias("n"), F.count_distinct(column).alias("d"), F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    assert tuple(got) == (n, n, 0, n - 1)


def test_numbers_of_wide_rows(many):
    n = 200_000
    rows = many.range(0, n, 1, 12).select(F.xxhash64("id").alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), F.lit(20)).alias("pay"))
    got = numbered(rows, "k")
    gapless(got, "sort_order", n)
    at = got.select("k", "sort_order").orderBy("sort_order").toPandas()
    assert at["k"].is_monotonic_increasing


def test_numbers_of_equal_keys(many):
    rows = many.range(0, 30_000, 1, 8).select(F.lit("same").alias("k"), "id", F.repeat(F.lit("x"), F.lit(300)).alias("pay"))
    got = numbered(rows, "k")
    gapless(got, "sort_order", 30_000)
    gapless(numbered(rows.limit(0).unionByName(rows.where("id < 1")), "k"), "sort_order", 1)
    assert numbered(rows.limit(0), "k").count() == 0
    gapless(in_given_order(rows, "place"), "place", 30_000)


def test_mix_keeps_every_row(many):
    n = 100_000
    rows = many.range(0, n, 1, 12).select(
        F.sha2(F.col("id").cast("string"), 256).alias("curated_id"), F.when(F.col("id") % 10 == 0, "public").otherwise("personal").alias("data_source"), F.concat(F.lit("h"), F.col("id") % 3).alias("harness"),
        F.lit("p").alias("public_dataset"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(40)).alias("messages"),
    )
    got = mix.mix(rows, prioritize_personal=False)
    gapless(got, "sort_order", n)
    kinds = got.groupBy("data_source").agg(F.min("sort_order").alias("a"), F.max("sort_order").alias("b")).collect()
    assert {(r.data_source, r.a, r.b) for r in kinds} == {("personal", 0, 89_999), ("public", 90_000, 99_999)}


def test_loaders_keep_every_row(many, tmp_path):
    n = 10_000
    rows = many.range(0, n, 1, 12).select(F.concat(F.lit("q"), "id").alias("prompt"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(20)).alias("response"))
    rows.write.parquet(str(tmp_path / "shards"))
    for given in (rows, rows.repartition(9), parquet_rows(many, str(tmp_path / "shards"))):
        turns = datasets.instruction_pairs(given, "pairs", "v")
        assert turns.count() == 2 * n
        sessions = turns.select(F.substring_index("session_id", "-", -1).cast("long").alias("i")).distinct()
        gapless(sessions, "i", n)
    first = datasets.instruction_pairs(parquet_rows(many, str(tmp_path / "shards")), "pairs", "v", max_rows=100)
    assert {r.text for r in first.where("role = 'user'").collect()} == {f"q{i}" for i in range(100)}


def test_chat_runs_keep_every_turn(many):
    n = 21_000  # sessions of 7 turns that follow each other; every third comes again later
    rows = many.range(0, n, 1, 12).select(
        F.concat(F.lit("s"), F.floor(F.col("id") / 7) % 1000).alias("session_id"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(20))).alias("content"), (F.col("id") % 7).alias("turn_number"),
    )
    turns = datasets.swe_chat(rows)
    assert turns.count() == n
    per = turns.groupBy("session_id", "line_no").count().groupBy("session_id").agg(F.max("line_no").alias("last")).agg(F.max("last")).first()[0]
    assert per == 7


def test_draws_cover_all_ranges(many):
    rows = many.range(0, 5_000, 1, 12).select("id", F.lit(1.0).alias("w"))
    assert mix.weighted_draws(rows, "id", "w", 20_000).count() == 20_000
