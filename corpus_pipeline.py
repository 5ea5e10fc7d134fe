"""The corpus pipeline: toxicity filter, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns the columns of documents
(the last one: packed pieces). n_chars is recomputed where a stage changes the text. Documents whose text became empty
stay until near-dedup, which keeps one of them. SQL cannot express the stages; the tests compare every stage's rows with
plain Python versions on a small corpus (test_pipeline_brute).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.llm import decontamination, line_dedup, packing, simhash, toxicity
from trainlake.llm.common import shared_folder, table
from trainlake.llm.queries import vocabulary

ORACLE_SQL = None


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 by the toxicity tagger stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    marked = toxicity.score_rows(docs.toDF(*names), model, text=names[docs.columns.index("text")])
    return marked.where("score < 0.5").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines of any length go (empty ones stay); every document stays."""
    out = line_dedup.apply(docs, shortest=1)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that of the smallest id, null ids last, then of the smallest hash of the
    text (one of them, if rows with equal id and text repeat). Rows are told apart by id and text, so rows without an id
    and rows that share one stay if they are in different groups."""
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"))
    found = simhash.near_duplicates(docs.select(key.alias("row"), "text"), doc_id="row", words=4, bits=4).where("row = component_id")
    kept = found.groupBy("row.id", "row.t").agg(F.count("*").alias("rows_"))
    mine = docs.join(kept, docs["doc_id"].eqNullSafe(kept["id"]) & (F.xxhash64(docs["text"]) == kept["t"]))
    once = mine.where("rows_ = 1").select([docs[c] for c in docs.columns])
    again = mine.where("rows_ > 1").groupBy(kept["id"], kept["t"]).agg(F.min(F.struct([docs[c] for c in docs.columns])).alias("one"))
    return once.unionByName(again.select("one.*")).select(docs.columns)


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contract's rule calls contaminated go; the others stay as they are."""
    found = decontamination.judge(decontamination.find(docs, table(spark, sf_dir, "benchmark"), keep=tuple(c for c in docs.columns if c != "doc_id")))
    return found.where(~F.col("contaminated")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("simhash", near_copies), ("decontamination", contaminated), ("packing", packed)]


def _drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each stage's result is written and read again in the shared checkpoint folder, and goes when the next one is there (the last one written stays, as the result is read from it)."""
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            _drop(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
