"""Text scans: JSONL with physical line numbers (malformed lines kept, dropped or fatal), whole JSON files, file choice."""

from __future__ import annotations

import fnmatch
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.variant import WHITE, is_dict

TURN = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "harness", "session_id", "source_path", "role", "text", "ingested_at")] + [T.StructField("line_no", T.LongType())] + [T.StructField(c, T.StringType()) for c in ("dataset_id", "data_source", "label", "exec", "verify", "content", "message", "messages")] + [T.StructField("stack_index", T.BooleanType())])


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_path, line_no (from 1), value of every line. Files are split as usual: a line's number is the lines of the
    splits before its own (one small row a split, as many as the driver lists anyway) and its place in its own split."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("b_"), F.monotonically_increasing_id().alias("i_"))
    splits = raw.groupBy("source_path", "b_").agg(F.min("i_").alias("first_"), F.count("*").alias("n_"))
    before = F.sum("n_").over(Window.partitionBy("source_path").orderBy("b_").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("before_", F.coalesce(before, F.lit(0))).drop("n_")
    out = raw.join(F.broadcast(splits), ["source_path", "b_"])
    return out.select("source_path", (F.col("before_") + F.col("i_") - F.col("first_") + 1).alias("line_no"), "value")


def not_blank(c: str = "value"):
    return F.btrim(F.col(c), F.lit(WHITE)) != ""


def blob_lines(blobs: DataFrame, most: int | None = None) -> DataFrame:
    """source_path, line_no, value of the lines (of the first `most`, if given) of texts in a table (source_path, content)."""
    rows = blobs.select("source_path", F.posexplode(F.split("content", r"\r\n|\n|\r")).alias("line_no", "value"))
    rows = rows if most is None else rows.where(F.col("line_no") < most)
    return rows.withColumn("line_no", (F.col("line_no") + 1).cast("long"))


def json_lines(spark: SparkSession, path: str | list[str] | DataFrame, *, most: int | None = None) -> DataFrame:
    """source_path, line_no, v (VARIANT) of the lines that hold a JSON object; of files, or of texts in a table
    (source_path, content). `most` keeps the first lines of each file or text."""
    lines = blob_lines(path, most) if isinstance(path, DataFrame) else numbered_lines(spark, path)
    if most is not None and not isinstance(path, DataFrame):
        lines = lines.where(F.col("line_no") <= most)
    rows = lines.where(not_blank()).select("source_path", "line_no", F.try_parse_json("value").alias("v"))
    return rows.where(is_dict(F.col("v")))


def whole_files(spark: SparkSession, path: str | list[str] | DataFrame) -> DataFrame:
    """source_path, value of whole files, or of texts in a table (source_path, content)."""
    if isinstance(path, DataFrame):
        return path.select("source_path", F.col("content").alias("value"))
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), "value")


def json_files(spark: SparkSession, path: str | list[str] | DataFrame) -> DataFrame:
    """source_path, v of whole JSON files; malformed ones are left out."""
    return whole_files(spark, path).select("source_path", F.try_parse_json("value").alias("v")).where("v is not null")


def read_turns(spark: SparkSession, path: str | list[str], *, keep_bad: bool = True) -> DataFrame:
    """S1 (S2 without keep_bad): the columns of a turn, _source_file, _line_no (blank lines count), _parse_error (first 500
    characters of a malformed line). Lines that hold JSON, but no object, are left out."""
    raw = numbered_lines(spark, path).where(not_blank()).withColumnsRenamed({"source_path": "_source_file", "line_no": "_line_no"})
    raw = raw.withColumn("v", F.try_parse_json("value"))
    bad = F.col("v").isNull()
    rows = raw.where(bad | is_dict(F.col("v"))).withColumn("_parse_error", F.when(bad, F.left(F.btrim("value", F.lit(WHITE)), F.lit(500))))
    rows = rows.withColumn("r", F.from_json(F.when(~bad, F.col("value")), TURN)).select("r.*", "_source_file", "_line_no", "_parse_error")
    return rows if keep_bad else rows.where("_parse_error is null")


def parse_errors(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Malformed lines a file, the only trace that the curating scan leaves of them."""
    rows = numbered_lines(spark, path).where(not_blank())
    return rows.groupBy("source_path").agg(F.count_if(F.try_parse_json("value").isNull()).alias("parse_errors"), F.count("*").alias("lines"))


def read_strict(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """As json_lines, but a malformed line fails the query."""
    rows = numbered_lines(spark, path).where(not_blank()).select("source_path", "line_no", F.parse_json("value").alias("v"))
    return rows.where(is_dict(F.col("v")))


def choose_files(paths: list[str], *, stage: str = "scan", exclude: tuple[str, ...] = ("public-stack-v2-dedup*.jsonl",)) -> list[str]:
    """S3: the JSONL files of a stage in order of name. Failure files are never input; warning files not of the scan."""
    skip = ("safety-failures*",) + (("safety-warn*",) if stage == "scan" else ())
    name = lambda p: p.rsplit("/", 1)[-1]
    return sorted(p for p in paths if name(p).endswith(".jsonl") and not any(fnmatch.fnmatch(name(p), x) for x in skip + exclude))


def latest_per_prefix(paths: list[str]) -> list[str]:
    """Of names prefix-YYYY-MM-DD only the last date of each prefix; others stay."""
    best: dict[str, tuple[str, str]] = {}
    rest = []
    for p in paths:
        m = re.fullmatch(r"(.*)-(\d{4}-\d{2}-\d{2})", p.rsplit("/", 1)[-1].removesuffix(".jsonl"))
        if m is None:
            rest.append(p)
        elif m[1] not in best or best[m[1]][0] < m[2]:
            best[m[1]] = (m[2], p)
    return sorted(rest + [p for _, p in best.values()])


def parquet_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every Parquet shard below a folder, with its path and the row's place in it; hidden, cache and part-written files are not read."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(folder)
    path = F.col("_metadata.file_path")
    return rows.select("*", path.alias("_shard"), F.col("_metadata.row_index").alias("_row")).where(~path.rlike(r"/(\.cache|\.git)/") & ~path.rlike(r"\.(tmp|incomplete|part)\.parquet$"))


def train_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """source_path, line_no, v of the training rows that hold messages."""
    rows = json_lines(spark, path)
    return rows.where(F.coalesce(F.size(F.try_variant_get("v", "$.messages", "array<variant>")) > 0, F.lit(False)))


def resolve(local: list[str], exists) -> tuple[str, str]:
    """(kind, path) of the first place that exists: a file, a folder of shards, a dataset folder; remote places are out of reach."""
    for kind, path in zip(("file", "shards", "dataset"), local):
        if path and exists(path):
            return kind, path
    raise FileNotFoundError(f"none of {local} exists; remote datasets are not read")
