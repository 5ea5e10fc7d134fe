"""Sinks: dated JSONL and Parquet, appended or replaced; parts in order; archive; reports."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variant import strip


def dated(folder: str, prefix: str, day: datetime.date | None = None) -> str:
    """K1: the place of a source's records of a day (UTC today)."""
    day = day or datetime.datetime.now(datetime.timezone.utc).date()
    return f"{folder.rstrip('/')}/{prefix}-{day.isoformat()}.jsonl"


def write_records(rows: DataFrame, folder: str, prefix: str, *, day: datetime.date | None = None, replace: bool = False, format: str = "json") -> str:
    """Records to their dated place, added to what is there or instead of it. Each task writes its own file; nulls are left out."""
    path = dated(folder, prefix, day)
    out = rows.write.mode("overwrite" if replace else "append")
    (out.option("ignoreNullFields", "true").json(path) if format == "json" else out.parquet(path))
    return path


def write_scan(found: DataFrame, folder: str, name: str, day: datetime.date | None = None) -> None:
    """failures and warnings of one scan to their two places; the scan is kept between the two writes by the caller if it is dear."""
    for kind, failed in (("failures", True), ("warn", False)):
        write_records(found.where(F.col("failed") == failed).drop("failed"), folder, f"safety-{kind}-{name}", day=day, replace=True)


def merge_parts(spark: SparkSession, parts: list[str], path: str) -> None:
    """K2: parts after each other in one file, in the order given (only where one file is asked for)."""
    rows = None
    for i, p in enumerate(parts):
        one = spark.read.text(p).select("value", F.lit(i).alias("part"), F.monotonically_increasing_id().alias("nth"))
        rows = one if rows is None else rows.unionByName(one)
    rows.repartitionByRange(1, "part", "nth").sortWithinPartitions("part", "nth").select("value").write.mode("overwrite").text(path)


def archive(spark: SparkSession, folder: str, prefix: str, stamp: str) -> list[tuple[str, str]]:
    """K4: a prefix's dated files moved to folder/archive/<stamp>; (from, to) of each. Through Hadoop's file system, so any store will do."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moved = []
    for s in fs.listStatus(base):
        name = s.getPath().getName()
        if re.fullmatch(re.escape(prefix) + r"-\d{4}-\d{2}-\d{2}\.jsonl", name):
            to = f"{folder.rstrip('/')}/archive/{stamp}"
            fs.mkdirs(jvm.org.apache.hadoop.fs.Path(to))
            if not fs.rename(s.getPath(), jvm.org.apache.hadoop.fs.Path(f"{to}/{name}")):
                raise OSError(f"cannot move {name}")
            moved.append((f"{folder.rstrip('/')}/{name}", f"{to}/{name}"))
    return moved


def report(rows: DataFrame, title: str, most: int = 200) -> str:
    """K5: a small result as Markdown; more than `most` rows are an error, since a report is for people."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"more than {most} rows")
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    lines = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join(cell(x) for x in r) + " |" for r in got]) + "\n"


def previews(rows: DataFrame, most: int = 400) -> DataFrame:
    """The first characters of each example's messages, as a report shows them."""
    body = F.array_join(F.transform("messages", lambda m: F.coalesce(m["content"], F.lit(""))), "\n\n")
    return rows.select("meta.harness", "meta.session_id", "meta.chunk_index", F.left(strip(body), F.lit(most)).alias("preview"))
