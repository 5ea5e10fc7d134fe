"""Helpers shared by the operators: checkpoints, Arrow text buffers, byte-bounded slices of batches."""

from __future__ import annotations

import ctypes
import gc
import json
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles at once; bounds the Python workers' memory.
CHUNK_BYTES = 2 << 20


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint into the cluster's shared folder (spark.checkpoint.dir); a temporary one only where that is unset."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder: spark.checkpoint.dir, or, only in local mode, a temporary one if that is unset."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp("checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that were cut and are no longer referred to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_join(rows: DataFrame, of: DataFrame, key: str, *, share: int = 2000) -> DataFrame:
    """rows joined with of (one row a key, n: the number of rows that have it). Keys with over 1/share of all rows, so fewer
    than `share` keys, are sent to the rows instead of sending their rows to one task."""
    total = of.agg(F.sum("n")).first()[0] or 0
    hot = of.where(F.col("n") * share > F.lit(total)).drop("n")
    cold = of.where(F.col("n") * share <= F.lit(total)).drop("n")
    few = F.broadcast(hot)
    return rows.join(few, key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def trim() -> None:
    """Give memory that this Python worker has freed back to the system; workers serve many stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # only glibc has it
        pass


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty. No copy unless there are nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    if not (wide or pa.types.is_string(col.type)):
        col, wide = col.cast(pa.string()), False
    _, off, data = col.buffers()
    n = len(col)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    if data is None or not n:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each has about limit bytes in column (a single longer row stays whole)."""
    trim()
    for rb in batches:
        n, start = rb.num_rows, 0
        if not n:
            continue
        _, off = utf8(rb.column(rb.schema.get_field_index(column)))
        while start < n:
            end = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
            yield rb.slice(start, end - start)
            start = end
    trim()


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """(string, code points as uint32, offsets in code points) of concatenated UTF-8 texts."""
    raw = data.tobytes()
    text = raw.decode("utf-8", "replace")
    cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if len(cps) == len(raw):
        return text, cps, offsets
    inner = np.flatnonzero((data & 0xC0) == 0x80)
    return text, cps, offsets - np.searchsorted(inner, offsets)


def constant(value, kind: str):
    """A constant of any type as a column: its JSON is read once, when Spark folds constants, not for each row."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False, separators=(",", ":"))), kind)


def held_out(doc_id: str = "doc_id"):
    """Contract split: crc32 of the id as text, modulo 5, is 0. A null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, … of each range, concatenated."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
