"""Chunking, index rows and exact vector search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import strip


def chunks(docs: DataFrame, *, size: int = 512, overlap: int = 50, most: int | None = None, id: str = "doc_id") -> DataFrame:
    """G1: character chunks of every text (of its first `most` characters, if given), stripped, empty ones dropped."""
    step = max(1, size - overlap)
    t = strip(F.col("text") if most is None else F.left("text", F.lit(most)))
    starts = F.when(F.length("t") <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.length("t") - 1, F.lit(step)))
    out = docs.select(id, t.alias("t")).where("t != ''").select(id, "t", F.explode(starts).alias("start"))
    out = out.select(id, "start", strip(F.substring("t", F.col("start") + 1, F.lit(size))).alias("chunk"))
    return out.where("chunk != ''")


def chunk_id(source: Column, nth: Column, text: Column) -> Column:
    """Source:number:first 16 hex digits of the SHA-256 of the text."""
    return F.concat_ws(":", source, nth.cast("string"), F.left(F.sha2(text, 256), F.lit(16)))


def index(sources: DataFrame, *, size: int = 512, overlap: int = 50, most: int | None = None, only: tuple[str, ...] | None = None, external: bool = False) -> tuple[DataFrame, DataFrame]:
    """(chunks with id, text, source_id, url, chunk_index; a row of status for each source).

    Whole texts, or their first `most` characters, if given. sources: source_id, url, kind, tier, library, body (null if it could not be fetched). Sources that another service
    serves are listed, not indexed, unless `external`; one that gives no chunk fails alone. Ids follow from the content, so writing them again is an upsert."""
    rows = sources if only is None else sources.where(F.col("source_id").isin(*only))
    served = F.col("library").isNotNull() & F.lit(not external)
    kept = rows.where(~served).select("source_id", "url", F.col("body").alias("text"))
    cut = chunks(kept, size=size, overlap=overlap, most=most, id="source_id")
    # chunks are numbered among those that are left: a start's number, less the blank ones before it
    nth = F.row_number().over(_by_start()) - 1
    cut = cut.withColumn("chunk_index", nth).select(chunk_id(F.col("source_id"), F.col("chunk_index"), F.col("chunk")).alias("id"), F.col("chunk").alias("document"), "source_id", "chunk_index")
    cut = cut.join(kept.select("source_id", "url"), "source_id")
    n = cut.groupBy("source_id").agg(F.count("*").alias("chunk_count"))
    state = F.when(served, "context7_only").when(F.coalesce("chunk_count", F.lit(0)) > 0, "indexed").otherwise("failed")
    status = rows.join(n, "source_id", "left").select("source_id", "url", F.coalesce("kind", F.lit("llms_txt")).alias("kind"), "tier", "library", state.alias("status"), F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"))
    return cut, status


def _by_start():
    from pyspark.sql import Window

    return Window.partitionBy("source_id").orderBy("start")


def run_summary(status: DataFrame) -> DataFrame:
    """A run's totals; with a failed source it is completed with errors."""
    bad = F.count_if(F.col("status") == "failed")
    return status.agg((F.count("*") - bad).alias("sources_ok"), bad.alias("sources_failed"), F.coalesce(F.sum("chunk_count"), F.lit(0)).alias("chunks_added"), F.when(bad == 0, "completed").otherwise("completed_with_errors").alias("status"))


def collection_stats(index_rows: DataFrame) -> DataFrame:
    """How many chunks there are, and of how many sources."""
    return index_rows.agg(F.count("*").alias("chunks"), F.countDistinct("source_id").alias("sources"))


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; null if one of them is a zero vector."""
    return 1 - F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


def nearest(vectors: DataFrame, query: list[float], k: int, *, where: Column | None = None) -> DataFrame:
    """The k nearest by cosine distance, ties by id, zero vectors last; a filter holds before the ranking."""
    q = F.array(*[F.lit(float(x)) for x in query])
    rows = vectors if where is None else vectors.where(where)
    return rows.withColumn("distance", cosine_distance(F.col("embedding"), q)).orderBy(F.col("distance").asc_nulls_last(), "vec_id").limit(k)


def packed(rows: DataFrame, id: str, vector: str, name: str, size: int) -> DataFrame:
    """Rows of up to `size` vectors each: their ids and their numbers, one after the other; null vectors are left out."""
    import pyarrow as pa

    def run(batches):
        for rb in batches:
            for at in range(0, rb.num_rows, size):
                part = rb.slice(at, size)
                col = part.column(1)
                ids, flat = part.column(0).cast(pa.int64()), col.flatten().cast(pa.float64())
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                yield pa.RecordBatch.from_arrays([one(ids), one(flat)], [f"{name}_ids", f"{name}_flat"])

    return rows.select(F.col(id).cast("long"), vector).where(F.col(vector).isNotNull()).mapInArrow(run, f"{name}_ids array<long>, {name}_flat array<double>")


def nearest_each(vectors: DataFrame, queries: DataFrame, k: int, *, block: int = 256, rows: int = 4096) -> DataFrame:
    """G4 for many queries (query_id, q): query_id, vec_id, distance, place of the k nearest vectors of each, exactly; zero vectors last.

    The stated queries meet all vectors in blocks: tasks pack `block` queries and `rows` vectors into one row each, pairs of
    such rows are multiplied as matrices, and a task keeps k of each query before those of all tasks are ranked. Nothing
    goes through the driver, and no pair of single rows is ever made."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import Window

    names = ["query_id", "vec_id", "distance"]

    def near(batches):
        best: dict[int, list[tuple[float, int]]] = {}
        for rb in batches:
            for i in range(rb.num_rows):
                vid, flat, qid, asked = (np.asarray(rb.column(c)[i].values) for c in range(4))
                if not len(vid) or not len(qid):
                    continue
                v, q = flat.reshape(len(vid), -1), asked.reshape(len(qid), -1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    d = 1 - (q @ v.T) / np.sqrt((q**2).sum(1))[:, None] / np.sqrt((v**2).sum(1))[None, :]
                d[~np.isfinite(d)] = np.inf
                for j, name in enumerate(qid.tolist()):
                    pick = np.flatnonzero(d[j] <= np.partition(d[j], min(k, len(vid)) - 1)[min(k, len(vid)) - 1])
                    best[name] = sorted(best.get(name, []) + list(zip(d[j][pick].tolist(), vid[pick].tolist())))[:k]
                if len(best) > 64 * block:
                    yield from out(best)
                    best = {}
        yield from out(best)

    def out(best):
        flat = [(n, v, d) for n, own in best.items() for d, v in own]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in flat], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names)

    pairs = packed(vectors, "vec_id", "embedding", "v", rows).crossJoin(packed(queries, "query_id", "q", "q", block))
    found = pairs.mapInArrow(near, "query_id long, vec_id long, distance double")
    ranked = found.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))).where(F.col("place") <= k)
    return ranked.withColumn("distance", F.when(F.col("distance") != float("inf"), F.col("distance")))
