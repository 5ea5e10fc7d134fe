"""A bounded, repeatable sample of labelled training documents (the held-out fifth is never in it)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out


#: Longest texts, in characters, that are used for fitting.
LONGEST = 50_000


def sample(docs: DataFrame, labels: DataFrame, label: str, each: int, longest: int = LONGEST) -> tuple[list[str], list[int]]:
    """About `each` texts of label 0 and of label 1 (all if fewer), chosen by a hash of the id; one text an id.

    An id with both labels has the larger one. Of rows that share an id, the text with the smallest hash counts, so the
    sample is bounded whatever repeats."""
    rows = labels.where(~held_out()).where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y")).where("doc_id is not null")
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], []
    share = F.coalesce(*[F.when(F.col("y") == y, F.lit(min(1.0, each / n))) for y, n in counts.items()])
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    # the picked ids are about 2 x each rows by construction, so they are sent to the scan and no other text is shuffled
    found = docs.select("doc_id", "text").where(F.length("text") <= longest).join(F.broadcast(picked), "doc_id")
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    got = one.orderBy("doc_id").select("x.text", "y").collect()
    return [r.text for r in got], [int(r.y) for r in got]
