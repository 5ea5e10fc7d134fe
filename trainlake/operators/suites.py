"""Evaluation suites: placeholder tasks, verdict of a suite, verdict of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suites, and what marks a task that was never filled in.
SUITES = ("diff_apply", "style", "debug", "retrieval_gold")
NOTE, REPO, EXAMPLE = "replace", "REPLACE_ME", "-example-001"


def placeholder(id: Column, repo: Column, note: Column) -> Column:
    """The note asks for a replacement, the repository is a stand-in, or the id is an example's."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.lower(text(note)).contains(NOTE) | (F.upper(text(repo)) == REPO) | text(id).endswith(EXAMPLE)


def load(spark, folder: str) -> DataFrame:
    """The tasks of the known suites (folder/<suite>.jsonl): suite, id, repo, note. An unknown or missing suite fails the read."""
    from functools import reduce

    from ..functions import variant as J
    from ..sources.jsonl import read_strict

    v = F.col("v")
    parts = [read_strict(spark, f"{folder}/{s}.jsonl").select(F.lit(s).alias("suite"), J.scalar_at(v, "$.id").alias("id"), J.scalar_at(v, "$.repo").alias("repo"), J.scalar_at(v, "$.meta.note").alias("note")) for s in SUITES]
    return reduce(DataFrame.unionByName, parts)


def verdicts(tasks: DataFrame, suites: DataFrame, *, strict: bool = False, smoke: DataFrame | None = None) -> DataFrame:
    """Suite, tasks, passed, verdict, reason. An empty suite fails; one of placeholders only passes unless strict; the
    others pass by a reply of two characters or more (smoke: suite, reply, error), or are incomplete without such a test."""
    n = tasks.groupBy("suite").agg(F.count("*").alias("tasks"), F.bool_and(placeholder(F.col("id"), F.col("repo"), F.col("note"))).alias("idle"))
    rows = suites.select("suite").join(n, "suite", "left").withColumn("tasks", F.coalesce("tasks", F.lit(0)))
    rows = rows.join(smoke.select("suite", "reply", "error"), "suite", "left") if smoke is not None else rows.withColumns({"reply": F.lit(None).cast("string"), "error": F.lit(None).cast("string")})
    tested = F.lit(smoke is not None)
    good = F.length(F.trim(F.coalesce("reply", F.lit("")))) >= 2
    empty, idle, failed = F.col("tasks") == 0, F.col("idle"), F.col("error").isNotNull()
    verdict = F.when(empty, "fail").when(idle, "fail" if strict else "pass").when(failed, "fail").when(tested & good, "pass").when(~tested, "incomplete").otherwise("fail")
    reason = F.when(empty, "empty_suite").when(idle, "placeholder_tasks_only" if strict else "placeholder_suite_skipped").when(failed, F.concat(F.lit("ollama_chat_failed: "), "error")).when(tested, "smoke_chat").otherwise("manual_tasks_required")
    passed = F.when(empty | failed, 0).when(idle, F.lit(0) if strict else F.col("tasks")).when(tested & good, 1).otherwise(0)
    return rows.select("suite", "tasks", passed.cast("long").alias("passed"), verdict.alias("verdict"), reason.alias("reason"))


def overall(results: DataFrame) -> DataFrame:
    """A run passes if all its suites do."""
    return results.agg(F.when(F.coalesce(F.bool_and(F.col("verdict") == "pass"), F.lit(True)), "pass").otherwise("fail").alias("verdict"), F.count("*").alias("suites"), F.count_if(F.col("verdict") == "pass").alias("passed"))


def registered(results: DataFrame, train_run: str) -> DataFrame:
    """One benchmark row a suite."""
    return results.select("suite", F.lit(train_run).alias("train_run_name"), F.lit("completed").alias("status"), F.to_json(F.struct(*results.columns)).alias("scores_json"))
