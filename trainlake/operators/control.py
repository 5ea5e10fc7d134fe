"""Control tables: schemas, append-only changes with their latest state, counts, lists, and checks of references.

A table is a folder of rows that are only added to (each with `at`); its state is the last row of each key, where a column
may keep its older value if the newer one is null. So an upsert never rewrites a file and can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import harness_of_file
from ..functions.variant import WHITE

VERSION = 4
# Tables, their columns and keys.
TABLES = {
    "source_registry": ("dataset_id string, hf_repo string, tier string, gated int, default_max_rows int, loader_name string, synced_at string", ["dataset_id"]),
    "source_schema_probe": ("dataset_id string, features_json string, sample_keys string, probed_at string", ["dataset_id"]),
    "ingest_runs": ("run_id string, pipeline string, started_at string, finished_at string, status string, total_rows long, details_json string", ["run_id"]),
    "ingest_files": ("path string, harness string, ingest_run_id string, row_count long, loaded_at string", ["path"]),
    "curated_examples": ("curated_id string, source_file string, source_line long, harness string, data_source string, public_dataset string, project string, session_id string, chunk_index int, chunk_count int, message_count int, char_count long, train_tier int, safety_ok int, style_tags string, tone string", ["curated_id"]),
    "training_manifests": ("manifest_id string, created_at string, criteria_json string, row_count long", ["manifest_id"]),
    "training_manifest_rows": ("manifest_id string, curated_id string, sort_order long, sample_weight double", ["manifest_id", "curated_id"]),
    "training_runs": ("run_id string, run_name string, base_model string, adapter_path string, status string, started_at string, finished_at string, train_rows long, metrics_json string", ["run_id"]),
    "quarantine_events": ("event_id long, curated_id string, reason string, operator string, train_tier_before int, train_tier_after int, created_at string", ["event_id"]),
    "rag_sources": ("source_id string, url string, kind string, tier int, context7_library_id string, last_indexed_at string, chunk_count long, status string", ["source_id"]),
    "rag_index_runs": ("run_id string, started_at string, finished_at string, status string, sources_ok int, sources_failed int, chunks_added long, details_json string", ["run_id"]),
    "benchmark_runs": ("run_id string, suite string, train_run_name string, status string, scores_json string, created_at string", ["run_id"]),
}
# Fixed values: (table, column) that must name a row of another.
REFERENCES = [("training_manifest_rows", "manifest_id", "training_manifests"), ("training_manifest_rows", "curated_id", "curated_examples"), ("quarantine_events", "curated_id", "curated_examples"), ("ingest_files", "ingest_run_id", "ingest_runs")]
# Columns whose older value stays where an upsert brings none.
KEPT = {"ingest_files": ["ingest_run_id"], "training_runs": ["finished_at", "train_rows", "metrics_json"]}


def empty(spark: SparkSession, name: str) -> DataFrame:
    """Q14: a table without rows."""
    return spark.createDataFrame([], TABLES[name][0])


def dangling(tables: dict[str, DataFrame]) -> DataFrame:
    """Q14: rows whose reference names nothing: table, column, value, n."""
    parts = []
    for name, column, other in REFERENCES:
        if name in tables and other in tables:
            key = TABLES[other][1][0]
            own = tables[name].where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value"))
            lost = own.join(tables[other].select(F.col(key).cast("string").alias("value")), "value", "left_anti")
            parts.append(lost.groupBy("value").agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), F.lit(column).alias("column"), "value", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def state(log: DataFrame, name: str, at: str = "at") -> DataFrame:
    """Q9: the latest row of each key; some columns keep the last value that was not null. One aggregation, no sort of the log."""
    key, kept = TABLES[name][1], KEPT.get(name, [])
    rest = [c for c in log.columns if c not in key + kept + [at]]
    last = F.max_by(F.struct(*rest), at).alias("last_")
    older = [F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(at))).alias(c) for c in kept]
    return log.groupBy(*key).agg(last, *older).select(*key, "last_.*", *kept).select(*[c for c in log.columns if c != at])


def overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Q2: counts of the tables in one row each: name, n."""
    counts = {
        "ingest_files": F.lit(True), "training_manifests": F.lit(True), "quarantine_events": F.lit(True), "rag_indexed": F.col("status") == "indexed" if "rag_sources" in tables else None,
        "training_runs": F.lit(True), "ingest_runs": F.lit(True), "source_registry": F.lit(True),
    }
    parts = [tables["rag_sources" if k == "rag_indexed" else k].agg(F.count_if(c).alias("n")).select(F.lit(k).alias("name"), "n") for k, c in counts.items() if ("rag_sources" if k == "rag_indexed" else k) in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def newest(rows: DataFrame, by: str, n: int, key: str) -> DataFrame:
    """Q3, Q8, Q11, Q12: the newest rows of a list; ties by key."""
    return rows.orderBy(F.col(by).desc_nulls_last(), key).limit(n)


def count_lines(lines: DataFrame) -> DataFrame:
    """Q12: path, harness, row_count of the raw files (lines that are not blank); lines: source_path, value."""
    return lines.groupBy(F.col("source_path").alias("path")).agg(F.count_if(F.btrim("value", F.lit(WHITE)) != "").alias("row_count")).select("path", harness_of_file(F.col("path")).alias("harness"), "row_count")


def run_events(events: DataFrame, *, key: str = "run_id") -> DataFrame:
    """Q10: runs from their events (run_id, event start/finish/fail, at, total_rows, details): the last event decides; a start again forgets what was before."""
    w = Window.partitionBy(key)
    seen = events.withColumn("began_", F.max(F.when(F.col("event") == "start", F.col("at"))).over(w)).where(F.col("at") >= F.col("began_"))
    ended = F.col("event") != "start"
    status = F.when(F.max_by("event", "at") == "start", "running").when(F.max_by("event", "at") == "fail", "failed").otherwise("completed")
    details = F.max_by(F.when(F.col("details").isNotNull(), F.col("details")), F.when(F.col("details").isNotNull(), F.col("at")))
    return seen.groupBy(key).agg(F.max_by("pipeline", F.when(F.col("event") == "start", F.col("at"))).alias("pipeline"), F.min("at").alias("started_at"), F.max(F.when(ended, F.col("at"))).alias("finished_at"), status.alias("status"), F.coalesce(F.max_by(F.when(ended, F.col("total_rows")), F.when(ended, F.col("at"))), F.lit(0)).alias("total_rows"), F.coalesce(details, F.lit("{}")).alias("details_json"))


def sync_registry(specs: DataFrame, at: Column) -> DataFrame:
    """Q13: the whole registry anew; to be written over the old one."""
    return specs.withColumn("synced_at", at)


def probe(rows: DataFrame, dataset: str) -> DataFrame:
    """Q13: what a dataset looks like: its column types and the keys of its rows."""
    features = rows.schema.json()
    return rows.sparkSession.createDataFrame([(dataset, features, ",".join(rows.columns))], "dataset_id string, features_json string, sample_keys string")


def quarantine(curated: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(curated rows with the requested ones at tier 0, events to add, requests that name no row). requests: curated_id, reason, operator, created_at."""
    asked = requests.select("curated_id").distinct().withColumn("asked_", F.lit(True))
    after = curated.join(asked, "curated_id", "left").withColumn("train_tier", F.when(F.col("asked_"), 0).otherwise(F.col("train_tier"))).select(*curated.columns)
    events = requests.join(curated.select("curated_id", F.col("train_tier").alias("train_tier_before")), "curated_id").withColumn("train_tier_after", F.lit(0))
    return after, events, requests.join(curated.select("curated_id"), "curated_id", "left_anti")


def disk_runs(paths: list[tuple[str, float, bool]], known: set[str] = frozenset(), most: int = 20) -> list[dict]:
    """The newest run folders (name, time, whether an adapter is there) that are not in the table yet."""
    newest_ = sorted(paths, key=lambda p: (-p[1], p[0]))[:most]
    return [{"run_name": n, "has_adapter": a, "status": "completed" if a else "incomplete"} for n, _, a in newest_ if n not in known]
