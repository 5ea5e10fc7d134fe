"""More queries of the catalogue: runs over the lake, manifests, samples, control tables, datasets; each with its SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import safety, text
from ..functions import variant as J
from ..operators import control, curate, mix, rag, scan
from ..sources import datasets
from ..streaming import harvest
from .catalogue import ADDRESS, BEGINNINGS, CURATED, GIVEN, HITS, MAIL, MIX, SHAPES, TURNS, WS, _block_warn, curated, given, mix_manifest, rated, read, register


def raw_turns(spark, d):
    """The conversations as raw turns of two files and four sources, public every third; the second turn of every fifth holds what may be a secret."""
    c = read(spark, d, "conversations")
    begin = F.element_at(F.array(*map(F.lit, BEGINNINGS)), (F.col("conv_id") % len(BEGINNINGS) + 1).cast("int"))
    c = c.withColumn("text", F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 2), F.concat("text", F.lit(" "), begin, F.upper(F.md5(F.col("conv_id").cast("string"))))).otherwise(F.col("text")))
    public = F.col("conv_id") % 3 == 0
    harness = F.when(public, F.concat(F.lit("public_ds"), F.col("conv_id") % 4)).when(F.col("conv_id") % 3 == 1, "cursor").otherwise("codex")
    return c.select(
        F.when(public, "public").otherwise(harness).alias("source"), harness.alias("harness"), F.col("conv_id").cast("string").alias("session_id"), F.lit("/x").alias("source_path"), "role", "text", F.col("turn").alias("line_no"), F.when(public, F.concat(F.lit("ds"), F.col("conv_id") % 4)).alias("dataset_id"),
        F.when(F.col("conv_id") % 2 == 0, "pass").alias("exec"), F.lit(None).cast("string").alias("verify"), F.lit(None).cast("string").alias("label"), F.concat(F.lit("f"), F.col("conv_id") % 2).alias("_source_file"), (F.col("conv_id") * 100 + F.col("turn")).alias("_line_no"), F.lit(None).cast("string").alias("_parse_error"),
    )


SMALL = {"general": {**curate.DEFAULTS, "max_messages": 4, "overlap": 1}, "personal": {"min_messages": 3, "min_message_chars": 8, "min_total_chars": 100}, "by_harness": {"codex": {"min_message_chars": 30, "max_messages": 5}}}
BLOCKING = " OR ".join(f"regexp_matches(body, '{p}')" for k, p in SHAPES if k != "generic_api_key")
CURATE = f"""WITH t AS (SELECT conv_id, turn, lower(role) AS role, trim(CASE WHEN conv_id % 5 = 0 AND turn = 2 THEN text || ' ' || {BEGINNINGS}[conv_id % {len(BEGINNINGS)} + 1] || upper(md5(CAST(conv_id AS VARCHAR))) ELSE text END, {WS}) AS text, conv_id % 3 AS kind FROM conversations),
f AS (SELECT * FROM t WHERE role IN ('user', 'assistant') AND length(text) >= CASE kind WHEN 0 THEN 40 WHEN 1 THEN 8 ELSE 30 END),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n, CASE kind WHEN 2 THEN 5 ELSE 4 END AS most FROM f),
s AS (SELECT DISTINCT conv_id, n, most, unnest(CASE WHEN n <= most THEN [0] ELSE range(0, CAST(ceil((n - most) / (most - 1.0)) AS BIGINT) * (most - 1) + 1, most - 1) END) AS start FROM o),
w AS (SELECT s.conv_id, o.kind, s.start, count(*) AS messages, sum(length(o.text)) AS chars, string_agg(o.text, chr(10) || chr(10) ORDER BY o.i) AS body, bool_or(role = 'user') AND bool_or(role = 'assistant') AS pair FROM s JOIN o ON o.conv_id = s.conv_id AND o.i >= s.start AND o.i < s.start + s.most GROUP BY 1, 2, 3),
k AS (SELECT * FROM w WHERE messages >= CASE kind WHEN 0 THEN 2 ELSE 3 END AND chars >= CASE kind WHEN 0 THEN 200 ELSE 100 END AND pair),
run AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY start) - 1 AS chunk_index, count(*) OVER (PARTITION BY conv_id) AS chunk_count, messages, CASE WHEN kind = 0 THEN 'public' END AS data_source, CASE WHEN kind = 0 THEN 'ds' || (conv_id % 4) END AS public_dataset, CASE WHEN {BLOCKING} THEN 0 ELSE 1 END AS train_tier FROM k)"""


def _run(spark, d):
    return curate.curate(raw_turns(spark, d), settings=SMALL)


@register(CURATE + " SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(chunk_index AS INTEGER) AS chunk_index, CAST(chunk_count AS INTEGER) AS chunk_count, messages, data_source, public_dataset, train_tier FROM run")
def curate_run(spark, d):
    """C1 to C11, with the safety part of C10."""
    return _run(spark, d).select("meta.session_id", "meta.chunk_index", "meta.chunk_count", F.size("messages").cast("long").alias("messages"), "meta.data_source", "meta.public_dataset", "meta.train_tier")


@register(CURATE + " SELECT train_tier, count(*) AS n FROM run GROUP BY 1")
def curate_tiers(spark, d):
    return curate.tier_counts(_run(spark, d))


@register(CURATE + " SELECT CASE conv_id % 3 WHEN 1 THEN 'cursor' ELSE 'codex' END AS harness, count(*) AS rows FROM run WHERE data_source IS NULL AND train_tier >= 1 GROUP BY 1")
def personal_export(spark, d):
    """C14."""
    return curate.personal_export(_run(spark, d))[1]


@register("""WITH t AS (SELECT CASE conv_id % 3 WHEN 0 THEN 'public_ds' || (conv_id % 4) WHEN 1 THEN 'cursor' ELSE 'codex' END AS harness, CASE conv_id % 3 WHEN 0 THEN 'public' WHEN 1 THEN 'cursor' ELSE 'codex' END AS source, 'f' || (conv_id % 2) AS file FROM conversations)
SELECT 'total' AS kind, '*' AS name, count(*) AS n FROM t UNION ALL SELECT 'file', file, count(*) FROM t GROUP BY 2 UNION ALL (SELECT 'harness', harness, count(*) AS n FROM t GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 3) UNION ALL (SELECT 'source', source, count(*) AS n FROM t GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 2)""")
def lake_counts(spark, d):
    """C15."""
    return curate.lake_stats(raw_turns(spark, d), (3, 2))


SCANNED = f"""WITH {GIVEN}, {HITS}, diff AS (SELECT doc_id FROM documents WHERE doc_id % 4 = 0),
c AS (SELECT g.doc_id, count(kind) FILTER (kind <> 'generic_api_key') AS block, count(kind) FILTER (kind = 'generic_api_key') AS warn FROM given g LEFT JOIN hits USING (doc_id) GROUP BY 1),
r AS (SELECT 'f' || (doc_id % 3) AS source_file, CASE WHEN doc_id % 13 = 0 THEN 1 ELSE block END AS block, CASE WHEN doc_id % 13 = 0 THEN 0 ELSE warn END AS warn FROM c)"""


def scan_input(spark, d):
    bad = F.col("doc_id") % 13 == 0
    none = F.lit(None).cast("string")
    return given(spark, d).select(F.lit("x").alias("source"), F.lit("h").alias("harness"), F.col("source").alias("session_id"), none.alias("source_path"), none.alias("role"), F.when(~bad, F.col("text")).alias("text"), F.concat(F.lit("f"), F.col("doc_id") % 3).alias("_source_file"), F.col("doc_id").alias("_line_no"), F.when(bad, "broken").alias("_parse_error"))


@register(SCANNED + " SELECT source_file, count(*) AS scanned, count(*) FILTER (block > 0) AS failed, count(*) FILTER (block = 0 AND warn > 0) AS warned FROM r GROUP BY 1")
def scan_totals(spark, d):
    """F13 and F14."""
    return scan.scan_counts(scan_input(spark, d))


@register(SCANNED + " SELECT CASE WHEN block > 0 THEN 'block' ELSE 'warn' END AS max_severity, count(*) AS n, CAST(sum(block) AS BIGINT) AS block, CAST(sum(warn) AS BIGINT) AS warn FROM r WHERE block + warn > 0 GROUP BY 1")
def severity_split(spark, d):
    """Failures and warnings of one scan."""
    return scan.scan(scan_input(spark, d)).groupBy("max_severity").agg(F.count("*").alias("n"), F.sum("block_count").alias("block"), F.sum("warn_count").alias("warn"))


ADDED = f"""added AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN NULL ELSE line END AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM given))"""


@register(f"""WITH {GIVEN}, l AS (SELECT doc_id, i, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM given) WHERE (doc_id + i) % 2 = 1),
t AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS t FROM l WHERE NOT starts_with(line, '++') GROUP BY 1), m AS (SELECT doc_id, regexp_extract_all(t, '(?i)(?:password|passwd|pwd)[[:space:]]*[:=][[:space:]]*[''\"]?([^[:space:]''\"#]{{6,}})', 1) AS m FROM t)
SELECT doc_id, coalesce(len(m), 0) AS passwords, left(m[1], 80) AS detail FROM documents LEFT JOIN m USING (doc_id)""")
def diff_passwords(spark, d):
    """a password counts where its line was added (every second line), with its value only; whole texts."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.when((F.col("doc_id") + i) % 2 == 0, "+").otherwise("-"), x))
    found = F.filter(safety.scan_diff(F.array_join(lines, "\n")), lambda f: f.kind == "password_assignment")
    return safety.once(given(spark, d), "found", found).select("doc_id", F.size("found").cast("long").alias("passwords"), F.try_element_at(F.transform("found", lambda f: f.detail), F.lit(1)).alias("detail"))


@register(f"""WITH p AS (SELECT doc_id, regexp_extract_all(text, '{MAIL}') AS e, regexp_extract_all(text, '{ADDRESS}') AS i FROM documents)
SELECT kind, count(*) AS n, max(severity) AS severity FROM (SELECT 'EMAIL_ADDRESS' AS kind, 'block' AS severity, unnest(e) FROM p UNION ALL SELECT 'IP_ADDRESS', 'warn', unnest(i) FROM p) GROUP BY 1""")
def personal_kinds(spark, d):
    """F5, F6, F9."""
    policy = safety.Policy(entities=("EMAIL_ADDRESS", "IP_ADDRESS"))
    f = read(spark, d, "documents").select(F.explode(safety.judged(safety.personal(F.col("text"), policy), policy)).alias("f"))
    return f.groupBy(F.col("f.kind").alias("kind")).agg(F.count("*").alias("n"), F.max("f.severity").alias("severity"))


@register(f"WITH {GIVEN}, {HITS}, c AS (SELECT g.doc_id, count(kind) FILTER (kind <> 'generic_api_key') AS b, count(kind) FILTER (kind = 'generic_api_key') AS w FROM given g LEFT JOIN hits USING (doc_id) GROUP BY 1) SELECT count(*) AS rows, count(*) FILTER (b > 0) AS rows_quarantine, count(*) FILTER (b > 0) AS rows_with_block, count(*) FILTER (w > 0) AS rows_with_warn, CAST(sum(b) AS BIGINT) AS block_findings, CAST(sum(w) AS BIGINT) AS warn_findings FROM c")
def audit_totals(spark, d):
    """X8."""
    rows = _block_warn(rated(spark, d)).withColumnsRenamed({"block": "block_count", "warn": "warn_count"})
    return mix.audit_totals(rows.withColumn("quarantine", F.col("block_count") > 0))


@register("""WITH p AS (SELECT source, doc_id, md5('7' || doc_id) AS h, row_number() OVER (PARTITION BY source ORDER BY md5('7' || doc_id), doc_id) AS r FROM documents), n AS (SELECT greatest(1, 30 // count(DISTINCT source)) AS per FROM documents)
SELECT doc_id FROM (SELECT doc_id FROM p, n ORDER BY CASE WHEN r <= per THEN 0 ELSE 1 END, CASE WHEN r <= per THEN source END, CASE WHEN r > per THEN h END, r, doc_id LIMIT 30)""")
def audit_topped_up(spark, d):
    """M2."""
    return mix.audit_sample(read(spark, d, "documents").select("doc_id", "source"), "source", "doc_id", 30).select("doc_id")


@register(f"""WITH {CURATED}, n AS (SELECT count(*) FILTER (train_tier = 2) AS two, count(*) FILTER (train_tier = 1) AS one FROM cur), k AS (SELECT least(greatest(0, 60 - two), CAST(floor(one * 0.25) AS BIGINT), one) AS k FROM n)
SELECT curated_id FROM cur WHERE train_tier = 2 UNION ALL SELECT curated_id FROM (SELECT curated_id, row_number() OVER (ORDER BY md5('42' || curated_id), curated_id) AS r FROM cur WHERE train_tier = 1), k WHERE r <= k""")
def replay_sample(spark, d):
    """M1."""
    return mix.replay(curated(spark, d), "curated_id", target=60).select("curated_id")


@register(f"""WITH {CURATED}, r AS (SELECT curated_id, data_source, row_number() OVER (PARTITION BY data_source ORDER BY md5('42' || curated_id), curated_id) AS nth, count(*) OVER (PARTITION BY data_source) AS n FROM cur)
SELECT curated_id, CASE WHEN n >= 8 AND nth <= ceil(n * 0.1::DOUBLE) AND (SELECT count(*) FROM cur) >= 20 THEN 'eval' ELSE 'train' END AS split FROM r""")
def holdout_split(spark, d):
    """M14."""
    return mix.holdout(curated(spark, d), "curated_id").select("curated_id", "split")


@register(f"""WITH m AS ({MIX}) SELECT count(*) AS total, count(*) FILTER (data_source <> 'public') AS personal, count(*) FILTER (data_source = 'public') AS public, round(count(*) FILTER (data_source <> 'public') / count(*), 4) AS personal_ratio, round(avg(sample_weight), 4) AS mean_sample_weight FROM m""")
def train_stats(spark, d):
    """M9."""
    return mix.train_stats(mix_manifest(spark, d))


@register(f"WITH m AS ({MIX}), {CURATED} SELECT m.curated_id, 'conv' AS source_file, conv_id AS source_line, sort_order, sample_weight FROM m JOIN cur USING (curated_id)")
def manifest_pointers(spark, d):
    """M5."""
    index = curated(spark, d).select("curated_id", F.lit("conv").alias("source_file"), F.col("conv_id").alias("source_line"), "harness", "data_source", "public_dataset")
    rows = mix_manifest(spark, d).select(F.lit("m").alias("manifest_id"), "curated_id", "sort_order", "sample_weight")
    return mix.pointers(rows, index, "m").select("curated_id", "source_file", "source_line", "sort_order", "sample_weight")


@register(f"""WITH {CURATED}, x AS (SELECT conv_id, CASE conv_id % 4 WHEN 0 THEN 'public_a' WHEN 1 THEN 'publicXb' WHEN 2 THEN 'private' ELSE 'public_c' END AS harness, data_source, CASE WHEN conv_id % 8 = 0 THEN '' ELSE public_dataset END AS public_dataset FROM cur)
SELECT conv_id, CASE WHEN harness LIKE 'public_%' THEN 'public' ELSE data_source END AS data_source, CASE WHEN harness LIKE 'public_%' THEN coalesce(nullif(public_dataset, ''), replace(harness, 'public_', '')) ELSE public_dataset END AS public_dataset FROM x""")
def backfill_source(spark, d):
    """M6."""
    name = F.element_at(F.array(*map(F.lit, ("public_a", "publicXb", "private", "public_c"))), (F.col("conv_id") % 4 + 1).cast("int"))
    rows = curated(spark, d).withColumn("harness", name).withColumn("public_dataset", F.when(F.col("conv_id") % 8 == 0, "").otherwise(F.col("public_dataset")))
    return mix.backfill(rows).select("conv_id", "data_source", "public_dataset")


@register(f"""WITH {TURNS}, m AS (SELECT session_id, count(*) AS messages, CAST(sum(least(length(text), 300) + CASE WHEN length(text) > 300 THEN length(chr(10) || '...[truncated for VRAM]') ELSE 0 END) AS BIGINT) AS chars, bool_or(role = 'assistant') AS said FROM (SELECT * FROM t WHERE role IN ('user', 'assistant') AND text <> '') GROUP BY 1)
SELECT session_id, messages, chars, greatest((session_id % 4) / 10.0::DOUBLE, 0.05::DOUBLE) AS sample_weight FROM m WHERE messages >= 2 AND said""")
def train_rows(spark, d):
    """What a training run reads."""
    c = read(spark, d, "conversations").where("lower(role) in ('user', 'assistant')")
    s = c.groupBy(F.col("conv_id").alias("session_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.lower("role").alias("role"), "text"))), lambda x: F.struct(x.role.alias("role"), x.text.alias("content"))).alias("messages"))
    s = s.withColumns({"data_source": F.lit(None).cast("string"), "harness": F.lit("h"), "sample_weight": F.col("session_id") % 4 / F.lit(10.0)})
    out = mix.train_set(s, cap=300)
    return out.select("session_id", F.size("messages").cast("long").alias("messages"), F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m.content)).alias("chars"), "sample_weight")


@register("""WITH n AS (SELECT length(text) // 4 AS n FROM documents) SELECT count(*) AS rows, quantile_disc(n, 0.5)::BIGINT AS p50, quantile_disc(n, 0.95)::BIGINT AS p95, quantile_disc(n, 0.99)::BIGINT AS p99, max(n)::BIGINT AS longest, count(*) FILTER (n > 512) AS above_512, count(*) FILTER (n > 1024) AS above_1024,
count(*) FILTER (n > 2048) AS above_2048, count(*) FILTER (n > 4096) AS above_4096, CAST(greatest(512, least(8192, ceil(floor(quantile_disc(n, 0.95) * 1.05) / 256) * 256)) AS BIGINT) AS recommended FROM n""")
def length_audit(spark, d):
    """M13."""
    return mix.length_audit(read(spark, d, "documents").select(F.floor(F.length("text") / 4).cast("long").alias("n")), "n")


@register("""SELECT path, harness, row_count, ingest_run_id FROM (SELECT 'p' || user_id AS path, arg_max(event_type, event_id) AS harness, CAST(arg_max(event_id, event_id) AS BIGINT) AS row_count, arg_max(CASE WHEN event_id % 3 = 0 THEN 'r' || event_id END, CASE WHEN event_id % 3 = 0 THEN event_id END) AS ingest_run_id FROM events GROUP BY user_id)""")
def upsert_state(spark, d):
    """Q9: the state of an append-only table; the run id stays where a later row has none."""
    e = read(spark, d, "events").select(F.concat(F.lit("p"), "user_id").alias("path"), F.col("event_type").alias("harness"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("r"), "event_id")).alias("ingest_run_id"), F.col("event_id").alias("row_count"), F.col("event_id").alias("at"))
    return control.state(e, "ingest_files").select("path", "harness", "row_count", "ingest_run_id")


@register("""WITH e AS (SELECT user_id, event_id, CASE event_id % 5 WHEN 0 THEN 'start' WHEN 1 THEN 'fail' ELSE 'finish' END AS event FROM events), b AS (SELECT user_id, max(event_id) AS began FROM e WHERE event = 'start' GROUP BY 1), s AS (SELECT e.* FROM e JOIN b USING (user_id) WHERE event_id >= began)
SELECT CAST(user_id AS VARCHAR) AS run_id, CASE arg_max(event, event_id) WHEN 'start' THEN 'running' WHEN 'fail' THEN 'failed' ELSE 'completed' END AS status, min(event_id) AS started_at, max(event_id) FILTER (event <> 'start') AS finished_at, coalesce(arg_max(event_id % 100, event_id) FILTER (event <> 'start'), 0) AS total_rows FROM s GROUP BY 1""")
def run_states(spark, d):
    """Q10."""
    i = F.col("event_id")
    e = read(spark, d, "events").select(F.col("user_id").cast("string").alias("run_id"), F.when(i % 5 == 0, "start").when(i % 5 == 1, "fail").otherwise("finish").alias("event"), i.alias("at"), (i % 100).alias("total_rows"), F.lit(None).cast("string").alias("details"), F.lit("p").alias("pipeline"))
    return control.run_events(e).select("run_id", "status", "started_at", "finished_at", "total_rows")


@register("SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started_at FROM events ORDER BY ts DESC, event_id LIMIT 20")
def newest_runs(spark, d):
    """Q8, Q11, Q12."""
    return control.newest(read(spark, d, "events"), "ts", 20, "event_id").select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("started_at"))


@register("""SELECT 'ingest_files' AS name, count(*) AS n FROM orders UNION ALL SELECT 'training_manifests', count(*) FROM customer UNION ALL SELECT 'quarantine_events', count(*) FROM events UNION ALL SELECT 'rag_indexed', count(*) FROM pages WHERE page_id % 3 = 0""")
def overview_counts(spark, d):
    """Q2."""
    pages = read(spark, d, "pages").select(F.when(F.col("page_id") % 3 == 0, "indexed").otherwise("failed").alias("status"))
    return control.overview({"ingest_files": read(spark, d, "orders"), "training_manifests": read(spark, d, "customer"), "quarantine_events": read(spark, d, "events"), "rag_sources": pages})


@register("""SELECT 'quarantine_events' AS "table", 'curated_id' AS "column", CAST(user_id AS VARCHAR) AS value, count(*) AS n FROM events WHERE user_id NOT IN (SELECT conv_id FROM conversations) GROUP BY 3""")
def dangling_references(spark, d):
    """Q14."""
    e = read(spark, d, "events").select(F.col("user_id").cast("string").alias("curated_id"))
    c = read(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("curated_id")).distinct()
    return control.dangling({"quarantine_events": e, "curated_examples": c})


@register(f"""WITH {CURATED}, q AS (SELECT event_id, user_id FROM events WHERE event_id % 50 = 0) SELECT conv_id, CASE WHEN conv_id IN (SELECT user_id FROM q) THEN 0 ELSE train_tier END AS train_tier FROM cur""")
def quarantine_rows(spark, d):
    """tiers after requests; requests that name no row change nothing."""
    c = curated(spark, d)
    asked = read(spark, d, "events").where("event_id % 50 = 0").join(c.select(F.col("conv_id").alias("user_id"), "curated_id"), "user_id", "left").select(F.coalesce("curated_id", F.lit("none")).alias("curated_id"), F.lit("r").alias("reason"))
    return control.quarantine(c, asked)[0].select("conv_id", "train_tier")


PAIRS = f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE trim(coalesce(lang, ''), {WS}) END AS u0, trim(coalesce(source, ''), {WS}) AS u1, CASE WHEN doc_id % 7 = 0 THEN '' ELSE trim(text, {WS}) END AS a, CASE WHEN doc_id % 5 = 0 THEN 'why' ELSE '' END AS t FROM documents),
p AS (SELECT doc_id, coalesce(nullif(u0, ''), u1) AS u, CASE WHEN t <> '' AND a <> '' THEN '[thinking]' || chr(10) || t || chr(10) || chr(10) || a ELSE a END AS a FROM r)"""


@register(PAIRS + " SELECT CAST(doc_id AS VARCHAR) AS session_id, line_no, role, md5(text) AS digest FROM (SELECT doc_id, 1 AS line_no, 'user' AS role, u AS text FROM p WHERE u <> '' AND a <> '' UNION ALL SELECT doc_id, 2, 'assistant', a FROM p WHERE u <> '' AND a <> '')")
def dataset_pairs(spark, d):
    """Instruction pairs by key lists."""
    i = F.col("doc_id")
    rows = read(spark, d, "documents").select(i.alias("id"), F.when(i % 3 != 0, F.col("lang")).alias("instruction"), F.struct(F.col("source").alias("content")).alias("prompt"), F.when(i % 7 == 0, "").otherwise(F.col("text")).alias("response"), F.when(i % 5 == 0, "why").alias("thinking"))
    return datasets.instruction_pairs(rows, "pairs", "v").select("session_id", F.col("line_no").cast("int").alias("line_no"), "role", F.md5("text").alias("digest"))


@register(f"""WITH t AS (SELECT conv_id, turn, lower(role) AS role, trim(text, {WS}) AS text FROM conversations) SELECT CAST(conv_id AS VARCHAR) AS session_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS INTEGER) AS line_no, role, md5(text) AS digest FROM t WHERE role IN ('user', 'assistant') AND text <> ''""")
def dataset_chats(spark, d):
    """Sessions from turn rows (here with falling turn numbers)."""
    rows = read(spark, d, "conversations").orderBy("conv_id", "turn").select(F.col("conv_id").cast("string").alias("session_id"), (-F.col("turn")).alias("turn_number"), "role", F.col("text").alias("content"), F.lit(None).cast("string").alias("turn_type"), F.lit(None).cast("string").alias("tool_name"))
    return datasets.swe_chat(rows).select("session_id", F.col("line_no").cast("int").alias("line_no"), "role", F.md5("text").alias("digest"))


@register(r"SELECT doc_id FROM documents WHERE regexp_matches(lower(coalesce(source, '') || ' ' || CASE WHEN doc_id % 3 = 0 THEN 'Python' WHEN doc_id % 3 = 1 THEN 'poem' ELSE '' END), 'code|coding|program|debug|software|swe|agent|tool|python|rust|typescript|javascript|go|java') OR trim(coalesce(source, '')) = ''")
def code_rows(spark, d):
    """P16."""
    task = F.when(F.col("doc_id") % 3 == 0, "Python").when(F.col("doc_id") % 3 == 1, "poem").otherwise("")
    rows = datasets.indexed(read(spark, d, "documents").select("doc_id", "source", task.alias("task")))
    return rows.where(datasets.looks_like_code()).select(F.try_variant_get("v", "$.doc_id", "long").alias("doc_id"))


@register("""SELECT conv_id, turn, CASE (conv_id + turn) % 4 WHEN 0 THEN CASE WHEN lower(role) IN ('user', 'assistant') THEN lower(role) END WHEN 1 THEN 'user' WHEN 2 THEN CASE WHEN lower(role) IN ('user', 'assistant') THEN lower(role) END END AS speaker FROM conversations""")
def speakers(spark, d):
    """The speaker from role, type or the message's role."""
    k = (F.col("conv_id") + F.col("turn")) % 4
    shape = F.when(k == 0, F.to_json(F.struct(F.upper("role").alias("role")))).when(k == 1, F.lit('{"role": "x", "type": "Human"}')).when(k == 2, F.to_json(F.struct(F.struct("role").alias("message")))).otherwise(F.lit('{"role": ["user"], "type": 1}'))
    return read(spark, d, "conversations").select("conv_id", "turn", J.speaker(F.try_parse_json(shape)).alias("speaker"))


@register(f"""SELECT conv_id, turn, md5(trim(CASE WHEN turn % 3 = 0 THEN trim(text, {WS}) WHEN turn % 3 = 1 THEN trim(text, {WS}) || chr(10) || '[tool grep] command=' || CASE WHEN length(trim(left(text, 200), {WS})) > 120 THEN left(trim(left(text, 200), {WS}), 117) || chr(8230) ELSE trim(left(text, 200), {WS}) END || ' path=/x' ELSE '' END, {WS})) AS digest FROM conversations""")
def content_blocks(spark, d):
    """A string, a list of blocks with a tool call, neither."""
    tagged = F.concat(F.lit("before <user_query> "), "text", F.lit(" </user_query> after"))
    tool = F.struct(F.lit("tool_use").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("grep").alias("name"), F.struct(F.left("text", F.lit(200)).alias("command"), F.lit("/x").alias("path"), F.lit("z").alias("other")).alias("input"))
    said = F.struct(F.lit("text").alias("type"), tagged.alias("text"), F.lit(None).cast("string").alias("name"), F.lit(None).cast(tool_input()).alias("input"))
    image = F.struct(F.lit("image").alias("type"), F.lit("no").alias("text"), F.lit(None).cast("string").alias("name"), F.lit(None).cast(tool_input()).alias("input"))
    body = F.when(F.col("turn") % 3 == 0, F.to_json(F.struct(tagged.alias("content")))).when(F.col("turn") % 3 == 1, F.to_json(F.struct(F.array(said, image, tool).alias("content")))).otherwise(F.lit('{"content": 7}'))
    return read(spark, d, "conversations").select("conv_id", "turn", F.md5(J.spoken_content(F.try_parse_json(body), "$.content")).alias("digest"))


def tool_input() -> str:
    return "struct<command:string,path:string,other:string>"


FILES = ["raw/public-swe-next-2026-01-02.jsonl", "cursor-2026-01-02.jsonl", "git-diffs-2026-01-02.jsonl", "codex-x.jsonl", "kimi-sessions-2026-01-02.jsonl", "plain.jsonl"]


@register(f"SELECT page_id, ['public_swe_next', 'cursor', 'git', 'codex', 'kimi', 'plain'][page_id % 6 + 1] AS harness, CASE WHEN page_id % 4 = 0 THEN '/home/a/Documents/b' WHEN page_id % 4 = 1 THEN '/home/a/b/c' END AS repo, CASE WHEN page_id % 2 = 0 THEN 'public:ds' ELSE '' END AS project FROM pages")
def names_of_paths(spark, d):
    """N10 and N11."""
    i = F.col("page_id")
    file = F.element_at(F.array(*map(F.lit, FILES)), (i % 6 + 1).cast("int"))
    path = F.when(i % 4 == 0, "/home/a/Documents/b/c.py").when(i % 4 == 1, "/home/a/b/c/d.py").otherwise("/tmp/x")
    return read(spark, d, "pages").select("page_id", text.harness_of_file(file).alias("harness"), text.repo_of_path(path).alias("repo"), text.project(path, F.when(i % 2 == 0, "ds")).alias("project"))


@register(f"""WITH t AS (SELECT doc_id, trim(text, {WS}) AS t FROM documents), s AS (SELECT doc_id, t, unnest(CASE WHEN length(t) <= 300 THEN [0] ELSE range(0, length(t), 270) END) AS start FROM t WHERE t <> '' AND doc_id % 5 > 0 AND doc_id % 11 <> 1),
c AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS k, c FROM (SELECT doc_id, start, trim(substr(t, start + 1, 300), {WS}) AS c FROM s) WHERE c <> '')
SELECT 's' || doc_id || ':' || k || ':' || left(sha256(c), 16) AS id, CAST(k AS INTEGER) AS chunk_index FROM c""")
def index_chunks(spark, d):
    """The index's rows; sources that another service serves are left out."""
    return rag.index(_sources(spark, d), size=300, overlap=30, most=None)[0].select("id", "chunk_index")


def _sources(spark, d):
    i = F.col("doc_id")
    return read(spark, d, "documents").select(F.concat(F.lit("s"), i).alias("source_id"), F.lit("u").alias("url"), F.lit("page").alias("kind"), F.lit(0).alias("tier"), F.when(i % 5 == 0, "lib").alias("library"), F.when(i % 11 != 1, F.col("text")).alias("body"))


@register(f"""WITH x AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'context7_only' WHEN doc_id % 11 = 1 OR trim(text, {WS}) = '' THEN 'failed' ELSE 'indexed' END AS status FROM documents) SELECT status, count(*) AS n FROM x GROUP BY 1""")
def index_status(spark, d):
    return rag.index(_sources(spark, d), size=300, overlap=30, most=None)[1].groupBy("status").agg(F.count("*").alias("n"))


@register("""WITH h AS (SELECT page_id, page_id % 4 <> 0 AS ok, CASE WHEN page_id % 5 <> 0 THEN html END AS html FROM pages) SELECT CASE WHEN NOT ok OR html IS NULL OR page_id % 3 = 0 THEN 'rejected' ELSE 'seen' END AS bucket, CASE WHEN NOT ok THEN 'path' WHEN html IS NULL THEN 'gone' WHEN page_id % 3 = 0 THEN 'empty_parse' END AS reason, count(*) AS n,
CAST(sum(CASE WHEN ok AND html IS NOT NULL AND page_id % 3 > 0 THEN page_id % 3 ELSE 0 END) AS BIGINT) AS records FROM h GROUP BY ALL""")
def harvest_outcomes(spark, d):
    """V10."""
    i = F.col("page_id")
    hits = read(spark, d, "pages").select(F.lit("r").alias("repo"), i.cast("string").alias("path"), F.md5("html").alias("sha"), (i % 4 != 0).alias("ok"), F.when(i % 5 != 0, F.col("html")).alias("content"))
    parsed = read(spark, d, "pages").where(i % 3 > 0).select(F.explode(F.sequence(F.lit(1), i % 3)), F.struct(F.lit("r").alias("repo"), i.cast("string").alias("path")).alias("github"))
    return harvest.counters(harvest.outcomes(hits, parsed))


@register("SELECT page_id FROM pages WHERE CASE page_id % 4 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN false ELSE true END")
def searchable_queries(spark, d):
    """V14."""
    q = F.element_at(F.array(*map(F.lit, ("path:a extension:jsonl", '"role" path:a', " is:x  in:file ", "filename:a.md"))), (F.col("page_id") % 4 + 1).cast("int"))
    return read(spark, d, "pages").where(harvest.searchable(q)).select("page_id")


@register("""WITH e AS (SELECT 'd' || user_id AS dataset_id, event_id FROM events) SELECT dataset_id, event_id FROM e WHERE CASE WHEN event_id % 4 = 0 THEN false WHEN event_id % 3 = 0 THEN event_id % 5 < 3 ELSE event_id % 7 <> 0 END""")
def unchanged_datasets(spark, d):
    """Unchanged by state (every third is known), or by time."""
    i = F.col("event_id")
    e = read(spark, d, "events").select(F.concat(F.lit("d"), "user_id").alias("name"), i, i.cast("string").alias("dataset_id"), F.lit("s").alias("hub_sha"), F.lit("p").alias("loader_fingerprint"), F.when(i % 7 == 0, 3).otherwise(1).alias("hub_modified"), F.lit(2).alias("raw_modified"), (i % 4 != 0).alias("raw_exists"))
    known = e.where(i % 3 == 0).select("dataset_id", F.when(i % 5 < 3, "s").otherwise("t").alias("hub_sha"), "loader_fingerprint")
    return harvest.unchanged(e, known).select(F.col("name").alias("dataset_id"), "event_id")


@register("""WITH h AS (SELECT event_id, user_id % 5 AS query_id, (user_id % 5) * 10 AS priority, row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) AS nth FROM events) SELECT event_id FROM (SELECT event_id FROM h WHERE nth <= 30 ORDER BY priority, query_id, nth LIMIT 100)""")
def harvest_budget(spark, d):
    """V11."""
    e = read(spark, d, "events").select("event_id", (F.col("user_id") % 5).alias("query_id"), (F.col("user_id") % 5 * 10).alias("priority"), F.lit(1).alias("page"), F.col("event_id").alias("key"))
    return harvest.budgeted(e, each=30, most=100).select("event_id")


@register("""WITH d AS (SELECT coalesce(lang, '') AS lang, least(length(text) // 4 + 1, 2048) AS n FROM documents)
SELECT lang, count(*) AS rows, CAST(sum(n) AS BIGINT) AS tokens, true AS fits, true AS gapless, true AS tight FROM d GROUP BY 1""")
def packed_bins(spark, d):
    """Every row lies in one bin; bins hold what fits, without gaps, and no two of them could be one."""
    from ..operators import mix

    rows = read(spark, d, "documents").select("doc_id", "lang", (F.floor(F.length("text") / 4) + 1).alias("n"))
    bins = mix.pack(rows, "doc_id", "n", "lang").groupBy("lang", "bin").agg(F.count("*").alias("c"), F.sum("used").alias("used"), F.max(F.col("offset") + F.col("used")).alias("end"))
    two = F.array_min(F.slice(F.array_sort(F.collect_list("used")), 1, 1)) + F.coalesce(F.get(F.array_sort(F.collect_list("used")), F.lit(1)), F.lit(1 << 30))
    out = bins.groupBy("lang").agg(F.sum("c").alias("rows"), F.sum("used").alias("tokens"), (F.max("end") <= 2048).alias("fits"), F.every(F.col("end") == F.col("used")).alias("gapless"), (two > 2048).alias("tight"))
    return out


@register("""WITH c AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
h AS (SELECT conv_id, n, conv_id % 3 AS kind, count(*) FILTER (role IN ('user', 'assistant')) AS heads, count(*) FILTER (role IN ('user', 'assistant', 'tool', 'developer') AND trim(text) <> '') AS said, count(*) FILTER (role IN ('user', 'assistant', 'tool', 'developer') AND trim(text) <> '' AND i <= 40) AS early FROM c GROUP BY ALL)
SELECT conv_id, CASE kind WHEN 0 THEN early >= CASE WHEN n < 2 THEN 1 ELSE 2 END WHEN 1 THEN said >= 2 ELSE heads >= 2 END AS chat FROM h""")
def chat_sniff(spark, d):
    """V5: the conversations as lines, as one object, and as a markdown history."""
    m = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    lines = F.transform("m", lambda x: F.to_json(F.struct(x["role"].alias("role"), x["text"].alias("text"))))
    whole = F.concat(F.lit('{"messages": ['), F.array_join(lines, ","), F.lit("]}"))
    heads = F.array_join(F.transform("m", lambda x: F.concat(F.lit("#### "), x["role"], F.lit("\n> "), x["text"])), "\n")
    kind = F.col("conv_id") % 3
    blobs = m.select(F.col("conv_id").cast("string").alias("source_path"), F.when(kind == 0, "generic").when(kind == 1, "amp").otherwise("aider").alias("harness"), F.when(kind == 0, F.array_join(lines, "\n")).when(kind == 1, whole).otherwise(heads).alias("content"))
    return harvest.sniff(blobs).select(F.col("source_path").cast("long").alias("conv_id"), "chat")


@register("""WITH h AS (SELECT 'q' || (page_id % 7) AS q, (page_id % 7) // 2 AS priority, page_id // 40 + 1 AS page, CAST(page_id AS VARCHAR) AS key, page_id FROM pages),
r AS (SELECT *, CASE WHEN page <= 2 THEN 0 ELSE 1 END AS turn FROM h WHERE q >= 'q4' AND page > 0 OR page > 2 OR page_id % 3 = 0),
t AS (SELECT *, CASE WHEN q >= 'q4' THEN 1 ELSE turn END AS own FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY own, page, key) AS nth FROM t)
SELECT q AS query_id, key FROM n WHERE nth <= 9 ORDER BY own, priority, q, nth LIMIT 47""")
def harvest_resume(spark, d):
    """What a run takes after an earlier one that was done with two pages of four queries and had some hits left."""
    i = F.col("page_id")
    hits = read(spark, d, "pages").select(F.concat(F.lit("q"), i % 7).alias("query_id"), F.floor(i % 7 / 2).cast("int").alias("priority"), (F.floor(i / 40) + 1).cast("int").alias("page"), i.cast("string").alias("key"), F.md5("html").alias("sha"), "page_id")
    old = hits.where("query_id < 'q4'")
    pending = old.where("page <= 2 and page_id % 3 = 0").drop("page_id")
    progress = old.select("query_id").distinct().withColumn("page", F.lit(2))
    return harvest.next_run(hits.drop("page_id"), pending, progress, each=9, most=47)[0].select("query_id", "key")
