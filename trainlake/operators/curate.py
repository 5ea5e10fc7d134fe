"""Curation: turn dedup, filters, session quality, sliding windows, tiers, and the run over raw turns that joins them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import safety
from ..functions.text import map_role, project, repo_of_path, style_tags, tone, truncate
from ..functions.variant import strip
from .numbering import numbered
from .scan import clean_sessions, window_findings


def dedup_turns(turns: DataFrame, session: list[str], order: list[str]) -> DataFrame:
    """C4: first row of equal (source_path, line_no, role, first 200 characters) within a session. Nulls are equal."""
    key = [F.col(c) for c in session] + [F.col("source_path"), F.col("line_no"), F.col("role"), F.left(F.coalesce("text", F.lit("")), F.lit(200))]
    w = Window.partitionBy(*key).orderBy(*order)
    return turns.withColumn("nth_", F.row_number().over(w)).where("nth_ = 1").drop("nth_")


def filter_turns(turns: DataFrame, *, least: int | Column = 40, cap: int | Column = 16000, skip: tuple[str, ...] = ("developer", "system")) -> DataFrame:
    """Mapped role; the stripped text, if it is long enough, cut at a length."""
    rows = turns.withColumn("role", map_role(F.col("role"), skip)).where("role is not null").withColumn("text", strip(F.coalesce("text", F.lit(""))))
    return rows.where(F.length("text") >= least).withColumn("text", truncate(F.col("text"), cap))


def sessions(turns: DataFrame, session: list[str], order: list[str]) -> DataFrame:
    """One row a session with its messages in order."""
    item = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], "role", "text")
    return turns.groupBy(*session).agg(F.array_sort(F.collect_list(item)).alias("m")).withColumn("messages", F.transform("m", lambda x: F.struct(x.role.alias("role"), x.text.alias("content")))).drop("m")


def quality_ok(messages: Column, least: int | Column = 2, chars: int | Column = 200) -> Column:
    """C6."""
    has = lambda r: F.exists(messages, lambda x: x.role == r)
    total = F.aggregate(messages, F.lit(0), lambda a, x: a + F.length(x.content))
    return (F.size(messages) >= least) & has("user") & has("assistant") & (total >= chars)


def windows(rows: DataFrame, session: list[str], *, most: int | Column = 24, overlap: int | Column = 4, least: int | Column = 2, chars: int | Column = 200) -> DataFrame:
    """Windows of at most `most` messages; the kept ones are numbered. Settings may be columns of the session."""
    most, overlap, least, chars = (F.lit(x) if isinstance(x, int) else x for x in (most, overlap, least, chars))
    rows = rows.withColumns({"most_": most, "step_": F.greatest(F.lit(1), most - F.greatest(F.lit(0), overlap)), "least_": least, "chars_": chars})
    n, most, step = F.size("messages"), F.col("most_"), F.col("step_")
    starts = F.when(n <= most, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), (F.ceil((n - most) / step) * step).cast("int"), step))
    cut = rows.select(*session, "least_", "chars_", F.transform(starts, lambda s: F.slice("messages", s + 1, F.col("most_"))).alias("w"))
    kept = cut.withColumn("w", F.filter("w", lambda x: quality_ok(x, F.col("least_"), F.col("chars_"))))
    return kept.select(*session, F.size("w").alias("chunk_count"), F.posexplode("w").alias("chunk_index", "messages"))


def with_session(rows: DataFrame, facts: DataFrame, session: list[str]) -> DataFrame:
    """rows with the columns of a table that has a row a session."""
    facts = facts.withColumnsRenamed({c: f"{c}__" for c in session})
    return rows.join(facts, reduce(lambda x, c: x & F.col(c).eqNullSafe(F.col(f"{c}__")), session, F.lit(True))).drop(*[f"{c}__" for c in session])


def within_session(rows: DataFrame, session: list[str], order: list[str], name: str, count: str) -> DataFrame:
    """Each row's place in its session (from 0) and the session's rows, by ranges of all rows: no session is held or sorted by one task."""
    placed = numbered(rows, *session, *order, name="at_")
    span = placed.groupBy(*session).agg(F.min("at_").alias("start_"), F.count("*").alias(count))
    return with_session(placed, span, session).withColumn(name, F.col("at_") - F.col("start_")).drop("at_", "start_")


def windows_of_turns(turns: DataFrame, session: list[str], order: list[str], *, most: int | Column = 24, overlap: int | Column = 4, least: int | Column = 2, chars: int | Column = 200) -> DataFrame:
    """C2, C3 and C7 from turns (role, text) in bounded memory, whatever a session's length: session, chunk_index, chunk_count, messages.

    A turn's place in its session tells which windows it belongs to; a window's turns meet in one row, which holds `most`
    at most. The result is that of windows() over sessions()."""
    most, overlap, least, chars = (F.lit(x) if isinstance(x, int) else x for x in (most, overlap, least, chars))
    rows = turns.select(*session, *order, "role", "text", most.alias("most_"), F.greatest(F.lit(1), most - F.greatest(F.lit(0), overlap)).alias("step_"), least.alias("least_"), chars.alias("chars_"))
    rows = within_session(rows, session, [*order, "role", "text"], "i_", "n_")
    i, n, size, step = (F.col(c) for c in ("i_", "n_", "most_", "step_"))
    last = F.when(n <= size, F.lit(0)).otherwise(F.ceil((n - size) / step)).cast("long")
    low, high = F.greatest(F.lit(0), F.floor((i - size) / step) + 1).cast("long"), F.least(last, F.floor(i / step)).cast("long")
    own = rows.withColumn("w_", F.explode(F.when(low <= high, F.sequence(low, high))))
    message = F.struct("i_", F.struct("role", F.col("text").alias("content")).alias("m"))
    cut = own.groupBy(*session, "w_").agg(F.array_sort(F.collect_list(message)).alias("x"), F.first("least_").alias("least_"), F.first("chars_").alias("chars_"))
    cut = cut.withColumn("messages", F.transform("x", lambda x: x["m"])).where(quality_ok(F.col("messages"), F.col("least_"), F.col("chars_")))
    out = within_session(cut.select(*session, "w_", "messages"), session, ["w_"], "chunk_index", "chunk_count")
    return out.select(*session, F.col("chunk_count").cast("int"), F.col("chunk_index").cast("int"), "messages")


def tier(safe: Column, label: Column, exec_: Column, verify: Column, bootstrap: bool | Column = True) -> Column:
    """0 for unsafe, rejected or unaccepted; 1 where a run or a check passed (or, at the start, neither is known); else 2."""
    bad = ~F.coalesce(safe, F.lit(True)) | ~F.coalesce(F.nullif(label, F.lit("")), F.lit("accepted")).isin("accepted", "edited_heavily")
    run, check = (F.lower(F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))) for c in (exec_, verify))
    sure = (run == "pass") | check.isin("cursor_ok", "pass") | ((run == "unknown") & (check == "unknown") & (F.lit(bootstrap) if isinstance(bootstrap, bool) else bootstrap))
    return F.when(bad, 0).when(sure, 1).otherwise(2)


# Thresholds of curation (all, for personal sources, and for single ones).
DEFAULTS = {"min_messages": 2, "min_message_chars": 40, "min_total_chars": 200, "max_chars_per_message": 16000, "max_messages": 24, "overlap": 4}
PERSONAL = {"min_messages": 4, "min_message_chars": 8, "min_total_chars": 400}
BY_HARNESS = {"cursor": {"min_message_chars": 8}, "codex": {"min_message_chars": 12}}


def thresholds(name: str, public: Column, harness: Column, *, general: dict | None = None, personal: dict | None = None, by_harness: dict | None = None) -> Column:
    """A setting of a session: the source's own, else that of personal sources (unless public), else the general one. Nulls do not override."""
    general, personal, by_harness = general or DEFAULTS, PERSONAL if personal is None else personal, BY_HARNESS if by_harness is None else by_harness
    own = personal.get(name)
    out = F.lit(general[name]) if own is None else F.when(public, F.lit(general[name])).otherwise(F.lit(own))
    special = {h: v[name] for h, v in by_harness.items() if v and v.get(name) is not None}
    for h, v in special.items():
        out = F.when(F.lower(harness) == h, F.lit(v)).otherwise(out)
    return out


def is_public(source: Column, data_source: Column) -> Column:
    return F.coalesce(source.isin("public", "github_public") | F.coalesce(data_source == "public", F.lit(False)), F.lit(False))


def public_defaults(first: Column) -> Column:
    """Label, exec, verify, data_source, public_dataset of a session's first row; personal ones have no source of data."""
    source = first["source"]
    own = lambda f, d: F.when(source == "public", F.coalesce(F.nullif(first[f], F.lit("")), F.lit(d))).otherwise(F.lit(d))
    listed = source.isin("public", "github_public")
    return F.struct(own("label", "accepted").alias("label"), own("exec", "unknown").alias("exec"), own("verify", "unknown").alias("verify"), F.when(listed, "public").alias("data_source"), F.when(source == "public", first["dataset_id"]).when(source == "github_public", "github_public").alias("public_dataset"))


SESSION = ["_source_file", "harness_", "session_"]
FIRST = ("source", "harness", "source_path", "dataset_id", "data_source", "label", "exec", "verify", "session_id")


def curate(turns: DataFrame, *, failures: DataFrame | None = None, filter_secrets: bool = True, bootstrap: bool = True, personal_data: bool = False, policy: safety.Policy = safety.Policy(), skip: tuple[str, ...] = ("developer", "system"), settings: dict | None = None, own_project: tuple = (None, ())) -> DataFrame:
    """Raw turns (what read_turns gives) to curated examples: messages and meta, one row a kept window.

    Sessions are (file, source, session id), so those that two files share are not merged; index rows are dropped; a
    session's first row names its source and thresholds. All tiers come out; the caller writes the one it wants, and
    tier_counts says how many there are of each."""
    settings = settings or {}
    col = lambda c, kind="string": F.col(c) if c in turns.columns else F.lit(None).cast(kind)
    rows = turns.select(*[col(c).alias(c) for c in (*FIRST, "role", "text", "_source_file")], col("line_no", "long").alias("line_no"), col("_line_no", "long").alias("_line_no"), F.coalesce(col("stack_index", "boolean"), F.lit(False)).alias("stack_"))
    rows = rows.where("not stack_").drop("stack_").withColumn("harness_", F.coalesce(F.nullif("harness", F.lit("")), "source", F.lit("unknown"))).withColumn("session_", F.coalesce(F.nullif("session_id", F.lit("")), F.lit("unknown")))
    if failures is not None:
        rows = clean_sessions(rows, failures, SESSION)
    # a session's first row, in the order of the file, decides; a small row a session, found with partial aggregates
    first = rows.groupBy(*SESSION).agg(F.min_by(F.struct(*FIRST), F.struct(F.coalesce("_line_no", F.lit(0)))).alias("first"))
    kept = with_session(dedup_turns(rows, SESSION, ["_line_no"]), first, SESSION)
    public = is_public(F.col("first.source"), F.col("first.data_source"))
    limit = lambda name: thresholds(name, public, F.col("first.harness"), **settings)
    kept = filter_turns(kept, least=limit("min_message_chars"), cap=limit("max_chars_per_message"), skip=skip)
    kept = kept.withColumns({"p_": F.coalesce("source_path", F.lit("")), "l_": F.coalesce("line_no", F.lit(0))})
    cut = windows_of_turns(kept, SESSION, ["p_", "l_", "_line_no"], most=limit("max_messages"), overlap=limit("overlap"), least=limit("min_messages"), chars=limit("min_total_chars"))
    cut = with_session(cut, first, SESSION)
    return finalize(cut, filter_secrets=filter_secrets, bootstrap=bootstrap, personal_data=personal_data, policy=policy, own_project=own_project)


def finalize(cut: DataFrame, *, filter_secrets: bool = True, bootstrap: bool = True, personal_data: bool = False, policy: safety.Policy = safety.Policy(), own_project: tuple = (None, ())) -> DataFrame:
    """A window's example with its meta: safety by F17, tier by C9, tags and tone of the joined text."""
    first = F.col("first")
    body = F.array_join(F.transform("messages", lambda m: m.content), "\n\n")
    diff = safety.is_diff(first["harness"], first["source"], first["source_path"], policy)
    out = safety.once(cut, "rated", window_findings(body, diff, policy=policy, personal=personal_data, enabled=filter_secrets)).withColumn("pub", public_defaults(first))
    ok = ~safety.should_quarantine(safety.blocks(F.col("rated")), safety.warns(F.col("rated")), policy.quarantine)
    plain = F.array_join(F.transform("messages", lambda m: m.content), "\n")
    meta = F.struct(
        F.col("pub.label").alias("label"), F.col("pub.exec").alias("exec"), F.col("pub.verify").alias("verify"), project(first["source_path"], first["dataset_id"], *own_project).alias("project"), F.coalesce(F.nullif(first["harness"], F.lit("")), first["source"]).alias("harness"),
        first["session_id"].alias("session_id"), "chunk_index", "chunk_count", first["source_path"].alias("source_path"), F.struct(ok.alias("ok"), F.transform("rated", lambda f: f.dropFields("match")).alias("findings")).alias("safety"), ok.alias("safety_ok"),
        F.transform("rated", lambda f: f["severity"]).alias("safety_severities"), tier(ok, F.col("pub.label"), F.col("pub.exec"), F.col("pub.verify"), bootstrap).alias("train_tier"), style_tags(plain).alias("style_tags"), tone(plain).alias("tone"),
        F.col("pub.data_source").alias("data_source"), F.col("pub.public_dataset").alias("public_dataset"),
    )
    return out.select(F.col("_source_file").alias("source_file"), "messages", meta.alias("meta"))


def tier_counts(examples: DataFrame) -> DataFrame:
    """C11: examples of every tier, whichever is written."""
    return examples.groupBy(F.col("meta.train_tier").alias("train_tier")).agg(F.count("*").alias("n"))


def link_commits(examples: DataFrame, commits: DataFrame, *, last: int = 5, mark_exec: bool = False, pattern: str | None = None) -> DataFrame:
    """The ids of the newest commits of an example's repository (from its path), oldest first. Only `last` commits a
    repository are gathered. The tier is not computed again, also where exec is set."""
    w = Window.partitionBy("repo").orderBy(F.col("committed_at").desc_nulls_last(), F.col("session_id").desc())
    top = commits.where("repo != ''").withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= last)
    ids = top.groupBy("repo").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("nth")).alias("k"), "session_id"))), lambda x: x.session_id).alias("linked_"))
    repo = repo_of_path(F.replace(F.col("meta.source_path"), F.lit("\\"), F.lit("/")), *([pattern] if pattern else []))
    out = examples.withColumn("repo_", repo).join(ids, F.col("repo_") == ids.repo, "left")
    linked = F.col("linked_").isNotNull()
    named = F.when(F.col("meta.project") != "", F.col("meta.project")).otherwise(F.coalesce(F.element_at(F.split("repo_", "/"), -1), F.lit("")))
    meta = F.col("meta").withField("linked_commits", F.col("linked_")).withField("project", named)
    if mark_exec:
        unknown = linked & (F.col("meta.exec") == "unknown")
        meta = meta.withField("exec", F.when(unknown, "pass").otherwise(F.col("meta.exec"))).withField("verify", F.when(unknown, "git_linked").otherwise(F.col("meta.verify")))
    return out.withColumn("meta", meta).select(*examples.columns)


def personal_export(examples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C14: the personal rows of tier 1 and up, redacted, with their source (to be written partitioned by it), and the counts a source."""
    from ..functions.text import redact

    mine = examples.where((F.col("meta.train_tier") >= 1) & ~F.coalesce(F.col("meta.data_source") == "public", F.lit(False)) & ~F.coalesce(F.col("meta.harness").startswith("public_"), F.lit(False)))
    safe = mine.withColumn("messages", F.transform("messages", lambda m: F.struct(m.role.alias("role"), redact(m.content).alias("content")))).withColumn("harness", F.coalesce("meta.harness", F.lit("unknown")))
    return safe, safe.groupBy("harness").agg(F.count("*").alias("rows")).orderBy("harness")


def lake_stats(turns: DataFrame, most: tuple[int, int] = (30, 10)) -> DataFrame:
    """Rows in all, by source of the log (top 30), by source (top 10) and by file, from one pass of grouping sets."""
    name = F.coalesce(F.nullif("harness", F.lit("")), "source", F.lit("unknown"))
    t = turns.select(name.alias("harness"), F.coalesce("source", F.lit("unknown")).alias("source"), F.col("_source_file").alias("file"))
    g = t.groupingSets([[], [t.harness], [t.source], [t.file]], t.harness, t.source, t.file).agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    kind = F.when(F.col("g") == 7, "total").when(F.col("g") == 3, "harness").when(F.col("g") == 5, "source").otherwise("file")
    rows = g.select(kind.alias("kind"), F.coalesce("harness", "source", "file", F.lit("*")).alias("name"), "n")
    nth = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "name"))
    return rows.withColumn("nth", nth).where(F.expr(f"kind in ('total', 'file') or (kind = 'harness' and nth <= {most[0]}) or (kind = 'source' and nth <= {most[1]})")).drop("nth")
