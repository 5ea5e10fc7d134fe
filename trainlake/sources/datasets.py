"""Loaders of public conversation datasets: rows of any schema become public turns.

A row is looked at as one VARIANT (its columns as JSON), so a column may hold text in one dataset and a nested list in
another. `index` is the row's place in its source; max_rows keeps the first accepted rows in that order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import variant as J
from ..functions.safety import once
from ..functions.variant import row as V
from ..operators.numbering import in_given_order, numbered
from .jsonl import parquet_rows, read_strict

LOADERS: dict[str, Callable[..., DataFrame]] = {}

# Keys that hold the sides of an instruction pair, first non-blank one wins.
USER_KEYS = ("instruction", "prompt", "input", "question", "problem", "query")
ASSISTANT_KEYS = ("response", "output", "answer", "solution", "completion", "code")
THINKING_KEYS = ("thinking", "reasoning", "chain_of_thought", "cot")
# Columns and words that mark a row of a mixed dataset as being about code.
CODE_COLUMNS = ("domain", "category", "task", "task_type", "source", "tags", "type", "skill")
CODE_WORDS = ("code", "coding", "program", "debug", "software", "swe", "agent", "tool", "python", "rust", "typescript", "javascript", "go", "java")
# Turns of recorded chats that are no conversation.
NO_CHAT = ("assistant_thinking", "progress", "system_event", "file_snapshot")
# Parts of two datasets.
NEMOTRON_SPLITS = ("general", "bash_only_tool", "bash_only_tool_skills", "question_tool", "agent_skills", "agent_skills_question_tool")
COOPER_FILES = ("agent1_traj.json", "agent2_traj.json")
TOOL_ARGUMENTS = 480


def loader(name: str):
    def put(f):
        LOADERS[name] = f
        return f

    return put


def indexed(rows: DataFrame) -> DataFrame:
    """v (the row as VARIANT) and index (its place in the source, from 0).

    Rows of Parquet shards carry their shard and place in it, so a count of each shard is all that is needed; other rows
    are written once with their places."""
    if rows.columns == ["index", "v"]:
        return rows
    v = F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("_shard", "_row")])))
    if not {"_shard", "_row"} <= set(rows.columns):
        return in_given_order(rows.select(v.alias("v")), "index").select("index", "v")
    last = rows.groupBy("_shard").agg(F.max("_row").alias("last_"))  # a row for each file
    before = F.coalesce(F.sum(F.col("last_") + 1).over(Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(last.select("_shard", before.alias("before_")))
    return rows.select("_shard", "_row", v.alias("v")).join(starts, "_shard").select((F.col("before_") + F.col("_row")).alias("index"), "v")


def first_rows(rows: DataFrame, max_rows: int | None) -> DataFrame:
    return rows if max_rows is None else rows.orderBy("index").limit(max_rows)


def record(rows: DataFrame, dataset: str, verify: str, *, session: Column, line: Column, role: Column, text: Column, tool_to_user: bool | Column = False, extra: dict[str, Column] | None = None) -> DataFrame:
    """Public turns."""
    pairs = [x for k, c in (extra or {}).items() for x in (F.lit(k), c.cast("string"))]
    more = F.map_filter(F.create_map(*pairs), lambda _, x: x.isNotNull()) if pairs else F.expr("cast(map() as map<string,string>)")
    return rows.select(
        F.lit("public").alias("source"), F.lit(f"public_{dataset}").alias("harness"), F.lit(dataset).alias("dataset_id"), session.cast("string").alias("session_id"), F.lit(f"hf://{dataset}").alias("source_path"),
        line.cast("long").alias("line_no"), role.alias("role"), text.alias("text"), F.lit("accepted").alias("label"), F.lit("pass").alias("exec"), F.lit(verify).alias("verify"),
        (F.lit(tool_to_user) if isinstance(tool_to_user, bool) else tool_to_user).alias("map_tool_to_user"), more.alias("extra"), "index",
    )


def spoken(messages: Column) -> Column:
    """The messages that become turns, as (role, content). System and empty messages go, and so do tool messages: the
    test of the role comes after their mapping and looks at the role that they came with."""
    def of(m: Column) -> Column:
        body = F.when(J.truthy(m, "$.content"), J.any_at(m, "$.content")).otherwise(J.any_at(m, "$.text"))
        return F.struct(F.lower(J.scalar_at(m, "$.role")).alias("role"), J.dataset_text(body).alias("content"))

    kept = F.transform(F.filter(messages, J.is_dict), of)
    return F.filter(kept, lambda m: m.role.isin("user", "assistant") & (m.content != ""))


def conversation(rows: DataFrame, dataset: str, verify: str, session: Column, *, turns: Column, tool_to_user: bool | Column = True, extra: dict[str, Column] | None = None) -> DataFrame:
    """Turns of each row's messages; line numbers count emitted ones only."""
    out = rows.withColumn("session_", session).select("*", F.posexplode(turns).alias("nth_", "m_"))
    return record(out, dataset, verify, session=F.col("session_"), line=F.col("nth_") + 1, role=F.col("m_.role"), text=F.col("m_.content"), tool_to_user=tool_to_user, extra=extra)


def pair(rows: DataFrame, dataset: str, verify: str, session: Column, user: Column, assistant: Column, *, extra: dict[str, Column] | None = None) -> DataFrame:
    turns = F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), assistant.alias("content")))
    return conversation(rows, dataset, verify, session, turns=turns, tool_to_user=False, extra=extra)


def named(dataset: str, *paths: str) -> Column:
    """The first of these that is not empty, else the dataset's name and the row's number."""
    return J.first_of(*[J.scalar_at(V(), p) for p in paths], F.concat(F.lit(f"{dataset}-"), F.col("index").cast("string")))


def looks_like_code(v: Column | None = None) -> Column:
    """True also where none of the columns says anything."""
    v = V() if v is None else v
    blob = F.lower(F.concat_ws(" ", *[F.coalesce(J.scalar_at(v, f"$.{c}"), F.lit("")) for c in CODE_COLUMNS]))
    return (J.strip(blob) == "") | blob.rlike("|".join(CODE_WORDS))


def instruction_pairs(rows: DataFrame, dataset: str, verify: str, *, max_rows: int | None = None, user_keys=USER_KEYS, assistant_keys=ASSISTANT_KEYS, thinking_keys=THINKING_KEYS, where: Column | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """Pairs from the first non-blank key of each list; rows without both sides by their messages, if they have some."""
    rows = indexed(rows)
    if where is not None:
        rows = rows.where(where)
    user, answer, thought = J.first_text(V(), *user_keys), J.first_text(V(), *assistant_keys), J.first_text(V(), *thinking_keys)
    rows = once(rows, "p_", F.struct(user.alias("user"), answer.alias("answer"), thought.alias("thought"), J.messages_at(V(), "messages", "conversations").alias("messages")))
    said = F.col("p_.answer")
    full = F.when((F.col("p_.thought") != "") & (said != ""), F.concat(F.lit("[thinking]\n"), F.col("p_.thought"), F.lit("\n\n"), said)).otherwise(said)
    rows = rows.select("index", "v", F.col("p_.user").alias("user_"), full.alias("answer_"), F.col("p_.messages").alias("messages_"))
    both = (F.col("user_") != "") & (F.col("answer_") != "")
    rows = first_rows(rows.where(both | (F.coalesce(F.size("messages_"), F.lit(0)) > 0)), max_rows)
    pairs = pair(rows.where(both), dataset, verify, named(dataset, "$.id", "$.sample_id", "$.fingerprint"), F.col("user_"), F.col("answer_"), extra=extra)
    talks = conversation(rows.where(~both), dataset, verify, named(dataset, "$.id", "$.session_id", "$.trajectory_id", "$.instance_id"), turns=spoken(F.col("messages_")), extra=extra)
    return pairs.unionByName(talks)


def _talks(rows: DataFrame, dataset: str, verify: str, session: Callable[[], Column], *, messages: Column, where: Column | None = None, max_rows: int | None = None, tool_to_user: bool | Column = True, extra: dict[str, Column] | None = None) -> DataFrame:
    rows = indexed(rows)
    if where is not None:
        rows = rows.where(where)
    rows = rows.withColumn("messages_", messages).where(F.coalesce(F.size("messages_"), F.lit(0)) >= 2)
    return conversation(first_rows(rows, max_rows), dataset, verify, session(), turns=spoken(F.col("messages_")), tool_to_user=tool_to_user, extra=extra)


@loader("swe_next")
def swe_next(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """P2."""
    return _talks(rows, "swe_next", "swe_next_verified", lambda: J.first_of(J.scalar_at(V(), "$.id"), J.scalar_at(V(), "$.instance_id"), F.concat(F.lit("swe-next-"), F.col("index"))), messages=J.list_at(V(), "$.messages"), max_rows=max_rows)


@loader("swe_chat")
def swe_chat(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Turn rows; runs of equal session ids that follow each other are sessions, ordered by turn number. max_rows counts turns, and so may cut the last session.

    The start of a run is where the id before it differs; runs are told apart by the place of their start, found in
    each session's own rows: a row starts a run if the accepted row before it (in all rows) is another session's."""
    rows = indexed(rows)
    role, kind = F.lower(J.scalar_at(V(), "$.role")), F.lower(J.scalar_at(V(), "$.turn_type"))
    content = J.strip(J.scalar_at(V(), "$.content"))
    prefix = F.when(role == "tool_use", F.concat(F.lit("[tool:"), J.first_of(J.scalar_at(V(), "$.tool_name"), F.lit("call")), F.lit("]\n"))).when(role == "tool_result", "[tool_result]\n").otherwise("")
    out = F.when(role.isin("tool_use", "tool_result"), "user").when(role.isin("user", "assistant"), role)
    sid = J.first_of(J.scalar_at(V(), "$.session_id"), F.lit("unknown"))
    turns = rows.select("index", sid.alias("sid"), out.alias("role"), F.concat(prefix, content).alias("text"), F.coalesce(F.try_variant_get(V(), "$.turn_number", "long"), F.lit(0)).alias("turn"), kind.alias("kind"), content.alias("content"))
    turns = turns.where((F.col("content") != "") & F.col("role").isNotNull() & ~F.coalesce(F.col("kind").isin(*NO_CHAT), F.lit(False)))
    turns = first_rows(turns, max_rows)
    # consecutive numbers of the accepted rows, without one task for all: equal (place - place within the session) means one run
    placed = numbered(turns, "index", name="place")
    own = Window.partitionBy("sid").orderBy("place")
    run = placed.withColumn("run", F.col("place") - F.row_number().over(own))
    line = F.row_number().over(Window.partitionBy("sid", "run").orderBy("turn", "place"))
    return record(run.withColumn("line", line), "swe_chat", "swe_chat_wild", session=F.col("sid"), line=F.col("line"), role=F.col("role"), text=F.col("text"), extra={"public_release": F.lit("2026-04")})


def with_tool_calls(m: Column) -> Column:
    """A message as (role, content); an assistant's tool calls follow its text."""
    def call(c: Column) -> Column:
        args = F.coalesce(J.scalar_at(c, "$.function.arguments"), F.lit(""))
        short = F.when(F.length(args) > TOOL_ARGUMENTS, F.concat(F.left(args, F.lit(TOOL_ARGUMENTS - 3)), F.lit("…"))).otherwise(args)
        return F.concat(F.lit("[tool "), J.first_of(J.scalar_at(c, "$.function.name"), F.lit("tool")), F.lit("] "), short)

    role, text = F.lower(J.scalar_at(m, "$.role")), J.dataset_text(m, "$.content")
    calls = J.list_at(m, "$.tool_calls")
    more = F.array_join(F.transform(F.filter(calls, J.is_dict), call), "\n")
    full = J.strip(F.concat_ws("\n", F.nullif(text, F.lit("")), F.nullif(more, F.lit(""))))
    return F.struct(role.alias("role"), F.when((role == "assistant") & (F.size(calls) > 0), full).otherwise(text).alias("content"))


@loader("swe_zero_12m")
def swe_zero_12m(rows: DataFrame, max_rows: int | None = None, exit_status: str | None = "Submitted") -> DataFrame:
    """P5."""
    status = J.scalar_at(V(), "$.exit_status")
    session = lambda: F.concat(J.first_of(J.scalar_at(V(), "$.instance_id"), F.concat(F.lit("swe-zero-12m-"), F.col("index"))), F.lit("-"), F.col("index"))
    extra = {k: J.scalar_at(V(), f"$.{k}") for k in ("repo", "exit_status", "trajectory_format", "duration_sec")}
    return _talks(rows, "swe_zero_12m", "swe_zero_trajectory", session, messages=J.list_at(V(), "$.messages"), where=None if exit_status is None else status == exit_status, max_rows=max_rows, extra=extra)


@loader("swe_zero_openhands")
def swe_zero_openhands(rows: DataFrame, max_rows: int | None = None, require_patch: bool = True) -> DataFrame:
    """Trajectories of at least two steps, two of them with a text; with a patch, if required."""
    patch = F.coalesce(J.strip(J.scalar_at(V(), "$.model_patch")), F.lit(""))
    rows = indexed(rows).where(F.coalesce(F.size(J.list_at(V(), "$.trajectory")) >= 2, F.lit(False)))
    if require_patch:
        rows = rows.where(patch != "")
    turns = F.filter(F.transform(F.filter(J.list_at(V(), "$.trajectory"), J.is_dict), with_tool_calls), lambda m: m.content != "")
    rows = first_rows(rows.withColumn("turns_", turns).where(F.size("turns_") >= 2), max_rows)
    extra = {"repo": J.scalar_at(V(), "$.repo"), "instance_id": J.scalar_at(V(), "$.instance_id"), "source_dataset": J.scalar_at(V(), "$.dataset"), "license": J.scalar_at(V(), "$.license"), "has_patch": patch != ""}
    session = J.first_of(J.scalar_at(V(), "$.trajectory_id"), J.scalar_at(V(), "$.instance_id"), F.concat(F.lit("swe-zero-oh-"), F.col("index")))
    return conversation(rows, "swe_zero_openhands", "swe_zero_openhands", session, turns=F.filter("turns_", lambda m: m.role.isin("user", "assistant")), extra=extra)


def _two_sides(rows: DataFrame, dataset: str, verify: str, user: str, assistant: str, session: Column, extra: tuple[str, ...], max_rows: int | None) -> DataFrame:
    one, two = J.strip(J.scalar_at(V(), f"$.{user}")), J.strip(J.scalar_at(V(), f"$.{assistant}"))
    rows = first_rows(indexed(rows).where((one != "") & (two != "")), max_rows)
    return pair(rows, dataset, verify, session, one, two, extra={k: J.scalar_at(V(), f"$.{k}") for k in extra})


@loader("opencode_refined")
def opencode_refined(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """P7."""
    return _two_sides(rows, "opencode_refined", "unit_tests", "input", "output", named("opencode_refined", "$.id"), ("average_test_score", "domain"), max_rows)


@loader("zen_agentic")
def zen_agentic(rows: DataFrame | None = None, max_rows: int | None = None) -> DataFrame:
    """Nothing of this dataset can be read."""
    raise NotImplementedError("zen_agentic has no public files")


@loader("agentic_sft_new")
def agentic_sft_new(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """P9."""
    return instruction_pairs(rows, "agentic_sft_new", "agentic_sft", max_rows=max_rows)


@loader("agentic_cot_coding")
def agentic_cot_coding(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """P9 with its own keys."""
    return instruction_pairs(rows, "agentic_cot_coding", "agentic_cot", max_rows=max_rows, user_keys=("user", "instruction", "prompt", "input", "question"), assistant_keys=("assistant", "response", "output", "answer", "solution"))


@loader("ling_coder_sft")
def ling_coder_sft(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """P10: messages as a list or as a JSON string of one."""
    session = lambda: J.first_of(J.scalar_at(V(), "$.mid"), F.concat(F.lit("ling-coder-"), F.col("index")))
    return _talks(rows, "ling_coder_sft", "ling_coder_sft", session, messages=J.messages_at(V(), "messages"), max_rows=max_rows, extra={"languages": J.scalar_at(V(), "$.languages"), "tags": J.scalar_at(V(), "$.tags")})


@loader("nemotron_swe_v2")
def nemotron_swe_v2(splits: dict[str, DataFrame], max_rows: int | None = None) -> DataFrame:
    """Parts one after the other; one of them cannot be read and is passed over. max_rows holds for all together."""
    parts = []
    for name, rows in splits.items():
        if name == "openhands_swe":
            continue
        session = lambda n=name: J.first_of(J.scalar_at(V(), "$.uuid"), F.concat(F.lit(f"nemotron-swe-v2-{n}-"), F.col("index")))
        parts.append(_talks(rows, "nemotron_swe_v2", "nemotron_swe_v2", session, messages=J.messages_at(V(), "messages"), max_rows=max_rows, extra={"hf_split": F.lit(name)}))
    return _in_turn(parts, max_rows)


def _in_turn(parts: list[DataFrame], max_rows: int | None) -> DataFrame:
    """Parts together; of source rows (part, index) only the first max_rows stay."""
    out = reduce(DataFrame.unionByName, [p.withColumn("part_", F.lit(i)) for i, p in enumerate(parts)])
    if max_rows is not None:
        first = out.select("part_", "index").distinct().orderBy("part_", "index").limit(max_rows)
        out = out.join(first, ["part_", "index"], "left_semi")
    return out.drop("part_")


@loader("cooper_qwen9b_coop_claude")
def cooper(rows: DataFrame, max_rows: int | None = None, *, folder: str, files: tuple[str, ...] = COOPER_FILES) -> DataFrame:
    """Each index row names a folder with a trajectory file for each agent; missing files are passed over. max_rows counts pairs."""
    spark = rows.sparkSession
    base = indexed(rows).withColumn("dir_", F.regexp_replace(J.strip(J.scalar_at(V(), "$.log_dir")), "^/+", "")).where("dir_ != ''")
    base = base.withColumn("dir_", F.when(F.col("dir_").startswith("coop/"), F.col("dir_")).otherwise(F.concat(F.lit("coop/"), F.col("dir_"))))
    wanted = base.select("index", F.col("v").alias("row_"), F.explode(F.array(*[F.struct(F.lit(i).alias("nth"), F.concat("dir_", F.lit("/" + f)).alias("path"), F.lit(f).alias("file")) for i, f in enumerate(files)])).alias("w_"))
    files_below = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    found = files_below.select(F.col("_metadata.file_path").alias("source_path"), F.try_parse_json("value").alias("v")).where("v is not null").withColumn("path_", F.regexp_extract("source_path", r"/(coop/.*)$", 1))
    both = wanted.select("index", "row_", "w_.*").join(found, F.col("path") == F.col("path_"))
    turns = J.list_at(V(), "$.messages")
    both = both.where(F.coalesce(F.size(turns) >= 2, F.lit(False)))
    if max_rows is not None:
        first = both.select("index").distinct().orderBy("index").limit(max_rows)
        both = both.join(first, "index", "left_semi")
    r = F.col("row_")
    agent = J.first_of(J.scalar_at(V(), "$.agent_id"), F.replace(F.col("file"), F.lit("_traj.json"), F.lit("")))
    name = F.concat_ws("-", J.first_of(J.scalar_at(r, "$.repo"), F.lit("repo")), F.coalesce(J.scalar_at(r, "$.task_id"), F.lit("None")), F.coalesce(J.scalar_at(r, "$.features"), F.lit("")), agent)
    extra = {"cooper_setting": J.scalar_at(r, "$.setting"), "cooper_model": J.scalar_at(r, "$.model"), **{k: J.scalar_at(r, f"$.{k}") for k in ("both_passed", "pair_tokens", "task_id", "features")}, "task_repo": J.scalar_at(r, "$.repo"), "agent_id": agent, "agent_status": J.scalar_at(V(), "$.status"), "hf_traj_path": F.col("source_path")}
    return conversation(both, "cooper_qwen9b_coop_claude", "cooperbench_coop", name, turns=spoken(turns), extra=extra)


@loader("scale_swe")
def scale_swe(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """P13."""
    return _two_sides(rows, "scale_swe", "swe_patch", "problem_statement", "patch", J.first_of(J.scalar_at(V(), "$.instance_id"), F.concat(F.lit("scale-swe-"), F.col("index"))), ("repo", "language", "github_url"), max_rows)


@loader("nemotron_opencode")
def nemotron_opencode(spark: SparkSession, folder: str, max_rows: int | None = None, splits: tuple[str, ...] = NEMOTRON_SPLITS) -> DataFrame:
    """Six JSONL parts, read strictly; tool messages count as mapped only where there are some."""
    parts = []
    for name in splits:
        rows = read_strict(spark, f"{folder}/{name}/data.jsonl").select((F.col("line_no") - 1).alias("index"), "v")
        messages = J.list_at(V(), "$.messages")
        tools = F.exists(messages, lambda m: F.coalesce(F.lower(J.scalar_at(m, "$.role")) == "tool", F.lit(False)))
        rows = first_rows(rows.where(F.coalesce(F.size(messages) >= 2, F.lit(False))), max_rows)
        session = J.first_of(J.scalar_at(V(), "$.uuid"), F.concat(F.lit(f"nemotron-opencode-{name}-"), F.col("index")))
        extra = {"hf_split": F.lit(name), **{k: J.scalar_at(V(), f"$.{k}") for k in ("question_category", "complexity_level", "enabled_tools")}}
        parts.append(conversation(rows, "nemotron_opencode", "nemotron_opencode", session, turns=spoken(messages), tool_to_user=tools, extra=extra))
    return _in_turn(parts, max_rows)


@loader("coderforge_preview")
def coderforge_preview(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Messages as a list or a JSON string; elements that are no objects do not count."""
    session = lambda: J.first_of(J.scalar_at(V(), "$.trajectory_id"), F.concat(F.lit("coderforge-"), F.col("index")))
    extra = {k: J.scalar_at(V(), f"$.{k}") for k in ("reward", "finish_reason", "license")}
    return _talks(rows, "coderforge_preview", "coderforge_trajectory", session, messages=F.filter(J.messages_at(V(), "messages"), J.is_dict), max_rows=max_rows, extra=extra)


def load_shards(spark: SparkSession, dataset: str, folder: str, **options) -> DataFrame:
    """K3: a whole dataset from its Parquet shards; Spark's own partitioning takes the place of shard workers."""
    return LOADERS[dataset](parquet_rows(spark, folder), **options).drop("index")
