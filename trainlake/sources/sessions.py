"""Readers of session logs: each yields turns (source, harness, session_id, source_path, line_no, role, text, extra).

A reader is a pure column expression over lines, whole files or SQLite rows; nothing is inferred from the data. Unless
said otherwise a turn needs a user or assistant role and a non-empty text. Texts of any length are read; every reader takes
`longest`: turns with more characters are then left out (by the readers that say so: cut).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable
from functools import reduce, wraps

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import variant as J
from ..functions.variant import row as V
from .jsonl import json_files, json_lines, whole_files
from .sqlite import read_sqlite

SPEAKERS = ("user", "assistant")
READERS: dict[str, Callable[..., DataFrame]] = {}


def reader(name: str):
    """Registers a reader under its source's name; one that does not cut long texts itself gets `longest` as a filter."""
    def put(f):
        if "longest" in inspect.signature(f).parameters:
            READERS[name] = f
            return f

        @wraps(f)
        def read(*args, longest: int | None = None, **settings) -> DataFrame:
            rows = f(*args, **settings)
            return rows if longest is None else rows.where(F.length("text") <= longest)

        READERS[name] = read
        return read

    return put


def clipped(text: Column, longest: int | None) -> Column:
    return text if longest is None else F.left(text, F.lit(longest))


def file_name() -> Column:
    return F.element_at(F.split("source_path", "/"), -1)


def stem() -> Column:
    return F.regexp_replace(file_name(), r"(?<=.)\.[^.]*$", "")


def folder() -> Column:
    return F.element_at(F.split("source_path", "/"), -2)


def emit(rows: DataFrame, name: str, session: Column, role: Column, text: Column, *, line: Column | None = None, roles: tuple[str, ...] = SPEAKERS, **extra: Column) -> DataFrame:
    no_extra = F.expr("cast(map() as map<string,string>)")
    more = F.map_filter(F.create_map(*[x for k, c in extra.items() for x in (F.lit(k), c.cast("string"))]), lambda _, x: x.isNotNull()) if extra else no_extra
    number = line if line is not None else (F.col("line_no") if "line_no" in rows.columns else F.lit(None))
    path = F.col("source_path") if "source_path" in rows.columns else F.lit(None).cast("string")
    out = rows.select(F.lit(name).alias("source"), F.lit(name).alias("harness"), session.cast("string").alias("session_id"), path.alias("source_path"), number.cast("long").alias("line_no"), role.alias("role"), text.alias("text"), more.alias("extra"))
    return out.where(F.col("role").isin(*roles) & (F.col("text") != ""))


def each(rows: DataFrame, items: Column) -> DataFrame:
    """A row for each object of a list, in order; nth counts from 1."""
    return rows.select(*[c for c in rows.columns if c != "v"], F.posexplode(items).alias("nth", "v")).withColumn("nth", F.col("nth") + 1).where(J.is_dict(V()))


def generic_role(v: Column, human: tuple[str, ...] = (), model: tuple[str, ...] = ()) -> Column:
    """role, else type; with other names of the two speakers."""
    raw = J.first_of(J.text_at(v, "$.role"), J.text_at(v, "$.type"))
    return F.when(raw.isin(*human, "user"), "user").when(raw.isin(*model, "assistant"), "assistant")


@reader("cursor")
def cursor(spark: SparkSession, path: str, *, subagents: bool = False) -> DataFrame:
    """Transcripts below agent-transcripts."""
    rows = json_lines(spark, path).where(F.col("source_path").contains("/agent-transcripts/"))
    if not subagents:
        rows = rows.where(~F.col("source_path").contains("/subagents/"))
    from_message = F.when(J.text_at(V(), "$.message").isNotNull(), J.spoken_content(V(), "$.message")).when(J.any_at(V(), "$.message.content").isNotNull(), J.spoken_content(V(), "$.message.content"))
    blocks = F.coalesce(J.list_at(V(), "$.message.content"), J.list_at(V(), "$.content"))
    return emit(rows, "cursor", stem(), J.speaker(V()), F.coalesce(from_message, J.spoken_content(V(), "$.content")), has_tool_use=J.has_tool(blocks))


@reader("codex")
def codex(spark: SparkSession, path: str, *, largest_mb: float | None = None) -> DataFrame:
    """R2: messages of rollout files (up to a size, if one is given); developer turns are kept here and dropped by the role map later."""
    rows = json_lines(spark, path).where(file_name().startswith("rollout-"))
    if largest_mb and not isinstance(path, DataFrame):
        large = spark.read.format("binaryFile").load(path).where(F.col("length") > largest_mb * 1024 * 1024).select(F.col("path").alias("source_path"))
        rows = rows.join(large, "source_path", "left_anti")
    rows = rows.where((J.text_at(V(), "$.type") == "response_item") & (J.text_at(V(), "$.payload.type") == "message"))
    text = J.joined(J.list_at(V(), "$.payload.content"), lambda b: J.unwrap_query(J.block_text(b, ("input_text", "output_text"))))
    return emit(rows, "codex", F.left(F.regexp_replace(stem(), "^rollout-", ""), F.lit(36)), J.text_at(V(), "$.payload.role"), text, roles=("user", "developer", "assistant"), record_type=J.text_at(V(), "$.type"))


@reader("claude_code")
def claude_code(spark: SparkSession, path: str) -> DataFrame:
    """No summaries, side chains or system lines; the parent folder is the project."""
    skipped = J.truthy(V(), "$.isCompactSummary") | J.truthy(V(), "$.isSidechain") | F.coalesce(F.lower(J.text_at(V(), "$.type")) == "system", F.lit(False))
    text = F.when(J.text_at(V(), "$.message").isNotNull(), J.spoken_content(V(), "$.message")).otherwise(J.spoken_content(V(), "$.message.content"))
    return emit(json_lines(spark, path).where(~skipped), "claude_code", stem(), J.speaker(V()), text, project_hash=folder())


@reader("pi")
def pi(spark: SparkSession, path: str) -> DataFrame:
    """Messages, and shown custom messages as the user's."""
    kind = J.text_at(V(), "$.type")
    hidden = J.any_at(V(), "$.display").isNotNull() & ~J.truthy(V(), "$.display")
    rows = json_lines(spark, path).where((kind == "message") | ((kind == "custom_message") & ~hidden))
    custom = kind == "custom_message"
    role = F.when(custom, "user").otherwise(J.text_at(V(), "$.message.role"))
    text = F.when(custom, F.coalesce(J.text_at(V(), "$.content"), J.content_text(V(), "$.content"))).otherwise(J.content_text(V(), "$.message.content"))
    return emit(rows, "pi", F.element_at(F.split(stem(), "_"), -1), role, text)


@reader("opencode")
def opencode(spark: SparkSession, path: str | None = None, *, databases: list[str] = ()) -> DataFrame:
    """The earliest text part of each message of the databases, and the older one-message files."""
    parts = []
    if databases:
        messages = read_sqlite(spark, list(databases), "SELECT id, session_id, data, time_created FROM message", "id string, session_id string, data string, at long", ("message", "part"))
        texts = read_sqlite(spark, list(databases), "SELECT message_id, data, time_created FROM part", "id string, part string, at long", ("message", "part")).withColumn("p", F.try_parse_json("part"))
        texts = texts.where(J.text_at(F.col("p"), "$.type") == "text").groupBy("source_path", "id").agg(F.min_by("p", "at").alias("p"))
        rows = messages.withColumn("v", F.try_parse_json("data")).join(texts, ["source_path", "id"], "left")
        parts.append(emit(rows.drop("source_path"), "opencode", F.col("session_id"), J.text_at(V(), "$.role"), J.strip(J.scalar_at(F.col("p"), "$.text")), message_id=F.col("id")))
    if path:
        has_info = J.dict_at(V(), "$.info").isNotNull()
        role = F.when(has_info, J.text_at(V(), "$.info.role")).otherwise(J.text_at(V(), "$.role"))
        blocks = F.coalesce(J.list_at(V(), "$.parts"), F.when(has_info, J.list_at(V(), "$.info.parts")).otherwise(J.list_at(V(), "$.content")))
        parts.append(emit(json_files(spark, path), "opencode", folder(), role, J.parts_text(V(), blocks)))
    return reduce(DataFrame.unionByName, parts)


@reader("t3code")
def t3code(spark: SparkSession, databases: list[str]) -> DataFrame:
    """Stored thread messages with a text."""
    rows = read_sqlite(spark, databases, "SELECT message_id, thread_id, turn_id, role, text, created_at FROM projection_thread_messages WHERE length(text) > 0", "message_id string, thread_id string, turn_id string, role string, body string, created_at string", ("projection_thread_messages",))
    return emit(rows.drop("source_path"), "t3code", F.col("thread_id"), F.col("role"), J.strip(F.col("body")), message_id=F.col("message_id"), turn_id=F.col("turn_id"), created_at=F.col("created_at"))


@reader("aider")
def aider(spark: SparkSession, path: str, *, tools: bool = False) -> DataFrame:
    """Markdown histories cut at level-four headings: those are the user's, quotes the tool's, longer other text the assistant's."""
    rows = whole_files(spark, path).select("source_path", F.posexplode(F.split("value", r"\n(?=#### )")).alias("nth", "part"))
    part = J.strip(F.col("part"))
    heading, quote = part.startswith("#### "), part.startswith(">")
    role = F.when(heading, "user").when(quote, "tool").when(F.length(part) > 20, "assistant")
    text = F.when(heading, J.strip(F.regexp_replace(part, r"^####\s+", ""))).when(quote, J.strip(F.regexp_replace(part, r"(?m)^>\s+", ""))).otherwise(part)
    return emit(rows, "aider", stem(), role, text, roles=SPEAKERS + (("tool",) if tools else ()))


# Which events of an editor task's list are the user's and which the assistant's.
USER_SAYS, ASSISTANT_SAYS = ("task", "user_feedback", "user_feedback_diff"), ("text", "reasoning", "completion_result")


def task_message(v: Column) -> Column:
    """Role and text of a message of a task's API history."""
    either = lambda b: F.when(J.text_at(b, "$.type") == "text", F.coalesce(J.scalar_at(b, "$.text"), F.lit(""))).otherwise(J.loose_text(b))
    return F.struct(J.text_at(v, "$.role").alias("role"), J.content_text(v, "$.content", either).alias("text"))


def task_event(v: Column) -> Column:
    """Role and text of one of the editor's events that is not partial."""
    role, kind, say = F.lower(J.text_at(v, "$.role")), F.lower(J.text_at(v, "$.type")), J.text_at(v, "$.say")
    speaker = F.when(role.isin(*SPEAKERS), role).when(kind.isin(*SPEAKERS), kind).when((kind == "say") & say.isin(*USER_SAYS), "user")
    speaker = speaker.when((kind == "say") & say.isin(*ASSISTANT_SAYS), "assistant").when((kind == "ask") & J.scalar_at(v, "$.ask").isNotNull(), "assistant")
    listed = F.coalesce(J.list_at(v, "$.text"), F.when(F.coalesce(J.scalar_at(v, "$.text"), F.lit("")) == "", J.list_at(v, "$.content")))
    body = F.when(listed.isNotNull(), F.array_join(F.transform(listed, J.any_string), "\n")).otherwise(J.first_of(J.scalar_at(v, "$.text"), J.scalar_at(v, "$.content")))
    text = F.concat_ws("\n", F.nullif(J.strip(body), F.lit("")), F.nullif(J.strip(J.text_at(v, "$.reasoning")), F.lit("")))
    return F.struct(F.when(~J.truthy(v, "$.partial"), speaker).alias("role"), J.strip(text).alias("text"))


def _tasks(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Both files of a task: the API history, and the editor's events."""
    files = json_files(spark, path)
    session = F.when(F.col("source_path").contains("/.cline/data/"), F.concat(F.lit("cli-"), folder())).otherwise(folder())
    parts = [("api_conversation_history.json", task_message), ("ui_messages.json", task_event)]
    rows = [each(files.where(file_name() == file), J.list_at(V(), "$")).withColumn("said", of(V())) for file, of in parts]
    return reduce(DataFrame.unionByName, [emit(x, name, session, F.col("said.role"), F.col("said.text")) for x in rows])


@reader("cline")
def cline(spark: SparkSession, path: str) -> DataFrame:
    return _tasks(spark, path, "cline")


@reader("roo_code")
def roo_code(spark: SparkSession, path: str) -> DataFrame:
    return _tasks(spark, path, "roo_code")


@reader("continue")
def continue_(spark: SparkSession, path: str) -> DataFrame:
    """The history of a session file; an item's message, or the item itself."""
    files = json_files(spark, path).where(file_name() != "sessions.json")
    rows = each(files.withColumn("session", J.first_of(J.scalar_at(V(), "$.sessionId"), stem())), J.list_at(V(), "$.history"))
    nested = J.dict_at(V(), "$.message").isNotNull()
    role = F.when(nested, J.text_at(V(), "$.message.role")).otherwise(J.text_at(V(), "$.role"))
    text = F.when(nested, J.content_text(V(), "$.message.content")).otherwise(J.content_text(V(), "$.content"))
    return emit(rows, "continue", F.col("session"), role, text)


@reader("gemini_cli")
def gemini_cli(spark: SparkSession, path: str) -> DataFrame:
    """Chats as one JSON file with messages, or as lines (each a message or a list of them)."""
    kind = J.text_at(V(), "$.type")
    role = F.when(kind == "user", "user").when(kind.isin("gemini", "assistant", "model"), "assistant")
    listed = F.coalesce(J.list_at(V(), "$.content"), F.when(~J.truthy(V(), "$.content"), J.list_at(V(), "$.text")))
    text = F.when(listed.isNotNull(), J.strip(F.array_join(F.transform(listed, J.any_string), "\n"))).otherwise(J.strip(J.first_of(J.scalar_at(V(), "$.content"), J.scalar_at(V(), "$.text"))))
    chats = F.col("source_path").rlike(r"/chats/session-[^/]*\.jsonl?$")
    lines = json_lines(spark, path).where(chats & F.col("source_path").endswith(".jsonl"))
    whole = json_files(spark, path).where(chats & F.col("source_path").endswith(".json")).withColumn("line_no", F.lit(None).cast("long"))
    many = J.list_at(V(), "$.messages").isNotNull()
    inner = each(lines.where(many).unionByName(whole), J.list_at(V(), "$.messages")).drop("nth")
    single = lines.where(~many & J.any_at(V(), "$['$set']").isNull())
    return emit(inner.unionByName(single), "gemini_cli", stem(), role, text, line=F.lit(None))


@reader("copilot")
def copilot(spark: SparkSession, path: str) -> DataFrame:
    """Lasting user and assistant events; the folder is the session."""
    rows = json_lines(spark, path).where((file_name() == "events.jsonl") & ~J.truthy(V(), "$.ephemeral"))
    kind = J.text_at(V(), "$.type")
    role = F.when(kind == "user.message", "user").when(kind == "assistant.message", "assistant")
    return emit(rows, "copilot", folder(), role, J.strip(J.text_at(V(), "$.data.content")), event_type=kind)


@reader("amp")
def amp(spark: SparkSession, path: str) -> DataFrame:
    """Messages of a thread file."""
    rows = each(json_files(spark, path).withColumn("session", J.first_of(J.scalar_at(V(), "$.id"), stem())), J.list_at(V(), "$.messages"))
    other = J.text_at(V(), "$.content").isNull() & J.list_at(V(), "$.content").isNull()
    text = F.when(other, J.strip(J.text_at(V(), "$.text"))).otherwise(J.content_text(V(), "$.content", J.loose_text))
    return emit(rows, "amp", F.col("session"), J.text_at(V(), "$.role"), text)


@reader("factory")
def factory(spark: SparkSession, path: str) -> DataFrame:
    """A line is a message or holds a list of them (these have no length limit)."""
    rows = json_lines(spark, path)
    listed = F.coalesce(J.list_at(V(), "$.content"), F.when(~J.truthy(V(), "$.content"), J.list_at(V(), "$.text")))
    text = F.when(listed.isNotNull(), J.strip(F.array_join(F.transform(listed, J.any_string), "\n"))).otherwise(J.strip(J.first_of(J.scalar_at(V(), "$.content"), J.scalar_at(V(), "$.text"))))
    role = generic_role(V(), ("human", "Human"))
    many = J.any_at(V(), "$.messages").isNotNull()
    return emit(rows.where(~many), "factory", stem(), role, text).unionByName(emit(each(rows.where(many), J.list_at(V(), "$.messages")), "factory", stem(), role, text))


@reader("openhands")
def openhands(spark: SparkSession, path: str) -> DataFrame:
    """One event a file below <session>/events; the files' names order them as text."""
    rows = json_files(spark, path).where(F.col("source_path").rlike(r"/events/[^/]*\.json$"))
    source, own = J.text_at(V(), "$.source"), J.dict_at(V(), "$.llm_message").isNotNull()
    said = F.when(source == "user", "user").when(source.isin("agent", "assistant"), "assistant")
    spoken = J.text_at(V(), "$.kind").isin("MessageEvent", "message") | (own & source.isin("user", "agent", "assistant"))
    spoken = F.coalesce(spoken, F.lit(False))
    acted = F.coalesce((J.text_at(V(), "$.action") == "message") | source.isin("user", "agent", "assistant"), F.lit(False))
    loose = lambda b: F.coalesce(J.text_at(b, "$"), J.loose_text(b))
    llm = J.content_text(V(), "$.llm_message.content", loose)
    args = F.when(J.truthy(V(), "$.args"), J.any_at(V(), "$.args")).otherwise(J.any_at(V(), "$.message"))
    inner = J.first_of(J.scalar_at(args, "$.content"), J.scalar_at(args, "$.thought"), J.scalar_at(args, "$.message"))
    listed = J.list_at(args, "$.content")
    from_args = F.when(J.text_at(args, "$").isNotNull(), J.strip(J.text_at(args, "$"))).when(listed.isNotNull(), J.strip(F.array_join(F.transform(listed, J.any_string), "\n"))).otherwise(J.strip(inner))
    role = F.when(spoken, F.coalesce(said, J.text_at(V(), "$.llm_message.role"))).when(acted, said).otherwise(J.text_at(V(), "$.message.role"))
    text = F.when(spoken, llm).when(acted, from_args).otherwise(J.strip(J.text_at(V(), "$.message.content")))
    return emit(rows, "openhands", F.element_at(F.split("source_path", "/"), -3), role, text)


# Keys under which the editor's state holds its chats, first that has any wins.
CHAT_KEYS = ("workbench.panel.aichat.view.aichat.chatdata", "aiChat.chatdata", "chat.data", "cascade.chatdata")


@reader("windsurf")
def windsurf(spark: SparkSession, databases: list[str]) -> DataFrame:
    """Bubbles of the chat tabs of the first known key; every bubble that is not the user's is the assistant's."""
    keys = ", ".join(f"'{k}'" for k in CHAT_KEYS)
    rows = read_sqlite(spark, databases, f"SELECT key, CAST(value AS TEXT) FROM ItemTable WHERE key IN ({keys})", "key string, value string", ("ItemTable",))
    rows = rows.select("source_path", F.array_position(F.array(*map(F.lit, CHAT_KEYS)), F.col("key")).alias("place"), F.try_parse_json("value").alias("v"))
    tabs = each(rows, J.list_at(V(), "$.tabs")).drop("nth").withColumn("session", J.scalar_at(V(), "$.tabId"))
    text = J.strip(J.first_of(J.scalar_at(V(), "$.rawText"), J.scalar_at(V(), "$.text")))
    bubbles = each(tabs, J.list_at(V(), "$.bubbles")).where(text != "")
    first = bubbles.groupBy("source_path").agg(F.min("place").alias("place"))
    return emit(bubbles.join(first, ["source_path", "place"], "left_semi"), "windsurf", F.col("session"), F.when(J.text_at(V(), "$.type") == "user", "user").otherwise("assistant"), text, line=F.col("nth"))


@reader("kimi")
def kimi(spark: SparkSession, path: str) -> DataFrame:
    """Context.jsonl files; the folder is the session."""
    rows = json_lines(spark, path).where(file_name() == "context.jsonl")
    return emit(rows, "kimi", folder(), J.text_at(V(), "$.role"), J.content_text(V(), "$.content"))


@reader("goose")
def goose(spark: SparkSession, databases: list[str], *, longest: int | None = None) -> DataFrame:
    """Stored messages; a JSON object counts as its text. Texts are cut at `longest`, if given."""
    rows = read_sqlite(spark, databases, "SELECT session_id, role, content FROM messages ORDER BY timestamp", "session_id string, role string, content string", ("messages",))
    body = J.strip(F.col("content"))
    v = F.when(body.startswith("{"), F.try_parse_json(body))
    text = F.when(v.isNotNull(), J.first_of(J.scalar_at(v, "$.text"), J.scalar_at(v, "$.content"), F.to_json(v))).otherwise(body)
    return emit(rows.drop("source_path"), "goose", F.col("session_id"), F.col("role"), clipped(text, longest))


@reader("kiro")
def kiro(spark: SparkSession, path: str | None = None, *, databases: list[str] = ()) -> DataFrame:
    """JSON and JSONL sessions; then the first database that exists: its messages, or else its conversations."""
    def text_of(v: Column) -> Column:
        own = F.when(J.truthy(v, "$.content"), J.any_at(v, "$.content")).otherwise(J.any_at(v, "$.text"))
        return J.content_text(own, "$", J.text_or_content)

    parts = []
    if path:
        whole = json_files(spark, path).where(F.col("source_path").endswith(".json"))
        whole = whole.withColumn("session", J.first_of(J.scalar_at(V(), "$.id"), J.scalar_at(V(), "$.sessionId"), stem()))
        rows = each(whole, F.coalesce(F.when(J.truthy(V(), "$.messages"), J.list_at(V(), "$.messages")), J.list_at(V(), "$.history")))
        parts.append(emit(rows, "kiro", F.col("session"), J.text_at(V(), "$.role"), text_of(V()), line=F.col("nth")))
        parts.append(emit(json_lines(spark, path).where(F.col("source_path").endswith(".jsonl")), "kiro", stem(), J.text_at(V(), "$.role"), text_of(V())))
    for db in databases[:1]:
        rows = read_sqlite(spark, [db], "SELECT session_id, role, content FROM messages", "session_id string, role string, content string", ("messages",))
        body = J.strip(F.col("content"))
        v = F.when(body.startswith("{"), F.try_parse_json(body))
        parts.append(emit(rows.drop("source_path"), "kiro", F.col("session_id"), F.col("role"), F.when(J.is_dict(v), text_of(v)).otherwise(body)))
        blobs = read_sqlite(spark, [db], "SELECT id, CAST(data AS TEXT), (SELECT count(*) FROM sqlite_master WHERE type = 'table' AND name = 'messages') FROM conversations", "id string, data string, other long", ("conversations",))
        rows = each(blobs.where("other = 0").select("id", F.try_parse_json("data").alias("v")), J.list_at(V(), "$.messages"))
        parts.append(emit(rows, "kiro", F.col("id"), J.text_at(V(), "$.role"), text_of(V()), line=F.col("nth")))
    return reduce(DataFrame.unionByName, parts)


@reader("openclaw")
def openclaw(spark: SparkSession, path: str) -> DataFrame:
    """Messages and custom messages; the nested message or the line itself."""
    rows = json_lines(spark, path).where((file_name() != "sessions.jsonl") & J.text_at(V(), "$.type").isin("message", "custom_message"))
    own = F.when(J.truthy(V(), "$.message"), J.any_at(V(), "$.message")).otherwise(V())
    return emit(rows, "openclaw", stem(), J.text_at(own, "$.role"), J.content_text(own, "$.content", J.loose_text))


def _unpacked(kind: pd.Series, blob: pd.Series) -> pd.Series:
    """JSON texts of blobs that hold it as it is or packed; null for others."""
    import zstandard

    def one(k, b):
        try:
            raw = bytes(b)
            return (raw if k == "json" else zstandard.ZstdDecompressor().decompressobj().decompress(raw)).decode() if k in ("json", "zstd") else None
        except (zstandard.ZstdError, UnicodeDecodeError, TypeError):
            return None

    return pd.Series([one(k, b) for k, b in zip(kind, blob)], dtype=object)


@reader("zed_ai")
def zed_ai(spark: SparkSession, databases: list[str]) -> DataFrame:
    """Threads stored as JSON or as zstd-packed JSON; the first list among messages, entries, conversation."""
    unpack = F.pandas_udf(_unpacked, "string")
    rows = read_sqlite(spark, databases, "SELECT id, coalesce(data_type, 'zstd'), data FROM threads WHERE typeof(data) = 'blob'", "id string, kind string, data binary", ("threads",))
    rows = rows.select("id", F.try_parse_json(unpack("kind", "data")).alias("v")).where(J.is_dict(V()))
    rows = each(rows, F.coalesce(J.list_at(V(), "$.messages"), J.list_at(V(), "$.entries"), J.list_at(V(), "$.conversation")))
    own = F.when(J.truthy(V(), "$.content"), J.any_at(V(), "$.content")).otherwise(J.any_at(V(), "$.text"))
    return emit(rows, "zed_ai", F.col("id"), generic_role(V()), J.content_text(own, "$"))


@reader("watchfire")
def watchfire(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a role or type; content, message or text as a string or blocks."""
    own = F.coalesce(*[F.when(J.truthy(V(), p), J.any_at(V(), p)) for p in ("$.content", "$.message", "$.text")])
    return emit(json_lines(spark, path), "watchfire", stem(), generic_role(V(), ("human",)), J.content_text(own, "$", J.loose_text))


@reader("crush")
def crush(spark: SparkSession, databases: list[str], *, longest: int | None = None) -> DataFrame:
    """Stored messages; the message id is the session. Plain texts are cut at `longest`, if given, and longer joined ones left out."""
    rows = read_sqlite(spark, databases, "SELECT id, role, parts FROM messages", "id string, role string, parts string", ("messages",))
    v = F.try_parse_json("parts")
    part = lambda p: F.when(J.text_at(p, "$.type") == "text", F.coalesce(J.scalar_at(p, "$.data.text"), J.text_at(p, "$.data")))
    text = F.when(v.isNull(), clipped(J.strip(F.col("parts")), longest)).when(J.list_at(v, "$").isNotNull(), J.joined(J.list_at(v, "$"), part)).otherwise(clipped(J.scalar_at(v, "$"), longest))
    out = emit(rows, "crush", F.col("id"), F.col("role"), text, project=F.element_at(F.split("source_path", "/"), -3))
    return out if longest is None else out.where(F.length("text") <= longest)


def _cached_role() -> Column:
    return generic_role(V(), ("human", "Human"), ("model", "Model", "ai"))


def _cached_text() -> Column:
    own = F.coalesce(*[F.when(J.truthy(V(), p), J.any_at(V(), p)) for p in ("$.content", "$.text", "$.message")])
    nested = J.first_of(J.scalar_at(own, "$.text"), J.scalar_at(own, "$.content"))
    return F.when(J.is_dict(own), nested).otherwise(J.content_text(own, "$", J.text_or_content))


@reader("mux")
def mux(spark: SparkSession, path: str, *, usage: str | None = None, longest: int | None = None) -> DataFrame:
    """Transcript lines; where there are none, usage files as metadata rows, cut at `longest`, if given."""
    if usage is None:
        rows = emit(json_lines(spark, path), "mux", stem(), _cached_role(), _cached_text())
        return rows if longest is None else rows.where(F.length("text") <= longest)
    text = clipped(F.to_json(V()), longest)
    return emit(json_files(spark, usage), "mux", folder(), F.lit("metadata"), text, roles=("metadata",), note=F.lit("usage only"))


@reader("antigravity")
def antigravity(spark: SparkSession, path: str) -> DataFrame:
    """Cached lines."""
    return emit(json_lines(spark, path), "antigravity", stem(), _cached_role(), _cached_text())


@reader("trae")
def trae(spark: SparkSession, path: str) -> DataFrame:
    """Cached files: a list, or an object with messages or turns."""
    items = F.coalesce(J.list_at(V(), "$"), F.when(J.truthy(V(), "$.messages"), J.list_at(V(), "$.messages")), J.list_at(V(), "$.turns"))
    return emit(each(json_files(spark, path), items), "trae", stem(), _cached_role(), _cached_text(), line=F.col("nth"))


# Suffixes of code files whose changes are kept.
CODE_SUFFIXES = (".py", ".rs", ".ts", ".tsx", ".js", ".jsx", ".go", ".md")


def commits(changes: DataFrame, *, most: int = 500, author: str | None = None, files: int = 8, longest: int = 12_000) -> DataFrame:
    """Commit rows from changed files (repo, hash, parents, author_email, committed_at, message, path, change, diff).

    No merges; per repository the newest `most` commits (of one author, if given); added or modified code files with a
    change, at most `files` a commit in order of path, each diff cut at `longest`."""
    own = changes.where(F.col("parents") < 2)
    if author:
        own = own.where(F.col("author_email") == author)
    heads = own.select("repo", "hash", "committed_at").distinct()
    w = Window.partitionBy("repo").orderBy(F.col("committed_at").desc(), F.col("hash").desc())
    newest = heads.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= most).select("repo", "hash")
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    kept = own.where(F.col("change").isin("ADD", "MODIFY") & suffix.isin(*CODE_SUFFIXES)).withColumn("diff", F.left("diff", F.lit(longest))).where(J.strip(F.col("diff")) != "")
    kept = kept.join(newest, ["repo", "hash"], "left_semi")
    item = F.struct("path", "change", "diff")
    out = kept.groupBy("repo", F.col("hash").alias("session_id"), "author_email", "committed_at", F.left(J.strip(F.col("message")), F.lit(2000)).alias("message")).agg(F.slice(F.array_sort(F.collect_list(item)), 1, files).alias("files"))
    return out.withColumn("source", F.lit("git")).withColumn("harness", F.lit("git"))


def git_log(repo: str, most: int = 500) -> list[tuple]:
    """Rows for commits() from a local repository, read by git itself on the driver."""
    import subprocess

    mark, end = "\x1e", "\x1f"
    form = mark + end.join(("%H", "%P", "%ae", "%cI", "%B")) + end
    log = subprocess.run(["git", "-C", repo, "log", "--no-merges", f"-{most}", "-p", "--no-color", "--no-renames", f"--format={form}"], check=True, capture_output=True, text=True, errors="replace").stdout
    rows = []
    for block in log.split(mark)[1:]:
        sha, parents, email, at, message, body = block.split(end, 5)
        for change in body.split("\ndiff --git ")[1:]:
            head, _, diff = change.partition("\n@@")
            kind = "ADD" if "\nnew file mode" in head else "DELETE" if "\ndeleted file mode" in head else "MODIFY"
            rows.append((repo, sha, len(parents.split()), email, at, message, head.split("\n", 1)[0].rsplit(" b/", 1)[-1], kind, "@@" + diff if diff else ""))
    return rows


# Sources that can be found on a disk but not read.
DETECT_ONLY = ("jetbrains_ai",)


def ingest(spark: SparkSession, places: dict[str, dict], *, limit: int | None = None) -> DataFrame:
    """Turns of all named sources, one frame; a limit holds for each. Sources that can only be detected are passed over; unknown ones fail."""
    parts = []
    for name, args in places.items():
        if name in DETECT_ONLY:
            continue
        if name not in READERS:
            raise ValueError(f"unknown source: {name}")
        rows = READERS[name](spark, **args)
        parts.append(rows if limit is None else rows.limit(limit))
    if not parts:
        raise ValueError("no source to read")
    return reduce(DataFrame.unionByName, parts).withColumn("ingested_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
