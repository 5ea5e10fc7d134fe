"""Readers, loaders and scans on small invented files."""

import json
import sqlite3

import pytest
import zstandard
from pyspark.sql import functions as F

from trainlake.sources import catalog, datasets, sessions, sqlite
from trainlake.sources.jsonl import choose_files, json_lines, latest_per_prefix, numbered_lines, parquet_rows, parse_errors, read_strict, read_turns, resolve, train_rows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text if isinstance(text, str) else "\n".join(json.dumps(x) for x in text) + "\n", encoding="utf-8")
    return str(path)


def said(rows, *more):
    return [tuple(r[c] for c in ("session_id", "role", "text", *more)) for r in sorted(rows.collect(), key=lambda r: (r.source_path or "", r.line_no or 0, r.role, r.text))]


def block(text, kind="text"):
    return {"type": kind, "text": text}


def test_scan_numbers_lines(spark, tmp_path):
    p = put(tmp_path / "a-2024-01-01.jsonl", '{"role":"user","text":"hi"}\n\n\t \nnot json\n[1]\n{"role":"assistant","text":"yo","line_no":7,"messages":[{"role":"user","content":"x"}]}\n')
    got = read_turns(spark, p).orderBy("_line_no").collect()
    assert [(r._line_no, r.text, r._parse_error, r.line_no) for r in got] == [(1, "hi", None, None), (4, None, "not json", None), (6, "yo", None, 7)]
    assert read_turns(spark, p, keep_bad=False).count() == 2 and parse_errors(spark, p).first().parse_errors == 1
    assert train_rows(spark, p).select("line_no").collect()[0][0] == 6
    with pytest.raises(Exception):
        read_strict(spark, p).collect()


def test_lines_of_split_files(spark, tmp_path):
    put(tmp_path / "x.txt", "".join(f"{i}\n" for i in range(5000)))
    put(tmp_path / "y.txt", "".join(f"{i}\n" for i in range(3)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        rows = numbered_lines(spark, str(tmp_path))
        assert rows.count() == 5003 and rows.where("cast(value as long) + 1 != line_no").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_file_choice(tmp_path):
    names = ["b.jsonl", "a.jsonl", "safety-failures-x.jsonl", "safety-warn-x.jsonl", "public-stack-v2-dedup-1.jsonl", "c.txt"]
    assert choose_files(names) == ["a.jsonl", "b.jsonl"] and choose_files(names, stage="curate") == ["a.jsonl", "b.jsonl", "safety-warn-x.jsonl"]
    assert latest_per_prefix(["x-2024-01-01.jsonl", "x-2024-02-01.jsonl", "y.jsonl"]) == ["x-2024-02-01.jsonl", "y.jsonl"]
    assert resolve(["a", "b", "c"], lambda p: p == "b") == ("shards", "b")
    with pytest.raises(FileNotFoundError):
        resolve(["a"], lambda p: False)


def test_cursor(spark, tmp_path):
    root = tmp_path / "p" / "agent-transcripts"
    put(root / "s1" / "s1.jsonl", [{"role": "human", "message": {"content": [block("a <user_query> q </user_query> b"), {"type": "tool_use", "name": "sh", "input": {"command": "ls", "z": 1}}]}}, {"type": "assistant", "content": " plain "}, {"role": "tool", "content": "x"}, {"role": "user", "message": "m"}, {"role": "user", "content": 5}])
    put(root / "subagents" / "s2.jsonl", [{"role": "user", "content": "hidden"}])
    got = said(sessions.cursor(spark, f"{tmp_path}/p/agent-transcripts/*/*.jsonl"), "line_no")
    assert got == [("s1", "user", "q\n[tool sh] command=ls", 1), ("s1", "assistant", "plain", 2), ("s1", "user", "m", 4)]
    assert sessions.cursor(spark, f"{tmp_path}/p/agent-transcripts/*/*.jsonl", subagents=True).count() == 4
    assert sessions.cursor(spark, f"{tmp_path}/p/agent-transcripts/s1/*.jsonl").where("line_no = 1").first().extra["has_tool_use"] == "true"


def test_codex_claude_pi(spark, tmp_path):
    name = "rollout-" + "a" * 40
    item = lambda role, *blocks: {"type": "response_item", "payload": {"type": "message", "role": role, "content": list(blocks)}}
    p = put(tmp_path / f"{name}.jsonl", [item("user", block("hi", "input_text"), block("no", "text")), item("developer", block("d", "input_text")), item("assistant", block("yo", "output_text")), {"type": "event_msg", "payload": {"type": "user_message", "message": "ev"}}, item("tool", block("x", "input_text"))])
    assert said(sessions.codex(spark, p)) == [("a" * 36, "user", "hi"), ("a" * 36, "developer", "d"), ("a" * 36, "assistant", "yo")]
    assert sessions.codex(spark, p, largest_mb=0.0001).count() == 0
    p = put(tmp_path / "proj" / "c.jsonl", [{"type": "user", "message": {"role": "user", "content": "q"}}, {"type": "assistant", "isSidechain": True, "message": {"content": "side"}}, {"type": "System", "message": {"role": "user", "content": "s"}}, {"type": "assistant", "message": {"content": [block("a"), block("b")]}}, {"type": "user", "message": "x" * 200_001}])
    rows = sessions.claude_code(spark, p)
    assert said(rows) == [("c", "user", "q"), ("c", "assistant", "a\nb"), ("c", "user", "x" * 200_001)] and rows.first().extra["project_hash"] == "proj"
    assert said(sessions.claude_code(spark, p, longest=200_000)) == [("c", "user", "q"), ("c", "assistant", "a\nb")]
    p = put(tmp_path / "t_9.jsonl", [{"type": "message", "message": {"role": "user", "content": "u"}}, {"type": "custom_message", "display": False, "content": "no"}, {"type": "custom_message", "content": [block("shown")]}, {"type": "label"}, {"type": "message", "message": {"role": "tool", "content": "t"}}])
    assert said(sessions.pi(spark, p)) == [("9", "user", "u"), ("9", "user", "shown")]


def test_whole_file_readers(spark, tmp_path):
    put(tmp_path / "task1" / "api_conversation_history.json", json.dumps([{"role": "user", "content": [block("one"), {"type": "x", "text": "two"}]}, {"role": "assistant", "content": "three"}, {"role": "system", "content": "no"}]))
    put(tmp_path / "task1" / "ui_messages.json", json.dumps([{"type": "say", "say": "task", "text": "t"}, {"type": "say", "say": "text", "text": "x", "partial": True}, {"type": "ask", "ask": "ok?", "text": "q", "reasoning": " r "}, {"type": "say", "say": "other", "text": "no"}, {"role": "Assistant", "content": ["l", "m"]}]))
    got = [x[1:] for x in said(sessions.cline(spark, f"{tmp_path}/task1/*.json"))]
    assert sorted(got) == sorted([("user", "one\ntwo"), ("assistant", "three"), ("user", "t"), ("assistant", "q\nr"), ("assistant", "l\nm")])
    assert {r.harness for r in sessions.roo_code(spark, f"{tmp_path}/task1/*.json").collect()} == {"roo_code"}
    p = put(tmp_path / "c" / "s.json", json.dumps({"sessionId": "S", "history": [{"message": {"role": "user", "content": " a "}}, {"role": "assistant", "content": [block("b"), {"type": "image"}]}]}))
    assert sorted(said(sessions.continue_(spark, p))) == [("S", "assistant", "b"), ("S", "user", "a")]
    put(tmp_path / "g" / "chats" / "session-1.json", json.dumps({"messages": [{"type": "user", "content": "u"}, {"type": "gemini", "text": "m"}, {"type": "info", "content": "no"}]}))
    put(tmp_path / "g" / "chats" / "session-2.jsonl", [{"$set": {"type": "user", "content": "no"}}, {"sessionId": "x"}, {"type": "model", "content": "one"}, {"messages": [{"type": "user", "content": ["a", "b"]}]}])
    assert sorted(x[1:] for x in said(sessions.gemini_cli(spark, f"{tmp_path}/g/chats/*"))) == [("assistant", "m"), ("assistant", "one"), ("user", "a\nb"), ("user", "u")]
    p = put(tmp_path / "amp.json", json.dumps({"id": "T", "messages": [{"role": "user", "content": [{"text": "x"}, block("y")]}, {"role": "assistant", "text": "z"}]}))
    assert sorted(said(sessions.amp(spark, p))) == [("T", "assistant", "z"), ("T", "user", "x\ny")]
    put(tmp_path / "o" / "conv" / "events" / "1.json", json.dumps({"source": "user", "action": "message", "args": {"content": "hey"}}))
    put(tmp_path / "o" / "conv" / "events" / "10.json", json.dumps({"kind": "MessageEvent", "source": "agent", "llm_message": {"role": "assistant", "content": ["p", block("q")]}}))
    put(tmp_path / "o" / "conv" / "events" / "2.json", json.dumps({"source": "agent", "message": "text"}))
    put(tmp_path / "o" / "conv" / "events" / "3.json", json.dumps({"source": "environment", "message": {"role": "user", "content": "m"}}))
    assert [x for x in said(sessions.openhands(spark, f"{tmp_path}/o/conv/events/*.json"))] == [("conv", "user", "hey"), ("conv", "assistant", "p\nq"), ("conv", "assistant", "text"), ("conv", "user", "m")]
    p = put(tmp_path / "h.md", "\n#### fix it\nplease\n#### again\n> tool says\n\nshort")
    put(tmp_path / "h2.md", "# this is a long enough introduction\n#### ask\n")
    assert sorted(x[1:] for x in said(sessions.aider(spark, f"{tmp_path}/h*.md"))) == [("assistant", "# this is a long enough introduction"), ("user", "again\n> tool says\n\nshort"), ("user", "ask"), ("user", "fix it\nplease")]
    p = put(tmp_path / "m" / "msg.json", json.dumps({"info": {"role": "user"}, "parts": [block("a"), {"type": "tool"}, block("b")]}))
    assert said(sessions.opencode(spark, p)) == [("m", "user", "a\nb")]
    p = put(tmp_path / "trae.json", json.dumps({"turns": [{"role": "ai", "content": {"text": "d"}}, {"type": "Human", "message": "e"}]}))
    assert said(sessions.trae(spark, p), "line_no") == [("trae", "assistant", "d", 1), ("trae", "user", "e", 2)]


def test_line_readers(spark, tmp_path):
    p = put(tmp_path / "s1" / "events.jsonl", [{"type": "user.message", "data": {"content": " u "}}, {"type": "assistant.message", "data": {"content": "a"}, "ephemeral": True}, {"type": "x", "data": {"content": "b"}}])
    assert said(sessions.copilot(spark, p)) == [("s1", "user", "u")]
    p = put(tmp_path / "f.jsonl", [{"role": "Human", "text": "u"}, {"messages": [{"role": "assistant", "content": ["a", 1]}, {"role": "tool", "content": "t"}]}])
    assert said(sessions.factory(spark, p), "line_no") == [("f", "user", "u", 1), ("f", "assistant", "a\n1", 2)]
    p = put(tmp_path / "k1" / "context.jsonl", [{"role": "_system_prompt", "content": "s"}, {"role": "user", "content": [block("u")]}, {"role": "tool", "content": "t"}])
    assert said(sessions.kimi(spark, p)) == [("k1", "user", "u")]
    p = put(tmp_path / "oc.jsonl", [{"type": "message", "message": {"role": "user", "content": "u"}}, {"type": "custom_message", "role": "assistant", "content": [{"text": "a"}]}, {"type": "x", "role": "user", "content": "n"}])
    assert said(sessions.openclaw(spark, p)) == [("oc", "user", "u"), ("oc", "assistant", "a")]
    p = put(tmp_path / "w.jsonl", [{"type": "human", "message": "u"}, {"role": "assistant", "content": {"a": 1}}, {"role": "assistant", "text": "t"}])
    assert said(sessions.watchfire(spark, p)) == [("w", "user", "u"), ("w", "assistant", "t")]
    p = put(tmp_path / "mx.jsonl", [{"role": "model", "content": [{"text": "a"}, {"content": "b"}]}])
    assert said(sessions.mux(spark, p)) == [("mx", "assistant", "a\nb")] and sessions.antigravity(spark, p).count() == 1
    u = put(tmp_path / "q" / "session-usage.json", '{"tokens": 5}')
    assert said(sessions.mux(spark, p, usage=u)) == [("q", "metadata", '{"tokens":5}')]


def database(path, *statements):
    conn = sqlite3.connect(path)
    for sql, *args in statements:
        conn.execute(sql, *args)
    conn.commit()
    conn.close()
    return str(path)


def test_databases(spark, tmp_path):
    oc = database(tmp_path / "oc.db", ("CREATE TABLE message(id, session_id, data, time_created)",), ("CREATE TABLE part(message_id, data, time_created)",), ("INSERT INTO message VALUES ('m1','s','{\"role\":\"user\"}',1),('m2','s','{\"role\":\"system\"}',2)",), ("INSERT INTO part VALUES ('m1','{\"type\":\"text\",\"text\":\"late\"}',9),('m1','{\"type\":\"tool\"}',1),('m1','{\"type\":\"text\",\"text\":\" first \"}',2)",))
    assert said(sessions.opencode(spark, databases=[oc])) == [("s", "user", "first")]
    t3 = database(tmp_path / "t3.db", ("CREATE TABLE projection_thread_messages(message_id, thread_id, turn_id, role, text, created_at)",), ("INSERT INTO projection_thread_messages VALUES ('a','t','u','user',' x ','1'),('b','t','u','assistant','','2')",))
    assert said(sessions.t3code(spark, [t3, oc])) == [("t", "user", "x")]
    ws = database(tmp_path / "ws.db", ("CREATE TABLE ItemTable(key, value)",), ("INSERT INTO ItemTable VALUES ('chat.data', ?), ('aiChat.chatdata', ?)", (json.dumps({"tabs": [{"tabId": "no", "bubbles": [{"type": "user", "text": "later key"}]}]}), json.dumps({"tabs": [{"tabId": "T", "bubbles": [{"type": "user", "rawText": "u"}, {"type": "ai", "text": "a"}]}]}))))
    assert said(sessions.windsurf(spark, [ws])) == [("T", "user", "u"), ("T", "assistant", "a")]
    gs = database(tmp_path / "gs.db", ("CREATE TABLE messages(session_id, role, content, timestamp)",), ("INSERT INTO messages VALUES ('g','user','{\"text\":\"t\"}',1),('g','assistant',' plain ',2),('g','tool','x',3)",))
    assert sorted(said(sessions.goose(spark, [gs]))) == [("g", "assistant", "plain"), ("g", "user", "t")]
    assert sorted(said(sessions.kiro(spark, databases=[gs, oc]))) == [("g", "assistant", "plain"), ("g", "user", "t")]
    kc = database(tmp_path / "kc.db", ("CREATE TABLE conversations(id, data)",), ("INSERT INTO conversations VALUES ('c', ?)", (json.dumps({"messages": [{"role": "user", "content": [{"text": "u"}, {"content": "v"}]}]}),)))
    put(tmp_path / "k" / "a.json", json.dumps({"id": "A", "history": [{"role": "user", "text": "h"}]}))
    put(tmp_path / "k" / "b.jsonl", [{"role": "assistant", "content": "l"}])
    assert sorted(said(sessions.kiro(spark, f"{tmp_path}/k/*", databases=[kc]))) == [("A", "user", "h"), ("b", "assistant", "l"), ("c", "user", "u\nv")]
    thread = json.dumps({"entries": [{"type": "user", "text": "u"}, {"role": "assistant", "content": [block("a")]}]}).encode()
    zd = database(tmp_path / "zd.db", ("CREATE TABLE threads(id, data_type, data)",), ("INSERT INTO threads VALUES ('z', 'zstd', ?), ('j', 'json', ?), ('x', 'other', ?), ('bad', 'zstd', ?)", (zstandard.compress(thread), thread, thread, b"junk")))
    assert sorted(said(sessions.zed_ai(spark, [zd]))) == [("j", "assistant", "a"), ("j", "user", "u"), ("z", "assistant", "a"), ("z", "user", "u")]
    cr = database(tmp_path / "cr.db", ("CREATE TABLE messages(id, role, parts)",), ("INSERT INTO messages VALUES ('1','user',?), ('2','assistant','not json')", (json.dumps([{"type": "text", "data": {"text": "u"}}, {"type": "tool"}, {"type": "text", "data": "v"}]),)))
    assert said(sessions.crush(spark, [cr])) == [("1", "user", "u\nv"), ("2", "assistant", "not json")][::-1] or sorted(said(sessions.crush(spark, [cr]))) == [("1", "user", "u\nv"), ("2", "assistant", "not json")]
    assert sqlite.read_sqlite(spark, [put(tmp_path / "no.db", "not a database at all")], "SELECT 1", "a int").count() == 0


def test_ingest_and_catalogues(spark, tmp_path):
    p = put(tmp_path / "w.jsonl", [{"role": "user", "text": "a"}, {"role": "user", "text": "b"}])
    got = sessions.ingest(spark, {"watchfire": {"path": p}, "jetbrains_ai": {}, "antigravity": {"path": p}}, limit=1)
    assert sorted(r.harness for r in got.collect()) == ["antigravity", "watchfire"] and "ingested_at" in got.columns
    with pytest.raises(ValueError):
        sessions.ingest(spark, {"unknown": {}})
    assert catalog.harnesses(spark).count() == 27 and catalog.harnesses(spark, "detect").count() == 1
    assert catalog.datasets(spark).count() == 14 and catalog.datasets(spark, "legacy").count() == 4
    put(tmp_path / "home" / ".watchfire" / "logs" / "x.jsonl", "{}")
    found = {r["id"]: r for r in catalog.discover(str(tmp_path / "home"))}
    assert found["watchfire"]["files"] == 1 and found["watchfire"]["note"] == "ready" and not found["amp"]["exists"]
    assert catalog.merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert set(sessions.READERS) | {"git", "jetbrains_ai"} == {h[0] for h in catalog.HARNESSES} and set(datasets.LOADERS) == {d[0] for d in catalog.DATASETS}


def test_commits(spark):
    row = lambda h, at, path, change="MODIFY", diff="+x", parents=1: ("r", h, parents, "a@b.c", at, " msg ", path, change, diff)
    rows = [row("c1", "2024-01-01", "a.py"), row("c1", "2024-01-01", "b.txt"), row("c2", "2024-01-02", "a.py", parents=2), row("c3", "2024-01-03", "x.go", "DELETE"), row("c4", "2024-01-04", "z.MD", "ADD", "y" * 20_000), row("c5", "2024-01-05", "q.ts", diff=" ")] + [row("c6", "2024-01-06", f"f{i}.rs") for i in range(10)]
    df = spark.createDataFrame(rows, "repo string, hash string, parents int, author_email string, committed_at string, message string, path string, change string, diff string")
    got = {r.session_id: r for r in sessions.commits(df).collect()}
    assert sorted(got) == ["c1", "c4", "c6"] and len(got["c6"].files) == 8 and len(got["c4"].files[0].diff) == 12_000 and got["c1"].message == "msg" and [f.path for f in got["c1"].files] == ["a.py"]
    assert [r.session_id for r in sessions.commits(df, most=1).collect()] == ["c6"] and sessions.commits(df, author="x").count() == 0


def test_git_log(tmp_path):
    import subprocess

    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), *a], check=True, capture_output=True)
    run("init", "-q")
    (tmp_path / "a.py").write_text("x = 1\n")
    run("add", ".")
    run("-c", "user.name=n", "-c", "user.email=n@x.y", "commit", "-qm", "first")
    (row,) = sessions.git_log(str(tmp_path))
    assert row[3] == "n@x.y" and row[5].strip() == "first" and row[6:8] == ("a.py", "ADD") and "+x = 1" in row[8]


def turns_of(rows):
    return [(r.session_id, r.line_no, r.role, r.text) for r in sorted(rows.collect(), key=lambda r: (r.session_id, r.line_no))]


def test_instruction_pairs(spark):
    rows = [("1", " q ", None, "a", "t", None), (None, "", "p", "b", None, None), ("3", None, None, None, None, '[{"role":"user","content":"m"},{"role":"tool","content":"x"},{"role":"assistant","content":[{"value":"n"}]}]'), ("4", "only", None, None, None, "bad json")]
    df = spark.createDataFrame(rows, "id string, instruction string, prompt string, response string, cot string, messages string").coalesce(1)
    got = turns_of(datasets.instruction_pairs(df, "d", "v"))
    assert got == [("1", 1, "user", "q"), ("1", 2, "assistant", "[thinking]\nt\n\na"), ("3", 1, "user", "m"), ("3", 2, "assistant", "n"), ("d-1", 1, "user", "p"), ("d-1", 2, "assistant", "b")]
    assert {r[0] for r in turns_of(datasets.instruction_pairs(df, "d", "v", max_rows=2))} == {"1", "d-1"}
    one = datasets.instruction_pairs(df, "d", "v").first()
    assert (one.source, one.harness, one.label, one.exec, one.verify) == ("public", "public_d", "accepted", "pass", "v")


def test_message_datasets(spark):
    msg = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame([("i1", [("user", "a"), ("system", "s"), ("Assistant", " b ")], "Submitted"), (None, [("user", "a")], "Submitted"), (None, [("user", "c"), ("assistant", "")], "Failed")], f"instance_id string, messages {msg}, exit_status string").coalesce(1)
    assert turns_of(datasets.swe_next(df)) == [("i1", 1, "user", "a"), ("i1", 2, "assistant", "b"), ("swe-next-2", 1, "user", "c")]
    assert turns_of(datasets.swe_zero_12m(df)) == [("i1-0", 1, "user", "a"), ("i1-0", 2, "assistant", "b")]
    assert datasets.swe_zero_12m(df).first().extra["exit_status"] == "Submitted"
    text = spark.createDataFrame([("m", json.dumps([{"role": "user", "content": "a"}, 5, {"role": "assistant", "content": "b"}])), ("n", "oops")], "mid string, messages string").coalesce(1)
    assert turns_of(datasets.ling_coder_sft(text)) == [("m", 1, "user", "a"), ("m", 2, "assistant", "b")]
    assert turns_of(datasets.coderforge_preview(text)) == [("coderforge-0", 1, "user", "a"), ("coderforge-0", 2, "assistant", "b")]
    assert [r[0] for r in turns_of(datasets.nemotron_swe_v2({"agentless": text, "openhands_swe": text}))] == ["nemotron-swe-v2-agentless-0"] * 2
    oh = [{"role": "user", "content": "go"}, {"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "sh", "arguments": "y" * 600}}]}, {"role": "tool", "content": "t"}]
    df = spark.createDataFrame([("T", json.dumps(oh), " p "), ("U", json.dumps(oh), " ")], "trajectory_id string, t string, model_patch string").select("trajectory_id", F.from_json("t", "array<struct<role:string,content:string,tool_calls:array<struct<function:struct<name:string,arguments:string>>>>>").alias("trajectory"), "model_patch")
    got = turns_of(datasets.swe_zero_openhands(df))
    assert got == [("T", 1, "user", "go"), ("T", 2, "assistant", "[tool sh] " + "y" * 477 + "…")] and len(turns_of(datasets.swe_zero_openhands(df, require_patch=False))) == 4
    pairs = spark.createDataFrame([("x", " in ", "out", 1.0), ("y", "in", " ", 0.5)], "id string, input string, output string, average_test_score double")
    assert turns_of(datasets.opencode_refined(pairs)) == [("x", 1, "user", "in"), ("x", 2, "assistant", "out")]
    assert turns_of(datasets.scale_swe(spark.createDataFrame([("k", "p", "d")], "instance_id string, problem_statement string, patch string"))) == [("k", 1, "user", "p"), ("k", 2, "assistant", "d")]
    assert turns_of(datasets.agentic_cot_coding(spark.createDataFrame([("u", "a")], "user string, assistant string"))) == [("agentic_cot_coding-0", 1, "user", "u"), ("agentic_cot_coding-0", 2, "assistant", "a")]
    with pytest.raises(NotImplementedError):
        datasets.zen_agentic()


def test_chat_runs(spark):
    rows = [("a", 2, "assistant", None, None, "two"), ("a", 1, "user", None, None, "one"), ("a", 3, "user", "progress", None, "no"), ("b", 1, "tool_use", None, "sh", "ls"), ("b", 2, "metadata", None, None, "no"), ("a", 1, "user", None, None, "again"), (None, 1, "user", None, None, " "), ("b", 1, "tool_result", None, None, "ok")]
    df = spark.createDataFrame(rows, "session_id string, turn_number int, role string, turn_type string, tool_name string, content string").coalesce(1)
    got = sorted((r.session_id, r.line_no, r.role, r.text) for r in datasets.swe_chat(df).collect())
    assert got == sorted([("a", 1, "user", "one"), ("a", 2, "assistant", "two"), ("b", 1, "user", "[tool:sh]\nls"), ("a", 1, "user", "again"), ("b", 1, "user", "[tool_result]\nok")])
    assert datasets.swe_chat(df, max_rows=1).count() == 1


def test_side_loaded_files(spark, tmp_path):
    traj = {"agent_id": "A1", "status": "done", "messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]}
    put(tmp_path / "coop" / "r" / "1" / "f" / "agent1_traj.json", json.dumps(traj))
    put(tmp_path / "coop" / "r" / "1" / "f" / "agent2_traj.json", json.dumps({"messages": traj["messages"]}))
    df = spark.createDataFrame([("/r/1/f", "repo", 7, "f1"), ("coop/none", "repo", 8, "f2"), (" ", "repo", 9, "f3")], "log_dir string, repo string, task_id int, features string")
    got = turns_of(datasets.cooper(df, folder=str(tmp_path)))
    assert [(s, n, r) for s, n, r, _ in got] == [("repo-7-f1-A1", 1, "user"), ("repo-7-f1-A1", 2, "assistant"), ("repo-7-f1-agent2", 1, "user"), ("repo-7-f1-agent2", 2, "assistant")]
    for split, rows in (("general", [{"uuid": "g", "messages": [{"role": "user", "content": "u"}, {"role": "tool", "content": "t"}]}]), ("agent_skills", [{"messages": [{"role": "user", "content": "v"}, {"role": "assistant", "content": "w"}]}])):
        put(tmp_path / split / "data.jsonl", rows)
    out = datasets.nemotron_opencode(spark, str(tmp_path), splits=("general", "agent_skills"))
    assert turns_of(out) == [("g", 1, "user", "u"), ("nemotron-opencode-agent_skills-0", 1, "user", "v"), ("nemotron-opencode-agent_skills-0", 2, "assistant", "w")]
    assert {r.session_id: r.map_tool_to_user for r in out.collect()} == {"g": True, "nemotron-opencode-agent_skills-0": False}
    assert datasets.nemotron_opencode(spark, str(tmp_path), 1, ("general", "agent_skills")).select("session_id").distinct().count() == 1


def test_shards(spark, tmp_path):
    for i in (1, 0):
        spark.createDataFrame([(f"{i}{j}", "p", "d") for j in range(3)], "instance_id string, problem_statement string, patch string").coalesce(1).write.parquet(f"{tmp_path}/s{i}")
    assert parquet_rows(spark, str(tmp_path)).count() == 6
    assert datasets.load_shards(spark, "scale_swe", str(tmp_path), max_rows=2).select("session_id").distinct().orderBy("session_id").collect()[0][0] == "00"
    assert json_lines(spark, spark.createDataFrame([("p", '{"a":1}\r\n\n[2]\n{"a":3}')], "source_path string, content string")).select("line_no").collect()[1][0] == 4


def test_no_limit_unless_asked_for(spark, tmp_path):
    """Turns, texts and files of any length are read; limits hold where they are given."""
    long = "y" * 300_000
    p = put(tmp_path / "s" / "context.jsonl", [{"role": "user", "content": long}, {"role": "assistant", "content": "short"}])
    assert [len(r.text) for r in sessions.kimi(spark, p).orderBy("line_no").collect()] == [300_000, 5]
    assert [r.text for r in sessions.READERS["kimi"](spark, p, longest=1000).collect()] == ["short"]
    many = spark.createDataFrame([("p", "\n".join('{"a": 1}' for _ in range(60_000)))], "source_path string, content string")
    assert json_lines(spark, many).count() == 60_000 and json_lines(spark, many, most=50).count() == 50
