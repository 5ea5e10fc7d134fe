"""Catalogues of the sources: session logs on a disk and public datasets; what is there, and which of them a run takes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Session sources: id, format, how far they can be read, place below the home folder, file pattern.
HARNESSES = [
    ("cursor", "jsonl", "full", ".cursor/projects", "*.jsonl"), ("codex", "jsonl", "full", ".codex/sessions", "rollout-*.jsonl"), ("claude_code", "jsonl", "full", ".claude/projects", "*.jsonl"),
    ("pi", "jsonl", "full", ".pi/agent/sessions", "*.jsonl"), ("opencode", "sqlite", "full", ".local/share/opencode", "*"), ("t3code", "sqlite", "full", ".t3/userdata", "*.sqlite"), ("aider", "markdown", "full", "", ".aider.chat.history.md"),
    ("cline", "json", "full", ".cline/data", "*.json"), ("continue", "json", "full", ".continue/sessions", "*.json"), ("gemini_cli", "jsonl", "full", ".gemini", "session-*"), ("copilot", "jsonl", "full", ".copilot/session-state", "events.jsonl"),
    ("amp", "json", "full", ".local/share/amp/threads", "*.json"), ("factory", "jsonl", "full", ".factory", "*.jsonl"), ("openhands", "json", "full", ".openhands-state", "*.json"), ("git", "git", "full", "", ".git"),
    ("windsurf", "sqlite", "partial", ".config/Windsurf", "state.vscdb"), ("kimi", "jsonl", "full", ".kimi/sessions", "context.jsonl"), ("goose", "sqlite", "full", ".local/share/goose/sessions", "sessions.db"), ("kiro", "json", "full", ".kiro/sessions/cli", "*.json*"),
    ("openclaw", "jsonl", "full", ".openclaw", "*.jsonl"), ("zed_ai", "sqlite", "full", ".local/share/zed/threads", "threads.db"), ("roo_code", "json", "full", ".config/Code/User/globalStorage", "*.json"), ("watchfire", "jsonl", "full", ".watchfire/logs", "*.jsonl"),
    ("crush", "sqlite", "full", ".local/share/crush", "crush.db"), ("mux", "json", "partial", ".mux/sessions", "*"), ("antigravity", "jsonl", "partial", ".config/tokscale/antigravity-cache/sessions", "*.jsonl"),
    ("trae", "json", "partial", ".config/tokscale/trae-cache/sessions", "*.json"), ("jetbrains_ai", "sqlite", "detect", ".config/JetBrains", "*"),
]
# Public datasets: id, repository, rows that are taken unless said otherwise (null: all), release, whether terms must be accepted, tier.
DATASETS = [
    ("swe_chat", "SALT-NLP/SWE-chat", None, "2026-04", True, "top10"), ("coderforge_preview", "togethercomputer/CoderForge-Preview", 10_000, "2026-02", False, "top10"), ("zen_agentic", "zenlm/zen-agentic-dataset", 5_000, "2026-05", False, "top10"),
    ("swe_next", "TIGER-Lab/SWE-Next-SFT-Trajectories", None, "2026-03", False, "top10"), ("swe_zero_12m", "AlienKevin/SWE-ZERO-12M-trajectories", None, "2026", False, "top10"), ("swe_zero_openhands", "nvidia/SWE-Zero-openhands-trajectories", None, "2026", False, "top10"),
    ("agentic_sft_new", "WaltonFuture/agentic-sft-new", 10_000, "2026-05", False, "top10"), ("agentic_cot_coding", "mepartha/Agentic-Chain-of-Thought-Coding-SFT-Dataset-v1.1", 10_000, "2026", False, "top10"), ("nemotron_opencode", "nvidia/Nemotron-SFT-OpenCode-v1", 10_000, "2026-03", False, "top10"),
    ("opencode_refined", "EER6/nvidia-OpenCodeInstruct-refined", 5_000, "2026-04", False, "legacy"), ("ling_coder_sft", "inclusionAI/Ling-Coder-SFT", None, "2026", False, "legacy"), ("nemotron_swe_v2", "nvidia/Nemotron-SFT-SWE-v2", None, "2026", False, "legacy"),
    ("scale_swe", "AweAI-Team/Scale-SWE", None, "2026", False, "legacy"), ("cooper_qwen9b_coop_claude", "CooperBench/qwen9b-coop-claude-code", None, "2026", False, "top10"),
]
MOST_FILES = 5_000


def harnesses(spark: SparkSession, tier: str | None = None) -> DataFrame:
    """The session sources that can be read (full and partial), or those of one tier."""
    rows = [h for h in HARNESSES if (h[2] == tier if tier else h[2] in ("full", "partial"))]
    return spark.createDataFrame(rows, "id string, format string, tier string, root string, pattern string")


def datasets(spark: SparkSession, tier: str | None = None, ids: tuple[str, ...] | None = None) -> DataFrame:
    """The public datasets, of one tier or by id."""
    rows = [d for d in DATASETS if (tier is None or d[5] == tier) and (ids is None or d[0] in ids)]
    return spark.createDataFrame(rows, "dataset_id string, hf_repo string, default_max_rows int, released string, gated boolean, tier string")


def discover(home: str, most: int = MOST_FILES) -> list[dict]:
    """For every session source whether its folder is there, how many files it has (counted up to a cap) and whether a run can read it. Runs on the machine whose disk is asked."""
    import itertools
    from pathlib import Path

    out = []
    for name, kind, tier, root, pattern in HARNESSES:
        place = Path(home) / root
        n = sum(1 for _ in itertools.islice(place.rglob(pattern), most)) if root and place.is_dir() else int((place / pattern).exists())
        note = "detect only" if tier == "detect" else "nothing found" if not n else "partly readable" if tier == "partial" else "ready"
        out.append({"id": name, "format": kind, "tier": tier, "exists": place.exists() if root else n > 0, "files": n, "capped": n >= most, "note": note})
    return out


def merged(base: dict, profile: dict | None) -> dict:
    """A configuration with a profile over it, nested values one by one."""
    out = dict(base)
    for k, v in (profile or {}).items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
