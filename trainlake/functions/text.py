"""Scalar text functions as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variant import WHITE, strip

# What marks a cut text, in curation and in the training set.
MARKER = "\n…[truncated]"
TRAIN_MARKER = "\n...[truncated for VRAM]"
# Style tags in order and the words that give them, without regard to case.
STYLE_RULES = [
    ("security", r"\b(CVE|exploit|burp|pentest|vuln|OWASP|XSS|SQLi)\b"),
    ("refactor", r"\b(refactor|extract|rename|move module)\b"),
    ("debug", r"\b(traceback|stack trace|segfault|pytest|failing test)\b"),
    ("infra", r"\b(docker|kubernetes|terraform|systemd|nginx)\b"),
    ("docs", r"\b(README|CHANGELOG|ADR|architecture doc)\b"),
    ("planning", r"\b(roadmap|milestone|phase \d|implementation plan)\b"),
]
# Words of an urgent and of a collaborative tone.
URGENT = r"\b(urgent|asap|blocking|production down)\b"
COLLABORATIVE = r"\b(please review|PR|pull request)\b"


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def normalise_role(role: Column, kind: Column | None = None, nested: Column | None = None) -> Column:
    """First of role, type, message.role that is a known speaker; human counts as user; otherwise null."""
    known = []
    for c in (role, kind, nested):
        if c is not None:
            low = F.lower(c)
            known.append(F.when(low.isin("user", "human"), "user").when(low == "assistant", "assistant"))
    return F.coalesce(*known)


def map_role(role: Column, skip: tuple[str, ...] = ("developer", "system")) -> Column:
    """Role map of curation; skipped and unknown roles are null."""
    low = F.lower(role)
    out = F.when(low.isin("user", "human"), "user").when(low.isin("assistant", "gpt", "model"), "assistant").when(low == "system", "system")
    return F.when(low.isin(*skip), F.lit(None).cast("string")).otherwise(out)


def truncate(text: Column, limit: int | Column, marker: str = MARKER) -> Column:
    """N9."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return F.when(F.length(text) > limit, F.concat(F.left(text, limit), F.lit(marker))).otherwise(text)


def curated_id(source: Column, line: Column) -> Column:
    """First 32 hexadecimal digits of the SHA-256 of source:line."""
    return F.left(F.sha2(F.concat_ws(":", source, line.cast("string")), 256), F.lit(32))


def added_lines(diff: Column) -> Column:
    """Added lines and context lines without their sign; headers, removed, hunk and blank lines go."""
    def of(x: Column) -> Column:
        other = F.when(x.startswith(" "), F.substring(x, 2, 1 << 30)).when(F.btrim(x, F.lit(WHITE)) != "", x)
        return F.when(x.startswith("+++") | x.startswith("---"), F.lit(None)).when(x.startswith("+"), F.substring(x, 2, 1 << 30)).when(~(x.startswith("-") | x.startswith("@@")), other)

    return F.coalesce(F.array_join(F.array_compact(F.transform(F.split(diff, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), of)), "\n"), F.lit(""))


def style_tags(text: Column, most: int = 6) -> Column:
    """Tags of the rules that match, in order."""
    return F.slice(F.array_compact(F.array(*[F.when(text.rlike(f"(?i){p}"), F.lit(t)) for t, p in STYLE_RULES])), 1, most)


def tone(text: Column) -> Column:
    """Urgent before collaborative before neutral."""
    return F.when(text.rlike(f"(?i){URGENT}"), "urgent").when(text.rlike(f"(?i){COLLABORATIVE}"), "collaborative").otherwise("neutral")


def redact(text: Column) -> Column:
    """Two token shapes replaced."""
    return F.regexp_replace(F.regexp_replace(text, r"\bghp_[A-Za-z0-9]{36}\b", "[TOKEN]"), r"\b[0-9a-f]{40}\b", "[HEX40]")


def combined_text(parts: list[Column], messages: Column | None = None) -> Column:
    """A record's non-blank texts joined by a blank line: its own fields, then content and text of each message."""
    own = F.array_compact(F.array(*[F.when(strip(p) != "", p) for p in parts])) if parts else F.expr("cast(array() as array<string>)")
    if messages is not None:
        fields = F.flatten(F.transform(messages, lambda m: F.array(m["content"], m["text"])))
        own = F.concat(own, F.coalesce(F.filter(fields, lambda x: strip(x) != ""), F.expr("cast(array() as array<string>)")))
    return F.array_join(own, "\n\n")


def project(path: Column, dataset: Column, own: str | None = None, own_paths: tuple[str, ...] = ()) -> Column:
    """Public:dataset, or the lake's own project (if it has a name) by its path, or nothing. A path is the project's if it
    holds the name in any case, or one of own_paths as it is written."""
    out = F.when(F.coalesce(dataset, F.lit("")) != "", F.concat(F.lit("public:"), dataset))
    if own:
        mine = F.lower(path).contains(own.lower())
        for p in own_paths:
            mine = mine | path.contains(p)
        out = out.when(mine, own)
    return out.otherwise("")


def harness_of_file(path: Column) -> Column:
    """The source that a raw file's name stands for."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    body = F.regexp_replace(name, "^public-", "")
    parts = F.split(body, "-")
    dated = (F.size(parts) >= 3) & F.element_at(parts, -1).rlike("^[0-9]+$") & F.try_element_at(parts, F.lit(-2)).rlike("^[0-9]+$")
    slug = F.array_join(F.when(dated, F.slice(parts, 1, F.greatest(F.size(parts) - 3, F.lit(0)))).otherwise(parts), "_")
    public = F.when(slug != "", F.concat(F.lit("public_"), slug)).otherwise("public")
    out = F.when(name.startswith("public-"), public)
    for known in ("cursor", "codex", "git"):
        out = out.when(name.startswith(f"{known}-"), known)
    return out.otherwise(F.element_at(F.split(name, "-"), 1))


# Where repositories lie below a home folder.
REPO = r"(/home/[^/]+/Documents/[^/]+|/home/[^/]+/[^/]+/[^/]+)"


def repo_of_path(path: Column, pattern: str = REPO) -> Column:
    """The repository's folder at the start of a path, or null."""
    return F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))


def commit_ref(url: Column) -> Column:
    """The commit in a blob url, or null."""
    return F.nullif(F.regexp_extract(url, r"/blob/([0-9a-f]{7,40})/", 1), F.lit(""))


def message_budget(tokens: int) -> int:
    """X11: characters that a message may have for a sequence length."""
    return max(2000, 4 * tokens)
