"""The safety scan: rows to findings and failures (F13, F14), keys of failed rows (F15), whole sessions out (F16), windows."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import safety
from ..functions.safety import Policy
from ..functions.text import added_lines, combined_text
from ..functions.variant import strip

MESSAGES = "array<struct<role:string,content:string,text:string>>"
MODES = ("off", "pattern", "full")


def record_text(rows: DataFrame) -> Column:
    """N8 of the columns that a raw row has (a JSON `messages` column counts too)."""
    fields = [F.col(c) for c in ("text", "content", "message") if c in rows.columns]
    if "messages" not in rows.columns:
        return combined_text(fields)
    kind = rows.schema["messages"].dataType.simpleString()
    return combined_text(fields, F.from_json("messages", MESSAGES) if kind == "string" else F.col("messages"))


def evaluate(rows: DataFrame, *, policy: Policy = Policy(), personal: bool = False, external: Column | None = None) -> DataFrame:
    """rows with `rated` (findings that count), block_count, warn_count, quarantine. Diffs are scanned in their added lines only."""
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    whole = record_text(rows)
    diff = safety.is_diff(have("harness"), have("source"), have("source_path"), policy)
    body = F.coalesce(F.nullif(have("text"), F.lit("")), have("content"), F.lit(""))
    found = F.when(diff, safety.scan_diff(body)).otherwise(safety.scan_text(whole, with_personal=personal, policy=policy))
    if external is not None:
        found = F.concat(found, F.coalesce(external, safety.nothing()))
    out = safety.once(rows, "rated", safety.judged(found, policy))
    out = out.withColumn("block_count", safety.blocks(F.col("rated"))).withColumn("warn_count", safety.warns(F.col("rated")))
    return out.withColumn("quarantine", safety.should_quarantine(F.col("block_count"), F.col("warn_count"), policy.quarantine))


def scan(rows: DataFrame, *, policy: Policy = Policy(), personal: bool = False, limit: int | None = None, external: Column | None = None) -> DataFrame:
    """Failure and warning rows (column `failed` tells them apart) of what read_turns gives; malformed lines fail.

    One pass; both kinds of rows can be written from it by a filter. A limit takes the first lines of each file."""
    if limit is not None:
        rows = rows.where(F.col("_line_no") <= limit)
    bad = F.col("_parse_error").isNotNull()
    out = evaluate(rows, policy=policy, personal=personal, external=external)
    none = "cast(array(named_struct('source','json','kind','parse_error','detail','invalid json','start',cast(null as int),'end',cast(null as int),'match',cast(null as string),'severity','block')) as array<struct<source:string,kind:string,detail:string,start:int,end:int,match:string,severity:string>>)"
    out = out.withColumn("rated", F.when(bad, F.expr(none)).otherwise(F.col("rated"))).withColumn("block_count", F.when(bad, 1).otherwise(F.col("block_count"))).withColumn("warn_count", F.when(bad, 0).otherwise(F.col("warn_count")))
    out = out.withColumn("failed", bad | F.col("quarantine")).where(F.col("failed") | (F.col("warn_count") > 0))
    return out.select(
        F.col("_source_file").alias("source_file"), F.col("_line_no").alias("line_no"), F.coalesce(F.nullif("harness", F.lit("")), "source").alias("harness"), "session_id", "role", "source_path", "block_count", "warn_count",
        safety.max_severity(F.col("block_count"), F.col("warn_count")).alias("max_severity"), F.struct((~F.col("failed")).alias("ok"), F.transform("rated", lambda f: f.dropFields("match")).alias("findings")).alias("safety"),
        F.left(F.coalesce("text", F.lit("")), F.lit(240)).alias("text_preview"), bad.alias("parse_error"), "failed",
    )


def scan_counts(rows: DataFrame, **settings) -> DataFrame:
    """F14's totals a file: rows scanned, failed, with warnings."""
    found = scan(rows, **settings).groupBy("source_file").agg(F.count_if("failed").alias("failed"), F.count_if(~F.col("failed")).alias("warned"))
    total = rows.groupBy(F.col("_source_file").alias("source_file")).agg(F.count("*").alias("scanned"))
    return total.join(found, "source_file", "left").select("source_file", "scanned", F.coalesce("failed", F.lit(0)).alias("failed"), F.coalesce("warned", F.lit(0)).alias("warned"))


def failure_keys(failures: DataFrame) -> DataFrame:
    """(source_file, line_no) of rows that block. Severity is the row's own, else the highest of its findings; where
    nothing is said the row counts as blocking. Rows without a key are left out."""
    own = F.lower("max_severity") if "max_severity" in failures.columns else F.lit(None).cast("string")
    said = F.lit(None).cast("string")
    if "safety" in failures.columns and "severity" in failures.schema["safety"].dataType["findings"].dataType.elementType.names:
        levels = F.transform(F.filter("safety.findings", lambda f: f["severity"].isNotNull()), lambda f: F.lower(f["severity"]))
        said = F.when(F.array_contains(levels, "block"), "block").when(F.size(levels) > 0, "warn")
    rows = failures.where(F.coalesce(own, said, F.lit("block")) == "block")
    return rows.select(F.col("source_file").cast("string").alias("source_file"), F.expr("try_cast(line_no as bigint)").alias("line_no")).where("source_file is not null and line_no is not null").distinct()


def clean_sessions(turns: DataFrame, keys: DataFrame, session: list[str]) -> DataFrame:
    """F16: turns of the sessions in which no row failed. Only the sessions' names are joined back, never their texts."""
    own = turns.select(*session, F.coalesce("_source_file", "source_path").alias("source_file"), F.coalesce("_line_no", "line_no").alias("line_no"))
    bad = own.join(keys, ["source_file", "line_no"], "left_semi").select(*[F.col(c).alias(f"bad_{c}") for c in session]).distinct()
    same = F.lit(True)
    for c in session:
        same = same & F.col(c).eqNullSafe(F.col(f"bad_{c}"))
    return turns.join(bad, same, "left_anti")


def window_findings(text: Column, diff: Column, *, policy: Policy = Policy(), personal: bool = False, enabled: bool = True) -> Column:
    """findings that count in a window's joined text; of a diff the added lines, and none if there are none."""
    if not enabled:
        return F.filter(safety.judged(safety.nothing(), policy), lambda f: F.lit(False))
    added = added_lines(text)
    body = F.when(diff, added).otherwise(text)
    return safety.judged(F.when(diff & (strip(added) == ""), safety.nothing()).otherwise(safety.scan_text(body, with_personal=personal, policy=policy)), policy)


def scan_mode(stage: str = "scan", *, off: bool = False, asked: str | None = None, environment: str | None = None, config: dict | None = None, pattern: str | None = None, honours_failures: bool = True) -> str:
    """how personal data is looked for: by command, environment, profile of the file pattern (scan only), configuration, default."""
    def valid(mode) -> str:
        mode = str(mode).strip().lower()
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}: one of {', '.join(MODES)}")
        return mode

    if off:
        return "off"
    for choice in (asked, (environment or "").strip()):
        if choice:
            return valid(choice)
    own = (config or {}).get(stage) or {}
    if stage == "scan":
        for name, profile in (own.get("profiles") or {}).items():
            shape = profile.get("glob") or profile.get("match")
            if pattern and ((shape and fnmatch.fnmatch(pattern.lower(), str(shape).lower())) or name.lower() in pattern.lower()):
                if profile.get("presidio_mode"):
                    return valid(profile["presidio_mode"])
                break
        return valid(own.get("presidio_mode") or "pattern")
    chosen = own.get("presidio_mode")
    if chosen is not None:
        return "off" if chosen is False else valid(chosen)
    if honours_failures:
        return "off"
    return valid(((config or {}).get("scan") or {}).get("presidio_mode") or "off")


def external_scan(rows: DataFrame, key: list[str], text: str = "text", *, binary: str = "gitleaks", chunk: int = 200_000, overlap: int = 4_000, seconds: int = 600) -> DataFrame:
    """key columns and `external` (findings) by a secret scanner that is installed on the executors.

    Each batch is written as one file. A text of any length gives a line for each `chunk` characters and the first `overlap`
    of the next ones (line breaks become spaces), and a map from lines to rows and offsets tells what the report's line and
    column numbers mean. A finding counts in the line in whose own part it starts, so none counts twice; one longer than
    `overlap` may be cut. Without the program there are no findings; where a run fails every row of its batch says so
    (kind scan_error)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*key).schema) + f", external {safety.FINDINGS}"

    breaks = dict.fromkeys([*range(0x0A, 0x0E), *range(0x1C, 0x1F), 0x85, 0x2028, 0x2029], " ")

    def lines_of(texts):
        for row, t in enumerate(texts):
            flat = (t or "").translate(breaks)
            for at in range(0, max(1, len(flat)), chunk):
                yield row, at, flat[at : at + chunk + overlap]

    def report_of(folder, program, texts):
        import json
        import subprocess

        places = []
        with open(f"{folder}/rows.txt", "w", encoding="utf-8") as f:
            for row, at, line in lines_of(texts):
                places.append((row, at))
                f.write(line + "\n")
        subprocess.run([program, "detect", "--no-git", "--source", f"{folder}/rows.txt", "--report-format", "json", "--report-path", f"{folder}/report.json", "--exit-code", "0"], capture_output=True, timeout=seconds, check=True)
        with open(f"{folder}/report.json", encoding="utf-8") as f:
            return places, json.load(f) or []

    def run(frames):
        import shutil
        import subprocess
        import tempfile

        program = shutil.which(binary)
        for frame in frames:
            out = [[] for _ in range(len(frame))]
            if program and len(frame):
                try:
                    with tempfile.TemporaryDirectory() as folder:
                        places, hits = report_of(folder, program, frame[text])
                    for hit in hits:
                        line = int(hit.get("StartLine", 0)) - 1
                        if 0 <= line < len(places):
                            row, at = places[line]
                            column = max(0, int(hit.get("StartColumn") or 1) - 1)
                            if column < chunk:
                                match, rule = str(hit.get("Match") or hit.get("Secret") or ""), str(hit.get("RuleID") or "leak")
                                place = (at + column, at + column + len(match)) if hit.get("StartColumn") else (None, None)
                                out[row].append(("gitleaks", rule, f"{rule}:{match}"[:80], *place, match))
                except (subprocess.SubprocessError, OSError, ValueError):
                    out = [[("gitleaks", "scan_error", "scan failed", None, None, None)] for _ in out]
            frame = frame[key].copy()
            names = ("source", "kind", "detail", "start", "end", "match")
            frame["external"] = [[dict(zip(names, x)) for x in own] for own in out]
            yield frame

    return rows.select(*key, text).mapInPandas(run, schema)


def metrics(rows: DataFrame, label: str | None = None) -> DataFrame:
    """confusion counts, precision, recall and F1 (0 on an empty denominator) of (predicted, expected), overall and by label."""
    counts = [F.count_if(F.expr(e)).alias(n) for n, e in (("tp", "predicted and expected"), ("fp", "predicted and not expected"), ("fn", "not predicted and expected"), ("tn", "not predicted and not expected"))]
    if label:
        g = rows.groupingSets([[], [F.col(label)]], F.col(label)).agg(F.grouping(label).alias("all_"), *counts).withColumn("label", F.when(F.col("all_") == 1, "overall").otherwise(F.col(label)))
    else:
        g = rows.agg(*counts).withColumn("label", F.lit("overall"))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    prec, recall = share(tp, tp + fp), share(tp, tp + fn)
    return g.select("label", "tp", "fp", "fn", "tn", prec.alias("prec"), recall.alias("recall"), share(2 * prec * recall, prec + recall).alias("f1"))


def evaluate_cases(cases: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """F19 over labelled cases (text, expect_block, label, mode): diffs by their added lines, others by the secret shapes only."""
    diff = safety.is_diff_case(F.col("mode"), F.col("label"))
    rated = safety.judged(F.when(diff, safety.scan_diff(F.col("text"))).otherwise(safety.scan_text(F.col("text"))), policy)
    hit = safety.should_quarantine(safety.blocks(rated), safety.warns(rated), policy.quarantine)
    return metrics(cases.select("label", hit.alias("predicted"), F.col("expect_block").alias("expected")), "label")
