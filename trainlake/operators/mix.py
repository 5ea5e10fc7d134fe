"""Mix policy, manifest, extract, samples, splits, packing and token audit."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import TRAIN_MARKER, curated_id, truncate
from ..functions.variant import strip
from .numbering import cut, numbered


@dataclass(frozen=True)
class Policy:
    """M3: how personal and public rows are mixed."""

    prioritize_personal: bool = True
    ratio: float = 1.0
    cap: int | None = None
    priority: tuple[str, ...] = ()
    weights: tuple[float, float] = (1.0, 0.25)


def quota(personal: int, public: int, ratio: float, cap: int | None) -> int:
    """M3: public rows allowed beside the personal ones (float64 arithmetic on purpose). Without personal rows a cap of 0 means no cap."""
    if not personal:
        return min(cap or public, public)
    if ratio >= 0.999 or ratio <= 0:
        n = 0
    else:
        n = int(personal * (1 - ratio) / ratio)
    return max(0, min(n, public, cap if cap is not None else public))


def place_of(dataset: Column, priority: tuple[str, ...]) -> Column:
    """The dataset's place in the list of priorities; others come after all."""
    return reduce(lambda a, x: F.when(dataset == x[1], F.lit(x[0])).otherwise(a), list(enumerate(priority))[::-1], F.lit(len(priority)))


def mix(rows: DataFrame, *, ratio: float = 0.9, cap: int | None = None, weights: tuple[float, float] = (1.0, 0.25), priority: tuple[str, ...] = (), prioritize_personal: bool = True, exclude_public: bool = False, limit: int | None = None, id: str = "curated_id") -> DataFrame:
    """M3: personal rows (in order of source and id), then public ones (by priority and id) up to the quota; sort_order and sample_weight.

    Without priority of personal rows all rows come in order of kind, source and id. A limit never drops personal rows
    where they have priority. Only two counts reach the driver; the quota is a top-k, not a sort of all public rows."""
    personal, public = rows.where("data_source = 'personal'"), rows.where("data_source = 'public'")
    kind = F.when(F.col("data_source") == "personal", 0).otherwise(1)
    weight = F.when(F.col("data_source") == "personal", weights[0]).otherwise(weights[1])
    own = ("harness", id)
    if exclude_public:
        both, order = personal, (kind, *own)
    elif not prioritize_personal:
        both, order = personal.unionByName(public), (kind, *own)
    else:
        counts = {r.data_source: r["n"] for r in rows.groupBy("data_source").agg(F.count("*").alias("n")).collect()}
        mine, n = counts.get("personal", 0), quota(counts.get("personal", 0), counts.get("public", 0), ratio, cap)
        if limit is not None:
            n = min(n, max(0, limit - mine)) if mine else min(n, limit)
        by = [place_of(F.coalesce("public_dataset", F.lit("")), priority)] if priority else []
        both = personal.unionByName(public.orderBy(*by, id).limit(n))
        order = (kind, *[F.when(kind == 1, b).otherwise(0) for b in by], F.when(kind == 0, F.col("harness")), id)
    if limit is not None and (exclude_public or not prioritize_personal):
        keep = prioritize_personal  # personal rows alone are never cut while they have priority
        both = both if keep else both.orderBy(*order).limit(limit)
    return numbered(both, *order).withColumn("sample_weight", weight)


def backfill(rows: DataFrame) -> DataFrame:
    """M6: rows of public sources are marked so, and named after their source where they have no dataset. The underscore of the pattern stands for any character."""
    public = F.col("harness").like("public_%")
    named = F.coalesce(F.nullif("public_dataset", F.lit("")), F.replace(F.col("harness"), F.lit("public_"), F.lit("")))
    stale = public & ((F.col("data_source") != "public") | F.col("public_dataset").isNull() | (F.col("public_dataset") == ""))
    return rows.withColumn("public_dataset", F.when(stale, named).otherwise(F.col("public_dataset"))).withColumn("data_source", F.when(stale, "public").otherwise(F.col("data_source")))


def manifest(rows: DataFrame, manifest_id: str, *, tier: int = 1, policy: Policy = Policy(), exclude_public: bool = False, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """M4: (manifest rows, one row of criteria with the ratio reached) from the index of curated rows, after M6."""
    usable = backfill(rows).where((F.col("train_tier") == tier) & (F.col("safety_ok") == 1))
    mixed = mix(usable, ratio=policy.ratio, cap=policy.cap, weights=policy.weights, priority=policy.priority, prioritize_personal=policy.prioritize_personal, exclude_public=exclude_public, limit=limit)
    out = mixed.select(F.lit(manifest_id).alias("manifest_id"), "curated_id", "sort_order", "sample_weight", "data_source")
    mine, n = F.count_if(F.col("data_source") == "personal"), F.count("*")
    share = F.round(F.coalesce(F.try_divide(mine.cast("double"), n), F.lit(0.0)), 4)
    counts = out.agg(mine.alias("personal_count"), (n - mine).alias("public_count"), n.alias("row_count"), share.alias("personal_ratio_actual"))
    fixed = {"tier": tier, "prioritize_personal": policy.prioritize_personal, "personal_ratio_target": policy.ratio, "public_cap": policy.cap, "limit": limit, "exclude_public": exclude_public, "personal_sample_weight": policy.weights[0], "public_sample_weight": policy.weights[1]}
    fields = [F.lit(v).alias(k) for k, v in fixed.items()] + [F.array(*map(F.lit, policy.priority)).cast("array<string>").alias("public_dataset_priority")]
    criteria = counts.select(F.lit(manifest_id).alias("manifest_id"), "row_count", F.to_json(F.struct(*fields, "personal_count", "public_count", "row_count", "personal_ratio_actual")).alias("criteria_json"))
    return out.drop("data_source"), criteria


def pointers(manifest_rows: DataFrame, curated: DataFrame, manifest_id: str) -> DataFrame:
    """M5: a manifest's rows with where their text lies, in order."""
    own = manifest_rows.where(F.col("manifest_id") == manifest_id)
    return own.join(curated.select("curated_id", "source_file", "source_line", "harness", "data_source", "public_dataset"), "curated_id").orderBy("sort_order")


def extract(points: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M7: (training rows, pointers whose line is missing). lines: source_file, source_line, messages, meta (a map).

    The weight is set; source of data, dataset and harness only where the row has none."""
    found = points.withColumnsRenamed({c: f"{c}_" for c in ("harness", "data_source", "public_dataset")}).join(lines, ["source_file", "source_line"])
    fill = F.map_filter(F.create_map(*[x for c in ("data_source", "public_dataset", "harness") for x in (F.lit(c), F.col(f"{c}_"))]), lambda k, v: v.isNotNull() & ~F.map_contains_key("meta", k))
    weight = F.create_map(F.lit("sample_weight"), F.col("sample_weight").cast("string"))
    rest = F.map_filter("meta", lambda k, _: k != "sample_weight")
    rows = found.select("curated_id", "sort_order", "messages", F.map_concat(rest, fill, weight).alias("meta"))
    return rows, points.join(lines.select("source_file", "source_line"), ["source_file", "source_line"], "left_anti")


def index_rows(examples: DataFrame, lines: Column | str = "source_line") -> DataFrame:
    """M8: one row of metadata an example."""
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(F.coalesce(m.content, F.lit(""))))
    harness = F.coalesce(F.nullif("meta.harness", F.lit("")), F.lit("unknown"))
    source = F.coalesce(F.nullif("meta.data_source", F.lit("")), F.when(harness.startswith("public_"), "public").otherwise("personal"))
    return examples.select(
        curated_id(F.col("source_file"), F.col("source_line")).alias("curated_id"), "source_file", "source_line", harness.alias("harness"), source.alias("data_source"), "meta.public_dataset", "meta.project", "meta.session_id", "meta.chunk_index", "meta.chunk_count",
        F.size("messages").alias("message_count"), chars.alias("char_count"), "meta.train_tier", F.col("meta.safety_ok").cast("int").alias("safety_ok"), F.to_json("meta.style_tags").alias("style_tags"), "meta.tone",
    )


def train_stats(rows: DataFrame) -> DataFrame:
    """M9: rows, personal and public ones, share of personal ones and mean weight (rounded to 4), by data_source and sample_weight."""
    n, mine = F.count("*"), F.count_if(F.col("data_source") != "public")
    return rows.agg(n.alias("total"), mine.alias("personal"), (n - mine).alias("public"), F.round(F.coalesce(F.try_divide(mine.cast("double"), n), F.lit(0.0)), 4).alias("personal_ratio"), F.round(F.coalesce(F.avg("sample_weight"), F.lit(0.0)), 4).alias("mean_sample_weight"))


def source_of(data_source: Column, harness: Column) -> Column:
    return F.coalesce(F.nullif(data_source, F.lit("")), F.when(harness.startswith("public_"), "public").otherwise("personal"))


def train_set(rows: DataFrame, *, most: int | None = None, cap: int | None = None, order: str | None = None) -> DataFrame:
    """Messages (role, content: known roles, stripped, not empty), data_source, sample_weight (at least 0.05), of rows with two messages or more and an assistant's among them."""
    said = F.filter(F.transform("messages", lambda m: F.struct(m["role"].alias("role"), strip(F.coalesce(m["content"], F.lit(""))).alias("content"))), lambda m: m["role"].isin("user", "assistant", "system") & (m["content"] != ""))
    out = rows.withColumn("messages", said).where((F.size("messages") >= 2) & F.exists("messages", lambda m: m["role"] == "assistant"))
    if cap:
        out = out.withColumn("messages", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), truncate(m["content"], cap, TRAIN_MARKER).alias("content"))))
    out = out.withColumn("data_source", source_of(F.col("data_source"), F.col("harness"))).withColumn("sample_weight", F.greatest(F.coalesce("sample_weight", F.lit(1.0)), F.lit(0.05)))
    return out if most is None else (out.orderBy(order) if order else out).limit(most)


def weights_of(rows: DataFrame, weights: tuple[float, float] = (1.0, 0.25)) -> Column:
    """The row's own weight (at least 0.05), else that of its source of data, else the personal one."""
    if "sample_weight" in rows.columns:
        return F.greatest(F.col("sample_weight").cast("double"), F.lit(0.05))
    return F.when(F.col("data_source") == "public", weights[1]).otherwise(weights[0]) if "data_source" in rows.columns else F.lit(weights[0])


def keep_assistant(rows: DataFrame, longest: int) -> DataFrame:
    """The last `longest` tokens of a conversation (column tokens: array of struct(id, assistant)); rows without an assistant's token among them go."""
    cut = rows.withColumn("tokens", F.when(F.size("tokens") > longest, F.slice("tokens", -longest, longest)).otherwise(F.col("tokens")))
    return cut.where(F.exists("tokens", lambda t: t["assistant"]))


def word_tokens(messages: Column) -> Column:
    """Words as tokens of a conversation, where no tokenizer is given: struct(id, assistant)."""
    return F.flatten(F.transform(messages, lambda m: F.transform(F.filter(F.split(m["content"], r"\s+"), lambda w: w != ""), lambda w: F.struct(F.xxhash64(w).alias("id"), (m["role"] == "assistant").alias("assistant")))))


def hash_rank(rows: DataFrame, key: str, seed: str) -> Column:
    """What seeded draws go by: a hash of seed and key. It replaces a random generator's sequence, so samples differ from one but repeat."""
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def stratified(rows: DataFrame, stratum: str, key: str, n: int, seed: str = "s") -> DataFrame:
    """n rows of each stratum, chosen by a hash of the key."""
    w = Window.partitionBy(stratum).orderBy(hash_rank(rows, key, seed), key)
    return rows.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= n)


def audit_sample(rows: DataFrame, stratum: str, key: str, n: int = 50, seed: str = "7") -> DataFrame:
    """M2: n rows, an equal share (at least one) of each stratum, topped up from the rest by the same draw. More strata than n: the first ones in order."""
    rows = rows.withColumn("stratum_", F.coalesce(F.col(stratum).cast("string"), F.lit("unknown")))
    strata = rows.select("stratum_").distinct().count()
    per = max(1, n // max(1, strata))
    # WindowGroupLimit keeps at most n rows a stratum and task before the shuffle
    w = Window.partitionBy("stratum_").orderBy(hash_rank(rows, key, seed), key)
    ranked = rows.withColumn("nth_", F.row_number().over(w)).where(F.col("nth_") <= n)
    first = F.col("nth_") <= per
    return ranked.orderBy(F.when(first, 0).otherwise(1), F.when(first, F.col("stratum_")), F.when(~first, hash_rank(rows, key, seed)), "nth_", key).limit(n).drop("nth_", "stratum_")


def audit_totals(rated: DataFrame) -> DataFrame:
    """Rows with blocking findings, with warnings, to quarantine, and findings in all (columns block_count, warn_count, quarantine)."""
    return rated.agg(F.count("*").alias("rows"), F.count_if("quarantine").alias("rows_quarantine"), F.count_if(F.col("block_count") > 0).alias("rows_with_block"), F.count_if(F.col("warn_count") > 0).alias("rows_with_warn"), F.coalesce(F.sum("block_count"), F.lit(0)).alias("block_findings"), F.coalesce(F.sum("warn_count"), F.lit(0)).alias("warn_findings"))


def replay(rows: DataFrame, key: str, *, target: int = 300, fraction: float = 0.25, tier2: bool = True, seed: str = "42") -> DataFrame:
    """M1: all tier-2 rows, and tier-1 rows drawn by hash up to the target (a fraction of them at most); marked as replay."""
    counts = {r.train_tier: r["n"] for r in rows.groupBy("train_tier").agg(F.count("*").alias("n")).collect()}
    second = counts.get(2, 0) if tier2 else 0
    n = min(max(0, target - second), int(counts.get(1, 0) * fraction), counts.get(1, 0))
    drawn = rows.where("train_tier = 1").orderBy(hash_rank(rows, key, seed), key).limit(n)
    return (rows.where("train_tier = 2").unionByName(drawn) if tier2 else drawn).withColumn("replay_stratum", F.lit(True))


def kth_each(rows: DataFrame, k: DataFrame, *, bits: int = 60, digit: int = 15) -> DataFrame:
    """by_, kth_, rest_: the k_-th smallest value_ of each by_, and how many of the rows with just that value are among the first k_.

    rows: by_ and value_ (0 <= value_ < 2^bits); k: by_ and k_ (a row a stratum, 1 <= k_ <= its rows). Digits are counted from the
    top, so no stratum is sorted: a count holds at most 2^digit rows a stratum."""
    state = k.select("by_", F.col("k_").alias("rest_"), F.lit(0).cast("long").alias("kth_"))
    for shift in range(bits - digit, -1, -digit):
        open_ = rows.join(state.select("by_", "kth_"), "by_").where(F.shiftright("value_", shift + digit) == F.shiftright("kth_", shift + digit))
        counts = open_.groupBy("by_", F.shiftright(F.col("value_") - F.col("kth_"), shift).alias("d_")).agg(F.count("*").alias("n_"))
        upto = F.sum("n_").over(Window.partitionBy("by_").orderBy("d_"))
        found = counts.withColumn("upto_", upto).join(state, "by_").where((F.col("upto_") >= F.col("rest_")) & (F.col("upto_") - F.col("n_") < F.col("rest_")))
        state = cut(found.select("by_", (F.col("rest_") - F.col("upto_") + F.col("n_")).alias("rest_"), (F.col("kth_") + F.shiftleft(F.col("d_"), shift)).alias("kth_")))
    return state


def holdout(rows: DataFrame, key: str, *, ratio: float = 0.1, stratum: str | None = "data_source", seed: str = "42", least: int = 20, least_stratum: int = 8) -> DataFrame:
    """Column split (train or eval): of each stratum of 8 rows or more the ceiling of its share, drawn by hash; all train below 20 rows.

    A row's draw (60 bits of its hash) is compared with the k-th smallest of its stratum, which is found by counting digits
    of keys; no stratum is ranked in one task. Only rows that share the k-th draw itself are ranked, by whole hash and key."""
    total = rows.count()
    if ratio <= 0 or total < least:
        return rows.withColumn("split", F.lit("train"))
    by = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    drawn = rows.withColumns({"by_": by, "hash_": hash_rank(rows, key, seed)}).withColumn("value_", F.conv(F.left("hash_", F.lit(15)), 16, 10).cast("long"))
    few = F.lit(least_stratum if stratum else 0)
    sizes = rows.groupBy(by.alias("by_")).agg(F.count("*").alias("n_")).where(F.col("n_") >= few).select("by_", F.ceil(F.col("n_") * F.lit(ratio)).cast("long").alias("k_"))
    edge = kth_each(drawn.select("by_", F.coalesce("value_", F.lit(0)).alias("value_")), sizes)
    placed = drawn.withColumn("value_", F.coalesce("value_", F.lit(0))).join(edge, "by_", "left")
    same = F.col("value_").eqNullSafe(F.col("kth_"))
    inside = placed.where(~same).withColumn("split", F.when(F.col("value_") < F.col("kth_"), "eval").otherwise("train"))
    nth = F.row_number().over(Window.partitionBy("by_", "value_").orderBy("hash_", key))
    on_edge = placed.where(same).withColumn("nth_", nth).withColumn("split", F.when(F.col("nth_") <= F.col("rest_"), "eval").otherwise("train")).drop("nth_")
    return inside.unionByName(on_edge).select(*rows.columns, "split")


def best_fit(counts: list[tuple[int, int]], size: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit-decreasing bins of `counts` (length from 1, how many; longest first), worked out for all rows of a length at once.

    Returns (length, first rank, rows, first bin, rows a bin, offset) pieces: row number t of a piece goes to bin
    first + t // rows a bin, at offset + (t % rows a bin) * length; and the number of bins. Of bins with equal room the
    first comes first, as if rows were placed one by one."""
    from heapq import heappop, heappush

    room: dict[int, list[tuple[int, int]]] = {}  # room left: (first bin, bins), a heap of runs
    out, bins = [], 0
    for length, n in counts:
        at = 0
        while at < n:
            fits = [r for r in room if r >= length]
            r = min(fits, default=size)
            each = r // length
            need = -(-(n - at) // each)
            if fits:
                first, have = heappop(room[r])
                used = min(have, need)
                if used < have:
                    heappush(room[r], (first + used, have - used))
                if not room[r]:
                    del room[r]
            else:
                first, used = bins, need
                bins += need
            put = min(n - at, used * each)
            out.append((length, at, put, first, each, size - r))
            full, part = divmod(put, each)
            if full and r - each * length:
                heappush(room.setdefault(r - each * length, []), (first, full))
            if part:
                heappush(room.setdefault(r - part * length, []), (first + full, 1))
            at += put
    return out, bins


def pack(rows: DataFrame, key: str, length: str, stratum: str, *, size: int = 2048) -> DataFrame:
    """Best-fit-decreasing bins of at most `size` a stratum: key, bin, offset, used. Longer rows are cut to one bin, rows without a length lie in bin 0.

    Bins depend on how many rows have each length, so they are worked out from that histogram (at most `size` rows a
    stratum), and rows are dealt to them by their rank among equal lengths: a global order by ranges, less what comes before."""
    import pandas as pd

    slim = rows.select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("by_"), F.col(key).alias("key_"), F.least(F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0)), F.lit(size)).alias("n_"))
    filled = cut(slim.where("n_ > 0").groupBy("by_", "n_").agg(F.count("*").alias("c_")))

    def bins(frame):
        frame = frame.sort_values("n_", ascending=False)
        pieces, _ = best_fit(list(zip(frame["n_"].tolist(), frame["c_"].tolist())), size)
        return pd.DataFrame([(frame["by_"].iloc[0], *p) for p in pieces], columns=["by_", "n_", "from_", "put_", "bin_", "each_", "at_"])

    pieces = filled.groupBy("by_").applyInPandas(bins, "by_ string, n_ long, from_ long, put_ long, bin_ long, each_ long, at_ long")
    plan = pieces.groupBy("by_", "n_").agg(F.array_sort(F.collect_list(F.struct("from_", "put_", "bin_", "each_", "at_"))).alias("plan_"))
    # rows before each length in the global order; lengths come down from the longest
    sizes = filled.groupBy("by_").agg(F.sum("c_").alias("all_"))
    ahead = sizes.withColumn("ahead_", F.coalesce(F.sum("all_").over(Window.orderBy("by_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("by_", "ahead_")
    own = F.coalesce(F.sum("c_").over(Window.partitionBy("by_").orderBy(F.col("n_").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = filled.withColumn("own_", own).join(ahead, "by_").select("by_", "n_", (F.col("ahead_") + F.col("own_")).alias("start_"))
    placed = numbered(slim.where("n_ > 0"), "by_", F.col("n_").cast("long") * -1, "key_", name="nth_")
    found = placed.join(plan.join(starts, ["by_", "n_"]), ["by_", "n_"]).withColumn("rank_", F.col("nth_") - F.col("start_"))
    piece = F.get(F.filter("plan_", lambda p: (p["from_"] <= F.col("rank_")) & (F.col("rank_") < p["from_"] + p["put_"])), F.lit(0))
    found = found.select("by_", "key_", "n_", "rank_", piece.alias("p"))
    t = F.col("rank_") - F.col("p.from_")
    out = found.select("by_", "key_", (F.col("p.bin_") + F.floor(t / F.col("p.each_"))).cast("long").alias("bin"), (F.col("p.at_") + t % F.col("p.each_") * F.col("n_")).alias("offset"), F.col("n_").alias("used"))
    empty = slim.where("n_ = 0").select("by_", "key_", *[F.lit(0).cast("long").alias(c) for c in ("bin", "offset", "used")])
    return out.unionByName(empty).select(F.col("by_").alias(stratum), F.col("key_").alias(key), "bin", "offset", "used")


def weighted_draws(rows: DataFrame, key: str, weight: str, n: int, seed: int = 7) -> DataFrame:
    """N draws with replacement, each row with probability weight / total.

    Weights become integer intervals on a line; a draw falls into one. Ranges of the line are found by each range's total
    (a row a partition), then draws and rows meet by a bucket of the line, so neither side is sent to all tasks."""
    ranged = cut(rows.select(key, F.col(weight).cast("double").alias("w_")).where("w_ > 0").repartitionByRange(key).withColumn("part_", F.spark_partition_id()))
    own = Window.partitionBy("part_").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranged.withColumn("to_", F.sum("w_").over(own))
    parts = ranged.groupBy("part_").agg(F.sum("w_").alias("all_"))
    before = F.coalesce(F.sum("all_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    starts = parts.select("part_", before.alias("before_"), "all_")
    total = parts.agg(F.sum("all_")).first()[0]
    if not total:
        return rows.select(key, F.lit(0).cast("long").alias("draw")).limit(0)
    line = inside.join(F.broadcast(starts.drop("all_")), "part_").select(key, (F.col("before_") + F.col("to_") - F.col("w_")).alias("lo_"), (F.col("before_") + F.col("to_")).alias("hi_"))
    cells = max(1, min(n, 1 << 20))
    cell = lambda x: F.least(F.floor(x / F.lit(total) * cells), F.lit(cells - 1)).cast("long")
    spread = line.select("*", F.explode(F.sequence(cell(F.col("lo_")), cell(F.col("hi_")))).alias("cell_"))
    draws = rows.sparkSession.range(n).select(F.col("id").alias("draw"), (F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52)) * F.lit(total)).alias("x_"))
    return draws.withColumn("cell_", cell(F.col("x_"))).join(spread, "cell_").where("x_ >= lo_ and x_ < hi_").select("draw", key)


def recommended(p: int, *, step: int = 256, least: int = 512, cap: int = 8192, headroom: float = 1.05) -> int:
    """Length to train at, from a percentile."""
    return max(least, min(cap, -(-int(p * headroom) // step) * step))


def length_audit(rows: DataFrame, length: str, *, percentile: int = 95, cap: int = 8192, above: tuple[int, ...] = (512, 1024, 2048, 4096)) -> DataFrame:
    """Nearest-rank percentiles, the recommended length, and how many rows are longer than some lengths; zeros for no rows.

    Rows are counted by length first; what is ranked is the table of lengths, which does not grow with the rows."""
    counts = rows.select(F.col(length).cast("long").alias("n_")).where("n_ is not null").groupBy("n_").agg(F.count("*").alias("c_"))
    every = Window.orderBy("n_")
    ranked = counts.withColumns({"upto_": F.sum("c_").over(every), "all_": F.sum("c_").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    disc = lambda p: F.coalesce(F.min(F.when(F.col("upto_") * 100 >= F.col("all_") * p, F.col("n_"))), F.lit(0)).cast("long")
    many = lambda a: F.coalesce(F.sum(F.when(F.col("n_") > a, F.col("c_")).otherwise(0)), F.lit(0)).cast("long")
    got = ranked.agg(F.coalesce(F.sum("c_"), F.lit(0)).cast("long").alias("rows"), disc(50).alias("p50"), disc(95).alias("p95"), disc(99).alias("p99"), F.coalesce(F.max("n_"), F.lit(0)).cast("long").alias("longest"), disc(percentile).alias("target_"), *[many(a).alias(f"above_{a}") for a in above])
    rounded = F.ceil(F.floor(F.col("target_") * 1.05) / 256) * 256
    return got.withColumn("recommended", F.greatest(F.lit(512), F.least(F.lit(cap), rounded)).cast("long")).drop("target_")


def step_budget(*, asked: int | None = None, per_epoch: int, epochs: float, cap: int | None = None, one_epoch: bool = False, smoke: bool = False) -> int:
    """Optimiser steps."""
    if smoke:
        return 5
    if asked is not None:
        return asked
    target = per_epoch if one_epoch else int(per_epoch * epochs)
    return max(1, target if cap is None else min(target, int(cap)))


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Q9: latest row of each key of an append-only log."""
    w = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("nth", F.row_number().over(w)).where("nth = 1").drop("nth")
