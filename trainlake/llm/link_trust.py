"""Operator 8: URL filters with rules, and trust over the link graph for urls that no rule decides.

Hosts are nodes; a link in a page's html to another host is an edge (its weight the number of such links). Trust is
personalised PageRank over the edges from the hosts of allowed pages; distrust is the same over the reversed edges from
the hosts of blocked pages: who links to a blocked host inherits distrust. A host is blocked if its distrust exceeds its
trust by `margin`. All of it is DataFrame work; ranks are sums pre-aggregated before each shuffle.

Defined results: null urls and urls without :// have empty host and path, match no rule and are allowed; a host without
links and seeds has no rank and is allowed; ties are allowed; repeated rows are judged alike; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: (host and path prefix, verdict)
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def host_of(url):
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), *LOWER), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # later ones win
        h, slash, rest = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def rank(edges: DataFrame, seeds: DataFrame, *, damping: float = 0.85, rounds: int = 100, tolerance: float = 1e-6) -> DataFrame:
    """Personalised PageRank (host, rank) over edges (src, dst, n) from seeds (host, w; the w sum to 1). A host without out-links returns its rank to the seeds.

    Runs until a round changes the ranks by less than `tolerance` in sum (at damping 0.85 after at most 90 rounds)."""
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    share = cut(edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("p")))
    seeds = cut(seeds)
    now = seeds.select("host", F.col("w").alias("rank"))
    if share.isEmpty():
        return now
    for _ in range(rounds):
        moved = now.join(share, now.host == share.src).groupBy(F.col("dst").alias("host")).agg((damping * F.sum(F.col("rank") * F.col("p"))).alias("rank"))
        back = 1 - (moved.agg(F.sum("rank")).first()[0] or 0.0)
        new = cut(moved.unionByName(seeds.select("host", (F.col("w") * back).alias("rank"))).groupBy("host").agg(F.sum("rank").alias("rank")))
        change = new.withColumnRenamed("rank", "new").join(now, "host", "full").agg(F.sum(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("rank", F.lit(0.0))))).first()[0]
        now = new
        if change is None or change < tolerance:
            break
    else:
        raise RuntimeError(f"ranks did not settle in {rounds} rounds")
    return now


def judge(pages: DataFrame, *, rules=RULES, margin: float = 0.0) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row."""
    url = pages["url"].cast("string")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string").alias("html"))
    base = base.withColumn("rule", rule).withColumn("by_rule", verdict)
    # links with a host of their own: scheme://host… or //host…
    target = F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s>]+)"), F.lit(1)))
    linked = base.where("host != ''").select(F.col("host").alias("src"), target.alias("t")).select("src", F.translate("t", *LOWER).alias("dst"))
    edges = cut(linked.where("src != dst and dst != ''").groupBy("src", "dst").agg(F.count("*").alias("n")))
    seen = cut(base.where("host != ''").groupBy("host").agg(F.sum((F.col("by_rule") == "allow").cast("long")).alias("good"), F.sum((F.col("by_rule") == "block").cast("long")).alias("bad")))
    total = seen.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()

    def seeds(column: str, all_: int) -> DataFrame:
        return seen.where(F.col(column) > 0).select("host", (F.col(column) / F.lit(float(all_ or 1))).alias("w"))

    trust = rank(edges, seeds("good", total.good)).withColumnRenamed("rank", "trust")
    turned = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = rank(turned, seeds("bad", total.bad)).withColumnRenamed("rank", "distrust")
    ranks = trust.join(distrust, "host", "full")
    out = base.drop("html").join(ranks, "host", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    method = F.when(zero("distrust") - zero("trust") > margin, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), zero("trust").alias("trust"), zero("distrust").alias("distrust"))
