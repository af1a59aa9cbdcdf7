"""URL filters: rules by host and path, and link-graph propagation for the urls without a rule.

Hosts are the nodes; an absolute link in a page's html is an edge from the
page's host to the linked one, counted once per page; a sub-domain and its
parent domain are linked both ways with the weight of one link. Trust flows
forward by personalised PageRank from every host with a page that the rules
allow, weighted by the share of such pages; distrust flows backward, over
reversed edges, from every host with a page that they block, likewise. A host
whose distrust is above ``threshold`` times the mean score and above its trust
is blocked.

The work is on distinct hosts and host pairs: pages are summed up to those
first, so a host with a third of all pages is one row. Every few rounds the
scores are written to the shared folder, which cuts the plan.

Defined results: a url that is null or without ``://`` has an empty host and
path, no rule, and is allowed; null html has no links; repeated rows give
repeated rows and count as more pages; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playgrid.llm.common import written

#: The rules as (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

UPPER, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER_AZ)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and verdict (null: none)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def parent_of(host: Column) -> Column:
    """The domain above a host, down to two labels; null above those."""
    rest = F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1)
    return F.when(rest != "", rest)


def edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight of the host graph; ``pages`` has host and html."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")),
                                 F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']?((?:https?:)?//[^\"'\s>]+)"), F.lit(1))
    targets = F.array_distinct(F.transform(links, lambda u: host_of(F.when(u.startswith("//"), F.concat(F.lit("http:"), u)).otherwise(u))))
    linked = (pages.filter(F.col("host") != "").select(F.col("host").alias("src"), F.explode(targets).alias("dst"))
              .filter((F.col("dst") != "") & (F.col("dst") != F.col("src")))
              .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))
    hosts = pages.filter(F.col("host") != "").select("host").distinct()
    up = hosts.select(F.col("host").alias("src"), parent_of(F.col("host")).alias("dst")).dropna()
    family = up.union(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct().withColumn("weight", F.lit(1.0))
    return linked.union(family).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def page_rank(links: DataFrame, seeds: DataFrame, rounds: int = 12, damping: float = 0.85, cut: int = 4) -> DataFrame:
    """host, score: personalised PageRank over src, dst, weight from seeds (host, weight); scores sum up to 1 at most."""
    total = seeds.agg(F.sum("weight")).first()[0]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("score"))
    start = seeds.select("host", (F.col("weight") / F.lit(total)).alias("seed"))
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    shares = written(links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("part")), "links")
    score = start.select("host", F.col("seed").alias("score"))
    for k in range(1, rounds + 1):
        moved = shares.join(score, shares["src"] == score["host"]).select(
            F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("part")).alias("score"))
        kept = start.select("host", (F.lit(1 - damping) * F.col("seed")).alias("score"))
        score = moved.union(kept).groupBy("host").agg(F.sum("score").alias("score"))
        if k % cut == 0 or k == rounds:
            score = written(score, "rank")
    return score


def host_verdicts(pages: DataFrame, rules=RULES, threshold: float = 1.0) -> DataFrame:
    """host, trust, distrust, blocked for every host of ``pages`` (host, path, html)."""
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    per_host = written(pages.filter(F.col("host") != "").groupBy("host").agg(
        F.avg((F.coalesce(verdict, F.lit("")) == "allow").cast("double")).alias("allowed"),
        F.avg((F.coalesce(verdict, F.lit("")) == "block").cast("double")).alias("refused")), "hosts")
    links = written(edges(pages), "edges")
    back = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    seeds = lambda share: per_host.filter(F.col(share) > 0).select("host", F.col(share).alias("weight"))
    trust = page_rank(links, seeds("allowed")).withColumnRenamed("score", "trust")
    distrust = page_rank(back, seeds("refused")).withColumnRenamed("score", "distrust")
    both = per_host.select("host").join(trust, "host", "left").join(distrust, "host", "left").fillna(0.0)
    mean = 1.0 / max(1, per_host.count())
    return both.withColumn("blocked", (F.col("distrust") > threshold * mean) & (F.col("distrust") > F.col("trust")))


def judge(pages: DataFrame, rules=RULES, threshold: float = 1.0) -> DataFrame:
    """page_id, host, path, rule, verdict (and the host's trust and distrust) for every row of ``pages``."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    hosts = host_verdicts(parsed, rules, threshold)
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return (parsed.drop("html").join(hosts, "host", "left")
            .select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
