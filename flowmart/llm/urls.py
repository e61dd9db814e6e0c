"""Verdicts on URLs: host and path rules, then trust and distrust propagated over the graph of host links."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from flowmart.llm.common import shared_dir, stored

#: (verdict, rule); a rule is a host and the start of a path.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
#: Part of a host's score that follows its links, sum of changes at which rounds end, and rounds beyond those that must suffice.
DAMPING, CHANGE, MARGIN = 0.85, 1e-6, 10
#: Part of a host's trust and distrust together from which its pages are blocked.
BLOCK_FROM = 0.6


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host and path together) that fits, else nulls. A rule fits its host and all subdomains, if the path starts with its path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, n): how many links lead from the pages of one host to another host; links within a host are not counted."""
    target = r"(?is)<(?:a|area|link|iframe|form)\b[^>]*?\s(?:href|src|action)\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s>]+)"
    links = pages.select(host_of(F.col(f"`{url}`")).alias("src"), F.explode(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(target), 1)).alias("dst"))
    lower = F.translate("dst", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return links.select("src", lower.alias("dst")).where("src != '' and src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def page_rank(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, change: float = CHANGE, rounds: int | None = None) -> DataFrame:
    """(host, rank): personalised PageRank over ``edges`` (src, dst, n) from ``seeds`` (host, weight).

    A walk restarts at the seeds by their weights; what reaches a host without links restarts as well. Ranks sum to the
    weights' sum. They are a written table each round, the next round sees only that, and rounds end when the ranks change
    by less than the part ``change`` of their sum. Changes shrink by ``damping`` a round from at most twice the sum, so that a number
    of rounds is certain to do; past it (or past ``rounds``) the ranks are not taken and an error is raised. Hosts that no
    walk has reached by then have no row: together they hold less than ``change`` / (1 - ``damping``) of the sum.
    No seed gives no rows. Hosts with very many links are split where they are joined and pre-summed where they are grouped.
    """
    spark = edges.sparkSession
    total = seeds.agg(F.sum("weight").alias("t")).first()["t"]
    if not total:
        return seeds.select("host", F.lit(0.0).alias("rank")).limit(0)
    start = stored(seeds.select("host", F.col("weight").cast("double").alias("start")))
    outs = stored(edges.groupBy("src").agg(F.sum("n").alias("outs")))
    parts = stored(edges.join(outs, "src").select("src", "dst", (F.col("n") / F.col("outs")).alias("part")))
    ranks = start.select("host", F.col("start").alias("rank"))
    for _ in range(math.ceil(math.log(change / 2) / math.log(damping)) + MARGIN if rounds is None else rounds):
        sent = ranks.join(parts, ranks["host"] == parts["src"]).select(F.col("dst").alias("host"), (F.col("rank") * F.col("part") * damping).alias("got"))
        passed = stored(sent.groupBy("host").agg(F.sum("got").alias("got")))
        again = 1.0 - (passed.agg(F.sum("got").alias("s")).first()["s"] or 0.0) / total
        path, seen = shared_dir(spark, "ranks"), Observation()
        new = passed.join(start, "host", "full").select("host", (F.coalesce("got", F.lit(0.0)) + F.coalesce("start", F.lit(0.0)) * again).alias("rank"))
        moved = F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0)))
        new.join(ranks.select("host", F.col("rank").alias("old")), "host", "left").observe(seen, F.sum(moved).alias("moved")).select("host", "rank").write.parquet(path)
        ranks = spark.read.schema("host string, rank double").parquet(path)
        if (seen.get["moved"] or 0.0) < change * total:
            return ranks
    raise RuntimeError("the ranks still change after the rounds that must suffice")


def host_scores(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, allowed, blocked: numbers of pages that rules decide).

    Trust flows from allowed hosts along links, distrust from blocked hosts against them: to link to a bad host is
    suspect, to be linked from one is not. A page that a rule decides counts one.
    """
    trust = page_rank(edges, seeds.where("allowed > 0").select("host", F.col("allowed").alias("weight")))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = page_rank(back, seeds.where("blocked > 0").select("host", F.col("blocked").alias("weight")))
    return trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host", "full").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, block_from: float = BLOCK_FROM,
          key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, trust, distrust.

    The longest rule that fits decides; else the host's scores do: distrust of at least ``block_from`` of both together blocks, and
    a host that neither reaches, an empty one included, is allowed. Null urls have an empty host and path; null html has no
    links. Repeated rows give repeated rows; an empty table gives none; other columns are not read.
    """
    own = F.col(f"`{url}`")
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), host_of(own).alias("host"), path_of(own).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = rows.withColumns({"rule": rule, "ruled": verdict})
    edges = stored(host_links(pages, url, html))
    seeds = stored(ruled.where("host != ''").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    ))
    scores = stored(host_scores(seeds, edges))
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= block_from * (F.col("trust") + F.col("distrust")))
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
