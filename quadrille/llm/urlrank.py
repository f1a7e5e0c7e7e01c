"""Operator 6: URL filtering by rules and by trust that spreads over the link graph.

Rules of a host and a path fit the host and its subdomains where the URL's
path starts with the rule's; the longest wins, of equally long ones a blocking
rule. Every host that no rule decides is judged from the link graph. Edges lead
from a page's host to the hosts it links to (absolute and scheme-relative links
in the html; links within a host say nothing about others).

Trust is a personalised PageRank from hosts whose pages are allowed, each by the
share of its pages that are; distrust starts from hosts with blocked pages in
the same way and runs against the links, to those that link to them. What
reaches a host without links in that direction returns to the seeds, so no mass
is lost: the masses of trust and of distrust stay those of their seeds on any
graph. Rounds go on until what changes in one is a small part of the whole. A
host is blocked where distrust is the larger part of what reached it; one that
nothing reached is allowed.

Everything is a join and a partial aggregate by host in Spark; the state of
each few rounds is written to the shared folder, which cuts the lineage.

A null URL or one without `://` has an empty host and path, fits no rule and is
allowed. Null html has no links. Repeated rows count as pages of their own.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """A struct (verdict, rule) of the longest fitting rule, or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block")):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (src, dst, links) between different hosts."""
    link = F.regexp_extract_all(F.col(html_col), F.lit(r"(?i)\b(?:href|src)\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'<>]+)"), 1)
    links = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(link).alias("link"))
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), F.col("link"))).otherwise(F.col("link"))
    return links.select("src", host_of(target).alias("dst")).where("src != '' and dst != '' and src != dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = 100, damping: float = 0.85, keep_every: int = 5, tolerance: float = 1e-4) -> DataFrame:
    """Rows (host, trust, distrust) from seeds (host, s, b) by personalised PageRank.

    trust(v) = (1 - damping) s(v) + damping * (sum of trust(u) * links(u, v) / links from u, and s(v) / sum of s
    times the trust of hosts without links); distrust likewise with all edges reversed. Every `keep_every` rounds
    the state is written, and it is the result when a round changed less than `tolerance` of all mass (or after `rounds`).
    """
    edges = common.materialize(edges, "host-edges")
    out_sum = edges.groupBy("src").agg(F.sum("links").alias("all_out"))
    in_sum = edges.groupBy("dst").agg(F.sum("links").alias("all_in"))
    edges, seen = common.observed(edges.join(out_sum, "src").join(in_sum, "dst").select("src", "dst", (F.col("links") / F.col("all_out")).alias("forth"), (F.col("links") / F.col("all_in")).alias("back")), "host-shares", {"n": F.count(F.lit(1))})
    ends = edges.select(F.col("src").alias("host"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("dst", F.lit(0), F.lit(1))).groupBy("host").agg(F.max("o").alias("o"), F.max("i").alias("i"))
    hosts = seeds.join(ends, "host", "full_outer").select("host", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("s", "b")], *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("o", "i")])
    state, total = common.observed(hosts.select("*", F.col("s").alias("trust"), F.col("b").alias("distrust")), "host-state", {"s": F.sum("s"), "b": F.sum("b")})
    if not seen["n"]:  # without edges every round gives the seeds again
        return state.select("host", "trust", "distrust")
    mass = {k: v or 0.0 for k, v in total.items()}
    for k in range(1, rounds + 1):
        forth = edges.join(state.select(F.col("host").alias("src"), "trust"), "src").select(F.col("dst").alias("host"), (F.col("trust") * F.col("forth")).alias("t"), F.lit(0.0).alias("d"))
        back = edges.join(state.select(F.col("host").alias("dst"), "distrust"), "dst").select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d"))
        got = forth.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        # What hosts without further links hold goes back to the seeds: one row of two sums.
        stuck = state.agg(F.coalesce(F.sum(F.when(F.col("o") == 0, F.col("trust"))), F.lit(0.0)).alias("st"), F.coalesce(F.sum(F.when(F.col("i") == 0, F.col("distrust"))), F.lit(0.0)).alias("sd"))
        moved = state.join(got, "host", "left").join(F.broadcast(stuck))
        share = lambda c, m: F.col(c) / F.lit(mass[m]) if mass[m] else F.lit(0.0)
        trust = (1 - damping) * F.col("s") + damping * (F.coalesce("t", F.lit(0.0)) + F.col("st") * share("s", "s"))
        distrust = (1 - damping) * F.col("b") + damping * (F.coalesce("d", F.lit(0.0)) + F.col("sd") * share("b", "b"))
        change = F.abs(trust - F.col("trust")) + F.abs(distrust - F.col("distrust"))
        state = moved.select("host", "s", "b", "o", "i", trust.alias("trust"), distrust.alias("distrust"), change.alias("change"))
        if k % keep_every == 0 or k == rounds:
            state, seen = common.observed(state, "host-state", {"change": F.sum("change")})
            if seen["change"] <= tolerance * (mass["s"] + mass["b"]):
                break
        state = state.drop("change")
    return state.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules: list[Rule], threshold: float = 0.5, rounds: int = 100) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, trust, distrust)."""
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = urls.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    shares = ruled.where("host != ''").groupBy("host").agg(F.avg(F.coalesce((F.col("found.verdict") == "allow").cast("double"), F.lit(0.0))).alias("s"), F.avg(F.coalesce((F.col("found.verdict") == "block").cast("double"), F.lit(0.0))).alias("b"))
    ranks = propagate(shares, host_edges(pages), rounds)
    verdicts = ranks.select("host", "trust", "distrust", F.when(F.col("distrust") > threshold * (F.col("trust") + F.col("distrust")), "block").otherwise("allow").alias("by_graph"))
    joined = ruled.join(verdicts, "host", "left")
    return joined.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", "by_graph", F.lit("allow")).alias("verdict"), "trust", "distrust")
