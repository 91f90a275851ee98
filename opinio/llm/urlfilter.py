"""URL filter: rules first, then trust and distrust propagated over the host link graph.

Hosts are nodes; the links in the pages' html, counted per pair of hosts, are edges.  Trust flows from the
hosts whose pages rules allow, along the links; distrust flows from the hosts whose pages rules block,
against them (who links to a blocked host is suspect).  Both are personalised PageRank, summed as a series:
every round pushes the last round's mass one link further, until what moves is below ``tolerance``.  Links
within a host move nothing.  A page without a rule takes its host's verdict.

DataFrame functions only.  Pages are counted per host map-side before they move; ranks, edges and hosts are
tables; the adaptive skew join splits a host with very many pages or links.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ascii_lower, materialise

#: (action, host, path): a rule fits its host and all subdomains where the path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
_URL = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
_HREF = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    def part(i: int) -> Column:
        return F.coalesce(F.regexp_extract(url, _URL, i), F.lit(""))
    return ascii_lower(part(1)), part(2)


def _suffixes(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, rules)``: the rules that fit each host, longest first (ties: by rule, then action)."""
    near = hosts.select("host", F.explode(F.array_distinct(_suffixes(F.col("host")))).alias("rule_host"))
    found = near.join(rules.withColumnRenamed("host", "rule_host"), "rule_host")
    return found.groupBy("host").agg(F.array_sort(F.collect_set(F.struct(
        (-F.length(F.concat("rule_host", "path"))).alias("order"), F.concat("rule_host", "path").alias("rule"),
        "action", "path"))).alias("rules"))


def _first_rule(rules: Column, path: Column) -> Column:
    return F.get(F.filter(rules, lambda r: F.startswith(path, r["path"])), 0)


def host_links(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``(src, dst, n)``: links between different hosts.  ``pages`` has a ``host`` column."""
    found = F.regexp_extract_all(F.col(html_col), F.lit(_HREF), F.lit(1))
    # Only absolute links can leave the host; most pages have none and are not expanded.
    targets = F.array_distinct(F.transform(found, lambda u: F.regexp_extract(u, r"//([^/?#]*)", 1)))
    return (pages.where(F.instr(html_col, "//") > 0).select(F.col("host").alias("src"), F.explode_outer(targets).alias("d"))
            .where(F.col("d").isNotNull() & (F.col("d") != "") & (F.col("src") != ""))
            .select("src", ascii_lower(F.col("d")).alias("dst")).where(F.col("src") != F.col("dst"))
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4,
              rounds: int = 60) -> DataFrame:
    """``(kind, host, rank)``: personalised PageRank of each ``kind`` of seed, over the edges of that kind
    ``(kind, src, dst, share)``; ranks of a kind sum to one.  Mass at hosts without links returns to the
    seeds, which is what scaling the series to one does."""
    weights = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))  # two rows
    mass = materialise(seeds.join(F.broadcast(weights), "kind").select(
        "kind", "host", (F.col("weight") / F.col("all")).alias("mass")), "mass")
    parts = [mass]
    for _ in range(rounds):
        pushed = (mass.withColumnRenamed("host", "src").join(edges, ["kind", "src"])
                  .groupBy("kind", F.col("dst").alias("host"))
                  .agg(F.sum(F.col("mass") * F.col("share") * damping).alias("mass"))
                  .where(F.col("mass") > 0))
        mass = materialise(pushed, "mass")
        if not mass.agg(F.coalesce(F.sum("mass"), F.lit(0.0)) > tolerance).head()[0]:
            break
        parts.append(mass)
    total = parts[0]
    for p in parts[1:]:
        total = total.unionAll(p)
    ranks = total.groupBy("kind", "host").agg(F.sum("mass").alias("rank"))
    sums = ranks.groupBy("kind").agg(F.sum("rank").alias("all"))  # two rows
    return ranks.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("rank") / F.col("all")).alias("rank"))




def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 1.0,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: ``(id, host, path, rule, verdict, trust, distrust)``.

    A page that a rule fits takes the longest rule's action.  Any other page is blocked if its host's distrust
    is above both its trust and ``threshold`` times the mean over all hosts, else allowed.  The share of a
    host's pages that rules allow (block) is its weight as a seed.  Null urls and urls without ``://``
    have an empty host, which is no node and is allowed.  Null html has no links.  Repeated rows are
    separate pages; an empty table gives no rows; extra columns are not looked at, whatever their names.
    """
    spark = pages.sparkSession
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    narrow = rows.drop("html")
    edges = materialise(host_links(rows, "html"), "host-links")
    table = spark.createDataFrame(list(rules), "action string, host string, path string")
    own = narrow.where(F.col("host") != "").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    ruled = host_rules(own, table)
    hosts = materialise(own.join(ruled, "host", "left"), "hosts")
    # Whether a rule fits depends on host and path, so the seeds come from one join of the narrow rows.
    judged = narrow.join(hosts, "host", "left").select("id", "host", "path", _first_rule(
        F.col("rules"), F.col("path")).alias("r")).select("id", "host", "path", "r.rule", "r.action")
    judged = materialise(judged, "judged")
    counts = judged.where("host != ''").groupBy("host").agg(
        F.count_if(F.col("action") == "allow").alias("allow"), F.count_if(F.col("action") == "block").alias("block"),
        F.count(F.lit(1)).alias("n"))
    seeds = counts.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("allow") / F.col("n")).alias("weight")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("block") / F.col("n")).alias("weight")))).alias("s")).select(
        "host", "s.kind", "s.weight").where(F.col("weight") > 0)
    ways = edges.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src"), F.col("dst"), "n"),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))).alias("e"))
    ways = ways.select("e.*")
    out_n = ways.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    shares = materialise(ways.join(out_n, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("out"))
                                                                  .alias("share")), "shares")
    ranks = propagate(shares, seeds)
    nodes = counts.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    scored = materialise(nodes.join(ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))).alias("distrust")), "host", "left")
        .fillna(0.0, ["trust", "distrust"]), "ranks")
    n_hosts = max(scored.count(), 1)
    out = judged.join(scored, "host", "left").fillna(0.0, ["trust", "distrust"])
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") * n_hosts > threshold)
    return out.select(F.col("id").alias(id_col), "host", "path", "rule",
                      F.coalesce("action", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
