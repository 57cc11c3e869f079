"""URL rules, and trust propagation over the host graph for what no rule decides.

Hosts are linked by the hyperlinks of their pages and to the host one label above them. Hosts that are only linked to take
part as well. Pages that a rule allows make their host a trusted seed, pages that a rule blocks a distrusted one, each with as
much weight as there are such pages; of a host without pages, the different urls that links name count as its pages.
Trust follows the edges (personalised PageRank), distrust runs against them, so that linking to blocked hosts counts.
A host is blocked when its distrust exceeds its trust and reaches ``threshold`` of its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import staged

# The production rules
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:https?:)?//[^\"'\s>]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def match(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null. A rule fits its host and all hosts below it."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        found = F.when(fits, rule).otherwise(found)
    return found


def page_links(pages: DataFrame) -> DataFrame:
    """``pages``: host, html. src, dst, path, weight: links to urls of other hosts, counted."""
    url = F.concat(F.lit("http://"), F.regexp_replace("link", "^[^/]*//", ""))
    return pages.where(F.contains("html", F.lit("//"))).select(
        F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("link")).select(
        "src", host_of(url).alias("dst"), path_of(url).alias("path")).where("src != dst AND dst != ''").groupBy(
        "src", "dst", "path").agg(F.count(F.lit(1)).alias("weight"))


def host_edges(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """src, dst, weight: ``links`` by host, and one link each way between a host and the one a label above."""
    parent = hosts.select("host", F.regexp_replace("host", r"^[^.]*\.", "").alias("up")).where("host != up")
    parent = parent.join(hosts.select(F.col("host").alias("up")), "up", "left_semi")
    one = F.lit(1).cast("long").alias("weight")
    return links.select("src", "dst", "weight").unionByName(
        parent.select(F.col("host").alias("src"), F.col("up").alias("dst"), one)).unionByName(
        parent.select(F.col("up").alias("src"), F.col("host").alias("dst"), one)).groupBy(
        "src", "dst").agg(F.sum("weight").alias("weight"))


def seeded(rows: DataFrame) -> DataFrame:
    """``rows``: host, said. The hosts with their pages, counted: all, allowed ones, blocked ones."""
    return rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count(F.when(F.col("said") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("said") == "block", 1)).alias("blocked"))


def propagate(hosts: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float = 0.001, write_every: int = 5) -> DataFrame:
    """``hosts``: host, allowed, blocked. Adds trust and distrust, in pages: x = seed + damping * (x along the edges). This is
    personalised PageRank up to a factor; rank that meets a dead end goes back to the seeds.

    Steps go on until all that is still to come is at most ``tolerance`` of all seeds. A step adds at most ``damping`` of what
    the one before added, so the mean of the last ``write_every`` additions bounds what is to come, and the number of steps is
    at most about log(tolerance * (1 - damping)) / log(damping), 54, whatever the graph."""
    def shares(source: str, target: str, kind: int) -> DataFrame:
        total = edges.groupBy(F.col(source).alias("from")).agg(F.sum("weight").alias("total"))
        return edges.select(F.col(source).alias("from"), F.col(target).alias("to"), "weight").join(total, "from").select(
            F.lit(kind).alias("kind"), "from", "to", (damping * F.col("weight") / F.col("total")).alias("share"))

    flow = staged(shares("src", "dst", 0).unionByName(shares("dst", "src", 1)), "flow")
    seeds = staged(hosts.select("host", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("allowed").cast("double").alias("seed")),
        F.struct(F.lit(1).alias("kind"), F.col("blocked").cast("double").alias("seed")))).alias("s")).select(
        "s.kind", "host", "s.seed").where("seed > 0"), "seeds")
    total = seeds.agg(F.sum("seed")).first()[0] or 0.0
    ranks, before, left = seeds.withColumnRenamed("seed", "rank"), total, total
    while left > tolerance * total:
        for _ in range(write_every):
            moved = flow.join(ranks.withColumnRenamed("host", "from"), ["kind", "from"]).select(
                "kind", F.col("to").alias("host"), (F.col("share") * F.col("rank")).alias("rank"))
            ranks = moved.unionByName(seeds.withColumnRenamed("seed", "rank")).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = staged(ranks, "ranks")
        now = ranks.agg(F.sum("rank")).first()[0]
        left, before = (now - before) / write_every * damping / (1 - damping), now
    wide = ranks.groupBy("host").agg(F.sum(F.when(F.col("kind") == 0, F.col("rank"))).alias("trust"),
                                     F.sum(F.when(F.col("kind") == 1, F.col("rank"))).alias("distrust"))
    return hosts.join(wide, "host", "left").fillna(0.0, ["trust", "distrust"])


def judge_urls(pages: DataFrame, rules: dict[str, str] | None = None, threshold: float = 0.5, damping: float = 0.85,
               tolerance: float = 0.001) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust and distrust of its host.

    A null url, or one without ``://``, has an empty host and path, takes part in no edge and is allowed. Null html holds no
    links. Repeated rows are pages of their own and count as such. No pages give no rows. Other columns than page_id,
    url and html are not read.
    """
    rules = RULES if rules is None else rules
    named = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    ruled = named.withColumn("rule", match(F.col("host"), F.col("path"), rules))

    def says(rule: Column) -> Column:
        said = F.lit(None).cast("string")
        for name, verdict in rules.items():
            said = F.when(rule == name, verdict).otherwise(said)
        return said

    ruled = ruled.withColumn("said", says(F.col("rule")))
    links = staged(page_links(named.where("host != ''")), "links")
    own = staged(seeded(ruled), "own-hosts")
    named_only = links.select(F.col("dst").alias("host"), "path").distinct().join(own.select("host"), "host", "left_anti")
    hosts = staged(own.unionByName(seeded(named_only.withColumn("said", says(match(F.col("host"), F.col("path"), rules))))), "hosts")
    edges = staged(host_edges(links, hosts.where("host != ''")), "host-edges")
    scored = staged(propagate(hosts, edges, damping, tolerance), "scored").select(
        "host", "trust", "distrust", ((F.col("distrust") > F.col("trust")) & (
            F.col("distrust") >= threshold * F.col("pages")) & (F.col("host") != "")).alias("bad"))
    return ruled.drop("html").join(scored, "host").select(
        "page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
        "trust", "distrust")
