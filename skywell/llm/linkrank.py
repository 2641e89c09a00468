"""Judging hosts by who links to whom, and URLs by rules.

Hosts are joined by the links of their pages and by their names: a subdomain stands with its parent
domain. Trust starts at hosts whose pages the allow rules fit and follows the links; distrust starts
at hosts whose pages the block rules fit and follows the links backwards, from a page's target to whoever links
there. Both are personalised PageRanks, computed next to the same walk from every host in proportion
to its pages, which tells how much rank a host has anyway. A host is blocked when its distrust,
less its trust, is at least a given share of that.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skywell.llm.common import fresh, query, table, written

#: The rules in force, as verdict, host and path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


STEPS = 6  # between two written scores


@dataclass(frozen=True)
class RankSettings:
    damping: float = 0.85
    tolerance: float = 1e-3  # change of all scores in a few steps at which they stay, against the seeds' weights
    threshold: float = 0.5  # share of a host's own rank


def lowered(text: Column) -> Column:
    """ASCII letters in lower case, all others as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: str) -> Column:
    return F.coalesce(lowered(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(rules, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null without one; a later rule wins a tie."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col(host) == h) | F.col(host).endswith(f".{h}")) & F.col(path).startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def link_edges(pages: DataFrame, html: str = "html", host: str = "host") -> DataFrame:
    """`source`, `target`, `weight`: links from a page's host to other hosts, counted."""
    attribute = r"""(?is)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""
    target = F.explode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(attribute), F.lit(1)))
    return (
        pages.select(F.col(host).alias("source"), target.alias("target"))
        .withColumn("target", lowered(F.col("target")))
        .filter("source <> target and source <> '' and target <> ''")
        .groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))
    )


def name_edges(hosts: DataFrame) -> DataFrame:
    """Both ways between a host and its parent domain, where the parent has two labels or more."""
    parent = F.regexp_extract("host", r"^[^.]+\.([^.]+\..+)$", 1)
    up = hosts.select(F.col("host").alias("source"), parent.alias("target")).filter("target <> ''")
    return up.union(up.select("target", "source")).distinct().withColumn("weight", F.lit(1.0))


def propagate(edges: DataFrame, hosts: DataFrame, settings: RankSettings) -> DataFrame:
    """`host`, `trust`, `distrust` and `own`, stepped from the seeds in `hosts` until they hardly change.

    `hosts` has `host` and the seed weights `trust`, `distrust`, `own`. One step is a join of the
    scores with the edges and a sum by target, in which Spark combines each task's rows first and
    splits a host that most edges meet in. The scores of both directions travel in one pass.
    """
    forward = edges.withColumn("way", F.lit(1))
    both = forward.unionByName(edges.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight", F.lit(-1).alias("way")))
    totals = both.groupBy("source", "way").agg(F.sum("weight").alias("total"))
    steps = written(
        both.groupBy("source", "target", "way").agg(F.sum("weight").alias("weight")).join(totals, ["source", "way"])
        .select("source", "target", "way", (F.col("weight") / F.col("total")).alias("share"))
    )
    kinds = ("trust", "distrust", "own")
    stay = 1 - settings.damping
    seeds = hosts.select("host", *[F.col(c).alias(f"s_{c}") for c in kinds])
    weight = hosts.agg(*[F.sum(F.abs(c)).alias(c) for c in kinds]).first()
    scores = hosts
    while True:
        before = scores.select("host", *[F.col(c).alias(f"b_{c}") for c in kinds])
        for _ in range(STEPS):
            carried = [F.sum(F.when(F.col("way") == way, F.col(c) * F.col("share")).otherwise(0.0)).alias(f"m_{c}") for c, way in zip(kinds, (1, -1, 1))]
            moved = scores.withColumnRenamed("host", "source").join(steps, "source").groupBy(F.col("target").alias("host")).agg(*carried)
            stepped = [(stay * F.col(f"s_{c}") + settings.damping * F.coalesce(f"m_{c}", F.lit(0.0))).alias(c) for c in kinds]
            scores = seeds.join(moved, "host", "left").select("host", *stepped)
        scores = written(scores)  # cuts the plan, and a lost executor's work
        changes = scores.join(before, "host").agg(*[F.sum(F.abs(F.col(c) - F.col(f"b_{c}"))).alias(c) for c in kinds]).first()
        if all((changes[c] or 0.0) <= settings.tolerance * (weight[c] or 0.0) for c in kinds):
            return scores


def judge_urls(
    pages: DataFrame, rules=RULES, url: str = "url", html: str = "html", keep: tuple = ("page_id",),
    settings: RankSettings = RankSettings(),
) -> DataFrame:
    """`keep`, `host`, `path`, `rule`, `verdict` and the host's ranks, one row per input row.

    A null url or one without `://` has an empty host and path, fits no rule and is allowed, as its
    host can't be blocked. A rule decides its pages; the host's ranks decide the others. Repeated
    rows repeat and count as pages of their host; other columns are not read.
    """
    names = [fresh(n, keep) for n in ("host", "path", "rule", "verdict", "trust", "distrust", "own")]
    body, at = fresh("_html", keep), fresh("_host", keep)
    placed = pages.select(*keep, host_of(url).alias(names[0]), path_of(url).alias(names[1]), F.col(html).alias(body))
    rule, verdict = fitting(rules, names[0], names[1])
    placed = placed.withColumns({names[2]: rule, names[3]: verdict})
    edges = link_edges(placed, body, names[0])
    seen = placed.filter(F.col(names[0]) != "").groupBy(F.col(names[0]).alias("host")).agg(
        F.count("*").cast("double").alias("own"),
        F.count(F.when(F.col(names[3]) == "allow", 1)).cast("double").alias("trust"),
        F.count(F.when(F.col(names[3]) == "block", 1)).cast("double").alias("distrust"),
    )
    edges = written(edges)
    linked = edges.select(F.col("source").alias("host")).union(edges.select("target"))
    named = name_edges(seen.select("host").union(linked).distinct())
    nodes = linked.union(named.select("target")).distinct().withColumns({c: F.lit(0.0) for c in ("own", "trust", "distrust")})
    hosts = written(
        seen.unionByName(nodes).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "own")])
    )
    ranks = propagate(edges.unionByName(named), hosts, settings)
    ranks = ranks.select(F.col("host").alias(at), *[F.col(c).alias(n) for c, n in zip(("trust", "distrust", "own"), names[4:])])
    bad = F.coalesce(F.col(names[5]) - F.col(names[4]) >= settings.threshold * F.col(names[6]), F.lit(False)) & (F.col(names[6]) > 0)
    return (
        placed.drop(body).join(ranks, F.col(names[0]) == F.col(at), "left").drop(at)
        .withColumn(names[3], F.coalesce(F.col(names[3]), F.when(bad, "block").otherwise("allow")))
    )


@query()
def op10_linkrank(spark, sf_dir):
    """Rule and verdict of every page's url."""
    return judge_urls(table(spark, sf_dir, "pages"))
