"""URL filter: address rules first, then trust and distrust that spread over the graph of hosts.

Edges between hosts are the absolute links in the pages, plus one edge each way between a host and its parent domain, as
long as that has two labels. Trust is a personalised PageRank that starts from pages the rules allow and follows the
edges; distrust starts from pages the rules block and follows the edges backwards, since who links to the bad is suspect.
A host whose share of distrust in both reaches ``threshold`` has its remaining pages blocked; a host that neither reaches
is allowed.

Both walks share one join per step: the edge table carries both directions, and a step is one join and one partial sum
of at most one row per host and direction. There is no limit of steps: the walk goes on until it has settled at every host
(what is still to come is then at most 0.6 percent of what a host holds). Only columns and DataFrame functions are used. A page's links collapse to
distinct hosts before any shuffle, edges are counted by partial sums, and rules are literals.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; such pages share the host ''
that has no edges; a null html has no links; repeated pages count as often as they occur; without pages the result is
empty; without a seed or an edge nothing moves; a host behind so many steps that its mass is below the smallest DOUBLE counts as
not reached; other columns are not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lonja.llm.common import table
from lonja.operators.staging import Stage

ALLOW, BLOCK = "allow", "block"
STORED = 2  # steps of the walk between two stored ones: each plan stays short, and so does what the driver holds of it
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
LINK = r"""(?i)(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def address(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, both null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        text, verdict = F.when(fits, domain + start).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def edges(pages: DataFrame) -> DataFrame:
    """source, target and weight; ``pages`` has host and html. A page names another host once, however often it links there."""
    named = F.array_distinct(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    target = F.translate("target", string.ascii_uppercase, string.ascii_lowercase)
    links = pages.select(F.col("host").alias("source"), F.explode(named).alias("target")).select("source", target.alias("target"))
    hosts = links.select(F.explode(F.array("source", "target")).alias("host")).unionByName(pages.select("host")).distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    family = hosts.select("host", parent.alias("parent")).where("parent <> ''")
    up = family.select(F.col("host").alias("source"), F.col("parent").alias("target"))
    down = family.select(F.col("parent").alias("source"), F.col("host").alias("target"))
    every = links.unionByName(up).unionByName(down).where("source <> target and source <> '' and target <> ''")
    return every.groupBy("source", "target").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, stage: Stage, tolerance: float = 1e-3, damping: float = 0.85) -> DataFrame:
    """host, trust, distrust. ``seeds`` has host, trust and distrust: the mass that restarts there, each summing to 1.

    A host holds what has come to it so far; in one step, what came last goes out over its edges in proportion to their weights, a
    part of it lost; what finds no edge stays out. The walk ends when no host has gained more than ``tolerance`` of what it holds in
    the last step, so also a host far from all seeds, which holds little, is reached and settled. Every ``STORED`` steps are stored,
    so that neither the plan nor the work to repeat after a loss grows with their number; one number comes to the driver then."""
    both = edges.select(F.lit("trust").alias("kind"), "source", "target", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    )
    total = both.groupBy("kind", "source").agg(F.sum("weight").alias("total"))
    part = (F.col("weight") / F.col("total") * damping).alias("part")
    ways = stage.keep(both.join(total, ["kind", "source"]).select("kind", "source", "target", part), "ways")
    masses = F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "mass")
    start = seeds.select(F.col("host").alias("target"), masses).where("mass > 0")
    start = start.select("kind", "target", (F.col("mass") * (1 - damping)).alias("held"))
    state, moving, step = stage.keep(start.withColumn("came", F.col("held")), "step_0"), True, 0
    while moving:
        for _ in range(STORED):
            going = state.where("came > 0").select("kind", F.col("target").alias("source"), "came").join(ways, ["kind", "source"])
            came = going.select("kind", "target", F.lit(0.0).alias("held"), (F.col("came") * F.col("part")).alias("came"))
            every = state.select("kind", "target", "held", F.lit(0.0).alias("came")).unionByName(came)
            sums = every.groupBy("kind", "target").agg(F.sum("held").alias("held"), F.sum("came").alias("came"))
            state = sums.select("kind", "target", (F.col("held") + F.col("came")).alias("held"), "came")
        step += STORED
        seen = Observation()
        gained = F.max(F.when(F.col("held") > 0, F.col("came") / F.col("held"))).alias("gained")
        state = stage.keep(state.observe(seen, gained), f"step_{step}")
        moving = (seen.get["gained"] or 0.0) > tolerance
    trust, distrust = (F.sum(F.when(F.col("kind") == kind, F.col("held")).otherwise(0.0)) for kind in ("trust", "distrust"))
    return state.groupBy(F.col("target").alias("host")).agg(trust.alias("trust"), distrust.alias("distrust"))


def filter_urls(
    pages: DataFrame, stage: Stage, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5, tolerance: float = 1e-3
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every page."""
    host, path = address(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))
    rule, kind = best_rule(F.col("host"), F.col("path"), rules)
    ruled = seen.select("page_id", "host", "path", rule.alias("rule"), kind.alias("ruled"))
    counted = ruled.groupBy("host").agg(F.count_if(F.col("ruled") == ALLOW).alias("good"), F.count_if(F.col("ruled") == BLOCK).alias("bad"))
    counted = stage.keep(counted, "evidence")
    total = counted.where("host <> ''").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    seeds = counted.where("good + bad > 0 and host <> ''").select(
        "host", (F.col("good") / (total.good or 1)).alias("trust"), (F.col("bad") / (total.bad or 1)).alias("distrust")
    )
    scores = spread(stage.keep(edges(seen.select("host", "html")), "edges"), seeds, stage, tolerance)
    blocked = F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust"))
    return ruled.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(blocked & (F.col("distrust") > 0), BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op7_host_propagation(spark, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), Stage(spark, "hosts"))
