"""URL filter by rules, and for hosts that no rule judges by propagation over host links.

DataFrame and SQL functions only. Hosts whose pages the rules allow are trusted seeds, hosts with blocked pages
are blocked seeds. Trust is a personalised PageRank from the trusted seeds along links, distrust one from the
blocked seeds against them. What a host does not pass on goes back to the seeds: nothing is lost at hosts without links,
little leaves a host whose only links are weak ones, and the sums of trust and distrust stay those of the seeds. A host
and its parent domain link each other weakly: they often have one owner, but a blocked page of one host of a large
domain says little of the others. A host is blocked when its share of distrust reaches the threshold and its distrust is more
than a trace.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import save

#: Weights of a host's link back to the seeds and of that between a host and its parent domain; a hyperlink weighs 1 for
#: each page that has it.
SEED_WEIGHT, PARENT_WEIGHT = 0.5, 0.05
#: Share of the mass that may still be out of place when propagation ends.
TOLERANCE = 1e-3
#: Distrust below this (a host that is blocked throughout, alone, has 1) blocks no host.
TRACE = 0.01
#: Rounds between two results that are written to the shared folder.
SAVED_ROUNDS = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool


def url_host(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What stands after the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct<rule, allow>; null without one. The rules are a constant of the
    query, so no join is needed."""
    out = F.lit(None).cast("struct<rule:string,allow:boolean>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.allow).alias("allow"))).otherwise(out)
    return out


def parent_links(hosts: DataFrame) -> DataFrame:
    """Edges src, dst between each host (``host``) and its parent domain, that and its own, and so on down to two
    labels, in both directions, whatever the depth."""
    labels = hosts.select(F.split("host", r"\.").alias("l")).where(F.size("l") > 2)
    up = labels.select(F.explode(F.expr("""transform(sequence(1, size(l) - 2), i -> named_struct(
        'src', array_join(slice(l, i, size(l)), '.'), 'dst', array_join(slice(l, i + 1, size(l)), '.')))""")).alias("e")).select("e.*")
    up = up.where("src <> dst and src not like '.%' and dst not like '.%'").distinct()
    return up.union(up.select("dst", "src"))


def host_links(pages: DataFrame) -> DataFrame:
    """Edges src, dst, weight between different hosts of ``pages`` (host, html): absolute hyperlinks, by the number of
    pages that have one, and weakly a host and its parent domains. A relative link leads to the own host and is none."""
    out = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?((?:https?:)?//[^/?#"'\s>]+)"""), F.lit(1)))).alias("to"))
    links = out.select(F.col("host").alias("src"), F.translate(F.regexp_extract("to", r"//(.*)$", 1), _UPPER, _LOWER).alias("dst"))
    links = save(links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight")), "hyperlinks")
    hosts = pages.where("host <> ''").select("host").distinct().union(links.select("dst")).distinct()
    parents = parent_links(hosts).withColumn("weight", F.lit(PARENT_WEIGHT))
    return links.union(parents).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, follow: float = 0.85) -> DataFrame:
    """Trust and distrust of each host that mass reaches. ``links``: src, dst, weight; ``seeds``: host, trust, distrust.

    Trust goes along links, distrust against them; of what a host has it passes on ``follow`` times the share of its
    links' weight in that and ``SEED_WEIGHT``, and the rest goes back to the seeds. Such a walk is, up to its scale, the
    sum of what the seeds pass on in 0, 1, 2, ... steps; each step leaves at most ``follow`` of the one before, which
    gives the number of rounds for a ``tolerance``. A round is one join and one sum over hosts; every few of them the
    result is written to the shared folder."""
    seeds = save(seeds.select("host", "trust", "distrust"), "host-seeds")
    links = save(links.where("src <> dst"), "host-links")
    out = links.groupBy("src").agg((F.sum("weight") + SEED_WEIGHT).alias("total"))
    back = links.groupBy("dst").agg((F.sum("weight") + SEED_WEIGHT).alias("total"))
    along = links.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
    against = links.join(back, "dst").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("total")).alias("d"))
    flow = save(along.union(against).groupBy("src", "dst").agg((F.sum("t") * follow).alias("t"), (F.sum("d") * follow).alias("d")), "host-flow")
    state, rounds = seeds, math.ceil(math.log(tolerance * (1 - follow)) / math.log(follow))
    for n in range(rounds):
        moved = state.join(flow, state.host == flow.src).groupBy(F.col("dst").alias("host")).agg(
            F.sum(F.col("trust") * F.col("t")).alias("trust"), F.sum(F.col("distrust") * F.col("d")).alias("distrust"))
        state = moved.union(seeds).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if n % SAVED_ROUNDS == SAVED_ROUNDS - 1 or n == rounds - 1:
            state = save(state, "host-rank")
    scale = {c: F.try_divide(seeds.select(F.sum(c)).scalar(), state.select(F.sum(c)).scalar()) for c in ("trust", "distrust")}
    return state.select("host", *[(F.col(c) * F.coalesce(x, F.lit(0.0))).alias(c) for c, x in scale.items()])


def judge_pages(pages: DataFrame, rules: list[Rule], threshold: float = 0.5, tolerance: float = TOLERANCE) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, trust,
    distrust. A rule decides if one fits; else the host does: block if distrust / (trust + distrust) reaches
    the threshold and distrust is at least ``TRACE``, allow otherwise and for hosts that nothing reaches. A host is
    seeded with the shares of its pages that rules allow and block. Null or malformed urls have an empty host, which no
    rule fits and nothing reaches."""
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "html")
    seen = seen.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    found = seen.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("best.allow")).alias("a"), F.count_if(~F.col("best.allow")).alias("b"), F.count(F.lit(1)).alias("n")).where("a + b > 0")
    seeds = found.select("host", F.expr("a / n").alias("trust"), F.expr("b / n").alias("distrust"))
    ranks = propagate(host_links(seen.select("host", "html")), seeds, tolerance)
    ranks = ranks.select(F.col("host").alias("ranked"), "trust", "distrust")
    judged = seen.drop("html").join(ranks, F.col("host") == F.col("ranked"), "left")
    share = F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust"))
    by_host = F.coalesce((share >= threshold) & (F.col("distrust") >= TRACE), F.lit(False))
    blocked = F.when(F.col("best").isNotNull(), ~F.col("best.allow")).otherwise(by_host)
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                         F.when(blocked, "block").otherwise("allow").alias("verdict"),
                         F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
