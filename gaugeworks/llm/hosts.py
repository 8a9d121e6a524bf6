"""URL filter: rules first, then trust and distrust that spread over links between hosts.

Every host that rules speak of is a seed of weight one, split into trust and distrust by its pages that were allowed and
blocked, so that a host with many pages weighs no more than another and both scores have one scale. Personalised
PageRank carries trust along links and distrust against them: who links to a blocked host is suspect, not who
is linked from it. Rounds go on until every host that can be reached is reached and no rank still grows. A
host whose share of distrust reaches a threshold is blocked, and so is one of whose pages rules block all they judge,
whatever links to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.llm.common import LOWER, UPPER
from gaugeworks.sources.scratch import materialise

HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?i)\bhref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""
DAMPING, THRESHOLD = 0.85, 0.9
#: Rounds end when no host gains more than this share of its rank.
STILL = 1e-6

#: Rules as (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1)


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule (its text, or null) and ruling. The longest rule that fits wins."""
    out = pages.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rule, ruling = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == name) | F.endswith("host", F.lit("." + name))) & F.startswith("path", F.lit(start))
        rule, ruling = F.when(fits, name + start).otherwise(rule), F.when(fits, verdict).otherwise(ruling)
    return out.withColumn("rule", rule).withColumn("ruling", ruling)


def links(pages: DataFrame) -> DataFrame:
    """(source, target, weight): absolute links between different hosts, counted. Relative links stay on their host."""
    target = host(F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link")))
    found = pages.select(F.col("host").alias("source"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("link"))
    found = found.select("source", target.alias("target")).where("source != target and source != '' and target != ''")
    return found.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, still: float = STILL) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust).

    Ranks are the sum of what arrives after 0, 1, 2, ... links. A round passes on what arrived last: one equi-join of hosts
    with their edges and one aggregate that combines before its shuffle. It ends when nothing arrived, or no host
    gained more than ``still`` of its rank; a host reached for the first time gains all of it. So long
    chains take as many rounds as they have links; only what a double cannot hold, after some 4000 links, is lost.
    Each round's tables are written to the shared folder; the driver sees one number a round. What reaches a host
    without links is not passed on.
    """
    out = edges.groupBy("source").agg(F.sum("weight").alias("all_out"))
    into = edges.groupBy("target").agg(F.sum("weight").alias("all_in"))
    zero = F.lit(0.0)
    forward = edges.join(out, "source").select(F.col("source").alias("host"), F.col("target").alias("to"), (F.col("weight") / F.col("all_out")).alias("t"), zero.alias("d"))
    backward = edges.join(into, "target").select(F.col("target").alias("host"), F.col("source").alias("to"), zero.alias("t"), (F.col("weight") / F.col("all_in")).alias("d"))
    steps = materialise(forward.union(backward).groupBy("host", "to").agg(F.sum("t").alias("t"), F.sum("d").alias("d")), "steps")
    start = [(F.col(c) * (1 - damping)).alias(n) for n in ("", "new_") for c in ("trust", "distrust")]
    ranks = materialise(seeds.select("host", *start).toDF("host", "trust", "distrust", "new_trust", "new_distrust"), "ranks")
    gain = F.col("new_trust") + F.col("new_distrust")
    while True:
        passed = ranks.where(gain > 0).join(steps, "host").groupBy(F.col("to").alias("host")).agg(
            F.sum(F.col("new_trust") * F.col("t") * damping).alias("trust"), F.sum(F.col("new_distrust") * F.col("d") * damping).alias("distrust"))
        arrived = passed.withColumns({"new_trust": F.col("trust"), "new_distrust": F.col("distrust")})
        both = ranks.withColumns({"new_trust": zero, "new_distrust": zero}).unionByName(arrived)
        ranks = materialise(both.groupBy("host").agg(*[F.sum(c).alias(c) for c in ("trust", "distrust", "new_trust", "new_distrust")]), "ranks")
        most = ranks.agg(F.max(F.try_divide(gain, F.col("trust") + F.col("distrust")))).first()[0]
        if not most or most <= still:
            return ranks.select("host", "trust", "distrust")


def judged(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, still: float = STILL) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    A page with a rule has the rule's verdict. Others are blocked if their host's distrust is at least
    ``threshold`` of its trust and distrust together, or if rules blocked all of its pages that they judge; hosts that
    neither trust nor distrust reaches are allowed. Null urls and
    urls without :// have an empty host and path, and are allowed. Null html has no links. Repeated pages
    count as often as they occur. Other columns are ignored; an empty table gives an empty result.
    """
    rows = ruled(pages.select("page_id", "url", "html"), rules)
    judged_pages = rows.where("ruling is not null and host != ''").groupBy("host").agg(
        F.count_if(F.col("ruling") == "allow").alias("good"), F.count("*").alias("all"))
    share = F.col("good") / F.col("all")
    seeds = materialise(judged_pages.select("host", share.alias("trust"), (1 - share).alias("distrust")), "seeds")
    ranks = propagate(seeds, materialise(links(rows), "links"), still=still)
    ranks = ranks.join(seeds.select("host", (F.col("trust") == 0).alias("only_blocked")), "host", "left")
    lean = rows.select("page_id", "host", "path", "rule", "ruling").join(ranks, "host", "left")
    suspect = F.coalesce(F.col("distrust") > 0, F.lit(False)) & (F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust")))
    method = F.when(suspect | F.coalesce("only_blocked", F.lit(False)), "block").otherwise("allow")
    return lean.select("page_id", "host", "path", "rule", F.coalesce("ruling", method).alias("verdict"),
                       F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
