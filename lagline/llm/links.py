"""URL verdicts: rules first, then trust and distrust spread over the links between hosts.

Trust starts at hosts with pages that a rule allows and follows links; distrust starts at hosts
with pages that a rule blocks and goes against the links, to whoever links there. Hosts start
with the share of their pages that the rules allow or block. Both are personalised PageRanks over
one weighted edge per pair of hosts (a host's own links aside). What reaches a host without links
goes back to the seeds, which is the same as leaving it out and scaling the ranks to a sum of 1.

A page without a rule is blocked if its host's distrust exceeds its trust by the threshold. A rule
for a path speaks of that path, so a host's own start counts towards its other pages only if the
rule's kind holds for most of its pages; what it gets from others always counts.

Ranks only grow from round to round, so the growth of their sum tells how much is still missing.
They are written to the shared folder every few rounds, and the rounds end when less than
``TOLERANCE`` of the sum is missing (at most about 130 rounds). Sums are pre-aggregated per host,
so a host that very many link to is one row per task; the edges of a host that links to very many
are a side of a join that adaptive execution may split.

Null urls or such without ``://``: host and path empty, no rule, allowed. Null html has no links.
Repeated pages count as often as they are there. Only A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.common import quoted, settled

DAMPING = 0.85
TOLERANCE = 1e-9
SETTLE_EVERY = 4
THRESHOLD = 0.0
#: Equal ranks may differ by so much, relatively, as sums are added up in any order.
EQUAL = 1e-9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts of absolute links; the link's own scheme may be left out.
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""

Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, UPPER, LOWER), path


def by_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule (host and path together) and its verdict; nulls without one."""
    rule = verdict = F.lit(None).cast("string")
    for word, own_host, own_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = (host == own_host) | F.endswith(host, F.lit("." + own_host))
        fits = fits & F.startswith(path, F.lit(own_path))
        rule = F.when(fits, F.lit(own_host + own_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def edges(pages: DataFrame, html: str) -> DataFrame:
    """source, target, share: links between different hosts, shares of the source's links."""
    found = F.regexp_extract_all(F.col(quoted(html)), F.lit(LINK), F.lit(1))
    links = pages.select(F.col("host").alias("source"), F.explode(found).alias("target"))
    links = links.withColumn("target", F.translate("target", UPPER, LOWER))
    links = links.where("source <> '' and target <> '' and source <> target")
    return links.groupBy("source", "target").agg(F.count("*").alias("links"))


def spread(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust, own_trust, own_distrust.

    ``seeds`` has host, trust and distrust as starting weights. The own ranks are the parts that
    hosts have by their starting weights and not from others.
    """
    forward = links.select(F.lit("trust").alias("kind"), "source", "target", "links")
    backward = links.select(
        F.lit("distrust").alias("kind"),
        F.col("target").alias("source"),
        F.col("source").alias("target"),
        "links",
    )
    both = settled(forward.union(backward))
    start = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust)"))
    start = start.toDF("host", "kind", "weight").where("weight > 0")
    total = start.groupBy("kind").agg(F.sum("weight").alias("total"))
    own = F.col("weight") / F.col("total") * (1 - DAMPING)
    base = start.join(F.broadcast(total), "kind").select("kind", "host", own.alias("rank"))
    base = settled(base)
    now = base
    if not both.isEmpty():
        sums = both.groupBy("kind", "source").agg(F.sum("links").alias("all"))
        shares = both.join(sums, ["kind", "source"])
        shares = settled(
            shares.select(
                "kind", F.col("source").alias("host"), "target",
                (F.col("links") / F.col("all")).alias("share"),
            )
        )
        # After so many rounds the growth shrinks by ``less``, so ``growth * less / (1 - less)``
        # is still missing at most.
        less = DAMPING**SETTLE_EVERY
        before, missing = _sums(now), 1.0
        while missing > tolerance:
            for _ in range(SETTLE_EVERY):
                moved = shares.join(now, ["kind", "host"]).select(
                    "kind",
                    F.col("target").alias("host"),
                    (F.col("rank") * F.col("share") * DAMPING).alias("rank"),
                )
                now = base.unionByName(moved).groupBy("kind", "host")
                now = now.agg(F.sum("rank").alias("rank"))
            now = settled(now)
            after = _sums(now)
            growth = max((after[kind] - before[kind] for kind in after), default=0.0)
            before, missing = after, growth * less / (1 - less)
    parts = now.withColumn("own", F.lit(0.0)).unionByName(
        base.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("own"))
    )
    whole = now.groupBy("kind").agg(F.sum("rank").alias("whole"))
    parts = parts.join(F.broadcast(whole), "kind")

    def of(kind: str, column: str, name: str) -> Column:
        value = F.when(F.col("kind") == kind, F.col(column) / F.col("whole"))
        return F.coalesce(F.sum(value), F.lit(0.0)).alias(name)

    return parts.groupBy("host").agg(
        of("trust", "rank", "trust"),
        of("distrust", "rank", "distrust"),
        of("trust", "own", "own_trust"),
        of("distrust", "own", "own_distrust"),
    )


def _sums(ranks: DataFrame) -> dict[str, float]:
    """The sum of the ranks per kind: two numbers."""
    rows = ranks.groupBy("kind").agg(F.sum("rank").alias("whole")).collect()
    return {row.kind: row.whole for row in rows}


def judge(
    pages: DataFrame, id_column: str, url: str, html: str, rules: Sequence[Rule],
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    host, path = host_and_path(F.col(quoted(url)))
    named = pages.select(
        F.col(quoted(id_column)).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        F.col(quoted(html)).alias("html"),
    )
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    ruled = named.drop("html").withColumns({"rule": rule, "verdict": verdict})
    ruled = settled(ruled)
    counts = ruled.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked"),
    )
    seeds = counts.select(
        "host",
        (F.col("allowed") / F.col("pages")).alias("trust"),
        (F.col("blocked") / F.col("pages")).alias("distrust"),
        (F.col("allowed") * 2 > F.col("pages")).alias("mostly_allowed"),
        (F.col("blocked") * 2 > F.col("pages")).alias("mostly_blocked"),
    )
    seeds = settled(seeds)
    ranks = spread(edges(named, "html"), seeds).join(
        seeds.select("host", "mostly_allowed", "mostly_blocked"), "host", "left"
    )

    def counted(kind: str, mostly: str) -> Column:
        return F.col(kind) - F.when(~F.col(mostly), F.col("own_" + kind)).otherwise(0.0)

    excess = counted("distrust", "mostly_blocked") - counted("trust", "mostly_allowed")
    # Taking a host's own part off leaves rounding errors in the place of zero.
    slack = EQUAL * (F.col("trust") + F.col("distrust"))
    bad = ranks.where(excess > threshold + slack).select("host", F.lit("block").alias("found"))
    return ruled.join(bad, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "found", F.lit("allow")).alias("verdict"),
    )
