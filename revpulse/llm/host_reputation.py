"""URL filter: rules for hosts and paths, and elsewhere an empirical-Bayes reputation of the host.

Labelled pages are good or bad. The share of good pages of a host is shrunk towards that of its
registered domain (the suffix and one label), the domain's towards that of its suffix (the last
label, or two where a list says so), the suffix's towards the share of all pages. Each step is a beta-binomial: the group above gives
the prior mean, and the prior's strength is estimated from how much the groups of that level differ (method
of moments). A host is allowed if the lower bound of its posterior, ``mean - BOUND * deviation``, reaches
``LEAST_GOOD``; a host without labelled pages has the posterior of its domain.

Counts are partial aggregates by host, so one host with a third of the pages is no hot key; the levels
above are made of one row per host, and the prior strengths of sums.

Rules: a rule is a host and a path; it fits that host and its subdomains if the URL's path starts with the
rule's. The longest rule wins (by its length as ``host/path``; equal ones by name).

Defined results: a URL that is null or has no ``://`` has an empty host and path and no rule; its host is
the empty one, which has a reputation like any other. Null outcomes are not counted. Repeated rows count
as often as they are there. Without any outcome the mean is 0.5. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import scratch, written

#: Deviations below the mean that the posterior must hold, and the share of good pages asked for.
BOUND, LEAST_GOOD = 1.645, 0.5
#: Limits of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


def located(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path``: the host is lower-cased (A-Z), the path ends at ``?``, ``#`` or the end."""
    after = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.select("page_id", "url", F.translate(host, upper, lower).alias("host"), path.alias("path"))


def _rule_of(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        fits &= F.col("path").startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the strength of the prior whose means are ``prior``, for groups of ``n`` pages, ``good`` of them.

    Under a beta-binomial of strength k the squared distance of a group's share from its prior has mean
    ``p(1-p)/n * (1 + (n-1)/(k+1))``, which is solved for k over the sum of all groups.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    share = F.col("good") / F.col("n")
    seen = F.sum(F.col("n") * (share - F.col("prior")) * (share - F.col("prior")))
    alone, extra = F.sum(spread), F.sum(spread * (F.col("n") - 1))
    k = F.when(seen > alone, extra / (seen - alone) - 1).otherwise(STRONGEST)
    return groups.agg(F.coalesce(F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), k)), F.lit(WEAKEST)).alias("strength"))


def _posterior(groups: DataFrame) -> DataFrame:
    """Adds ``mean`` and ``strength_after`` of each group's posterior."""
    groups = groups.crossJoin(F.broadcast(_strength(groups.where("n > 0"))))  # one row
    after = F.col("n") + F.col("strength")
    return groups.withColumn("mean", (F.col("good") + F.col("prior") * F.col("strength")) / after).withColumn("after", after).drop("prior", "strength")


def reputations(hosts: DataFrame, suffixes: Collection[str] = ()) -> DataFrame:
    """``host, n, mean, after`` from ``host, n, good``: each host's posterior and its strength.

    ``suffixes`` has public suffixes of two labels, such as ``co.uk``; all others are the last label.
    Hosts are written once, and every level above is made of the written one below.
    """
    folder = scratch(hosts.sparkSession)
    parts = F.split("host", "\\.")
    last = lambda n: F.array_join(F.slice(F.reverse(parts), 1, n), ".")
    two = last(2).isin([".".join(reversed(s.split("."))) for s in suffixes]) if suffixes else F.lit(False)
    levels = hosts.withColumn("suffix", F.when(two, last(2)).otherwise(last(1))).withColumn("domain", F.when(two, last(3)).otherwise(last(2)))
    hosts = written(levels, f"{folder}/hosts")
    domains = written(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), f"{folder}/domains")
    suffixes = written(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), f"{folder}/suffixes")
    overall = suffixes.agg(F.coalesce(F.sum("good") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.5)).alias("prior"))
    above = _posterior(written(suffixes.crossJoin(F.broadcast(overall)), f"{folder}/suffix-priors"))  # one row
    above = above.select("suffix", F.col("mean").alias("prior"))
    above = _posterior(written(domains.join(above, "suffix"), f"{folder}/domain-priors")).select("domain", F.col("mean").alias("prior"))
    return _posterior(written(hosts.join(above, "domain"), f"{folder}/host-priors")).select("host", "n", "mean", "after")


def judged(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...], suffixes: Collection[str] = ()) -> DataFrame:
    """``page_id, host, path, rule, verdict, mean, lower`` of every page.

    ``outcomes`` has ``page_id`` and ``good`` (0 or 1) of labelled pages.
    """
    found = located(pages)
    by_page = outcomes.where("page_id is not null and good is not null").groupBy("page_id").agg(F.avg("good").alias("good"))
    name, verdict = _rule_of(rules)
    seen = found.join(by_page, "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"))
    lower = F.col("mean") - BOUND * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("after") + 1))
    own = reputations(hosts, suffixes).select("host", "mean", lower.alias("lower"))
    return found.join(own, "host").select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("lower") >= LEAST_GOOD, "allow").otherwise("block")).alias("verdict"),
        "mean", "lower",
    )
