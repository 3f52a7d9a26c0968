"""URL filter by the reputation of hosts, by empirical Bayes.

Labelled page outcomes (bad or not) are counted by host and shrunk down a tree of
beta-binomial priors: the suffix is drawn towards all pages, the registered domain towards
its suffix, the host towards its domain. How strongly is estimated from the counts
themselves, once for each level, by maximum likelihood over ``STRENGTHS``: as far as the
children's bad counts vary more than binomial draws with the parent's rate would, the prior
is weak. In the likelihood a child has one rate, however many outcomes it has, so that a host
with most of the rows doesn't decide for the others. A host is blocked when
the lower bound of its posterior rate, ``BOUND`` standard deviations below its mean, is
above ``LIMIT``.

Fixed rules go first: a rule names a host and a path, and fits the host and its subdomains
when the url's path starts with the rule's; the longest rule that fits decides.

A null url and one without ``://`` have an empty host and path; no rule fits an empty host,
and it is judged like any other host that has outcomes, or by the prior alone. Outcomes
without a page and pages without an outcome count for nothing; several outcomes of a page
count once, as bad if any is. Everything is built of DataFrame functions, and the join of
pages with hosts has one row for each host on the right, so that Spark can split the rows
of a frequent host.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm import rows

# Host, path and verdict.
Rule = tuple[str, str, str]
RULES: tuple[Rule, ...] = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# Suffixes of two names under which names are registered, besides those of one name.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "com.cn")
BOUND = 2.0
LIMIT = 0.5
# A prior is worth at least and at most so many outcomes.
WEAKEST, STRONGEST = 0.5, 1000.0
STRENGTHS = tuple(WEAKEST * (STRONGEST / WEAKEST) ** (i / 32) for i in range(33))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_replace(F.coalesce(_after_scheme(url), F.lit("")), r"(?s)[?#].*$", "")
    host = F.substring_index(rest, "/", 1)
    return rows.ascii_lower(host), F.substr(rest, F.length(host) + 1)


def registered(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; a bare suffix is its own domain."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*suffixes)
    suffix = F.when(long, two).otherwise(F.substring_index(host, ".", -1))
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(two), suffix


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of a positive number, by Stirling's series eight above it."""
    z = x + 8
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _strength(children: DataFrame) -> DataFrame:
    """One row: what the prior is worth, from ``n`` and ``bad`` of children and ``mean`` of their parents."""
    s, n, bad, mean = map(F.col, ("s", "n", "bad", "mean"))
    likelihood = (
        log_gamma(bad + s * mean) - log_gamma(s * mean) + log_gamma(n - bad + s * (1 - mean)) - log_gamma(s * (1 - mean))
        - log_gamma(n + s) + log_gamma(s)
    )
    # A single outcome is as likely under every strength.
    tried = children.where("n > 1").select("n", "bad", "mean", F.explode(F.array(*map(F.lit, STRENGTHS))).alias("s"))
    by_strength = tried.groupBy("s").agg(F.sum(likelihood).alias("likelihood"))
    return by_strength.agg(F.coalesce(F.max(F.struct("likelihood", "s"))["s"], F.lit(STRONGEST)).alias("strength"))


def _shrunk(children: DataFrame) -> DataFrame:
    """``children`` with their posterior means in ``rate`` and the prior's worth in ``strength``."""
    # The right side is one row of an aggregate without groups.
    joined = children.crossJoin(F.broadcast(_strength(children)))
    rate = (F.col("bad") + F.col("strength") * F.col("mean")) / (F.col("n") + F.col("strength"))
    return joined.withColumn("rate", rate)


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Posterior of every host with outcomes: ``host``, ``rate`` and ``lower``.

    ``outcomes`` has ``host`` and the boolean ``bad``. Beyond the first aggregate all
    frames have a row for each host, domain or suffix at most.
    """
    domain, suffix = registered(F.col("host"), suffixes)
    hosts = (
        outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix})
    )
    hosts = rows.written(hosts, "hosts")
    count = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    everything = hosts.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1.0)).alias("mean"))
    suffixes_ = hosts.groupBy("suffix").agg(*count).crossJoin(F.broadcast(everything))
    suffixes_ = _shrunk(suffixes_).select("suffix", F.col("rate").alias("mean"))
    domains = hosts.groupBy("suffix", "domain").agg(*count).join(suffixes_, "suffix")
    domains = _shrunk(domains).select("domain", F.col("rate").alias("mean"))
    posterior = _shrunk(hosts.join(domains, "domain"))
    worth = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (worth + 1))
    return posterior.select("host", "rate", (F.col("rate") - BOUND * deviation).alias("lower"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    limit: float = LIMIT,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the host's ``rate`` for every page.

    ``outcomes`` has ``page_id`` and the boolean ``bad``.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    seen = pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"), path.alias("path"))
    known = outcomes.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    labelled = seen.select("page_id", "host").join(known, "page_id").select("host", "bad")
    judged = seen.join(reputations(labelled), "host", "left")
    name, fixed = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("lower") > limit, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(fixed, learned).alias("verdict"), "rate"
    )


def label_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes from the label table: bad when of low quality or toxic."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    return labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).select(
        F.col("doc_id").alias("page_id"), bad.alias("bad")
    )
