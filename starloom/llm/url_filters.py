"""URL filters: written rules first, then an empirical-Bayes reputation of the host.

Labelled pages are outcomes, bad or not. They are counted by host, registered domain and suffix. Each level has a
beta-binomial prior: its mean is the posterior mean of the level above (the suffixes': the rate of all outcomes), its
strength is estimated from how far the counts of that level scatter around those means. So a host with few outcomes is
drawn to its domain, a domain with few to its suffix. A page is blocked where even the lower bound of its host's
posterior bad rate is above the limit.

All work is on distinct hosts: pages are pre-aggregated before every shuffle, and meet the hosts in one join at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import lower_ascii, written

# Fixed values of the contract: rule and verdict.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@dataclass(frozen=True)
class Policy:
    """Block where the bad rate is above `limit` with about 95 % credibility (`z` standard deviations below the mean)."""

    limit: float = 0.5
    z: float = 1.645
    # Between-group correlation is kept inside these, so that a prior is worth 1 to 9999 outcomes.
    least_correlation: float = 0.0001
    most_correlation: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z) and path of a URL; both empty where it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The registered domain: the last two labels of a host (all of it, if it has fewer)."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def outcomes(pages: DataFrame, labels: DataFrame, document: Column, url: str = "url") -> DataFrame:
    """(host, n, bad) of every host: its labelled pages, and how many of those are bad.

    A page's label is that of the document it shows, `document` giving its id; a label is bad with quality 0 or toxic 1,
    and says nothing where both are null. Several labels of a document are bad if one is. A document counts once for a
    host, however often its page is repeated; pages without label, document or host give their host with n = 0.
    """
    host, _ = host_and_path(F.col(url))
    shown = pages.select(host.alias("host"), document.cast("long").alias("document")).distinct()
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.filter("quality IS NOT NULL OR toxic IS NOT NULL").groupBy(F.col("doc_id").alias("document")).agg(F.max(bad).alias("bad"))
    return shown.join(known, "document", "left").groupBy("host").agg(F.count("bad").alias("n"), F.count_if("bad").alias("bad"))


def _strength(groups: DataFrame, policy: Policy) -> float:
    """What the prior of a level is worth in outcomes: moments of (n, bad) around `mean`, the means of the level above.

    Terms are rounded and summed as decimals, so the strength does not depend on the order of rows.
    """
    n, k, m = F.col("n").cast("double"), F.col("bad").cast("double"), F.col("mean")
    chance = m * (1 - m)
    terms = {"seen": (k - n * m) * (k - n * m), "chance": n * chance, "pairs": n * (n - 1) * chance}
    sums = groups.agg(*[F.coalesce(F.sum(F.round(x, 9).cast("decimal(38,9)")), F.lit(0)).cast("double").alias(t) for t, x in terms.items()]).first()
    within = (sums["seen"] - sums["chance"]) / sums["pairs"] if sums["pairs"] > 0 else policy.most_correlation
    return 1 / max(policy.least_correlation, min(policy.most_correlation, within)) - 1


def _shrunk(groups: DataFrame, policy: Policy) -> DataFrame:
    """Add the parameters of each group's posterior, a and b, and its mean as `rate`."""
    strength = F.lit(_strength(groups, policy))
    a, b = strength * F.col("mean") + F.col("bad"), strength * (1 - F.col("mean")) + F.col("n") - F.col("bad")
    return groups.withColumns({"a": a, "b": b}).withColumn("rate", F.col("a") / (F.col("a") + F.col("b")))


def reputation(hosts: DataFrame, policy: Policy | None = None) -> DataFrame:
    """(host, n, bad, rate, bound): posterior mean and lower bound of each host's bad rate, from (host, n, bad).

    Domains and suffixes are sums of hosts; the empty host takes no part in them and stands at the rate of all. Without
    any outcome every rate is one half and no bound is high. The counts are written once and read by all levels; the
    driver gets the sums of a level, never its rows.
    """
    policy = policy or Policy()
    counted = written(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    real = counted.filter("host <> ''")
    domains = real.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    everything = F.lit((bad + 1) / (n + 2))
    by_suffix = _shrunk(suffixes.withColumn("mean", everything), policy).select("suffix", F.col("rate").alias("mean"))
    by_domain = _shrunk(domains.join(by_suffix, "suffix"), policy).select("domain", F.col("rate").alias("mean"))
    shrunk = _shrunk(real.join(by_domain, "domain"), policy)
    total = F.col("a") + F.col("b")
    deviation = F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))
    rows = shrunk.select("host", "n", "bad", "rate", (F.col("rate") - policy.z * deviation).alias("bound"))
    return rows.union(counted.filter("host = ''").select("host", "n", "bad", everything.alias("rate"), F.lit(0.0).alias("bound")))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; of rules of equal length the first.

    A rule is a host, with all subdomains, and the beginning of a path. The list is a parameter, not data.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0]))[::-1]:
        name, slash, rest = rule.partition("/")
        below = (host == name) | host.endswith(f".{name}")
        found = F.when(below & path.startswith(slash + rest), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def judged(pages: DataFrame, hosts: DataFrame, url: str = "url", rules: list[tuple[str, str]] = RULES, policy: Policy | None = None) -> DataFrame:
    """(page, host, path, rule, verdict, n_labelled, n_bad, bad_rate, bad_bound) for every row of pages, kept as a struct.

    `hosts` is (host, n, bad), as from `outcomes`; hosts that it lacks are judged like the empty one, by no bound. A rule
    that fits decides; else the posterior bound does. Null URLs have an empty host and path and are allowed; repeated
    rows stay, columns of any name stay inside `page`, empty tables give no rows, URLs of any length are read whole.
    """
    policy = policy or Policy()
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.struct("*").alias("page"), host.alias("host"), path.alias("path"))
    known = reputation(hosts, policy).select("host", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), F.round("rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bad_bound"))
    by_method = F.when(F.col("bad_bound") > policy.limit, "block").otherwise("allow")
    found = rows.join(known, "host", "left").withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    return found.select("page", "host", "path", F.col("fits.rule").alias("rule"), F.coalesce("fits.verdict", by_method).alias("verdict"), "n_labelled", "n_bad", "bad_rate", "bad_bound")
