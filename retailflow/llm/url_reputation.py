"""URL filters: empirical-Bayes host reputation.

A page that a path rule decides is a labelled outcome (blocked = 1, allowed =
0). Outcomes are counted per host, registered domain and suffix. Each level's
beta prior has the mean of the level above and a strength fitted to the spread
of that level's block rates (method of moments), so a host with few outcomes
leans on its domain, a domain on its suffix, a suffix on the whole table. A
page without a rule is blocked when the lower bound of its host's posterior
block rate is above the threshold.

Only counts are shuffled: pages are pre-aggregated by host before anything
moves, and the host table comes back by an ordinary join (AQE splits a host
that holds a large share of the rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import ascii_lower, stored

#: Lower bound: posterior mean minus Z standard deviations; blocked above THRESHOLD.
Z, THRESHOLD = 1.64, 0.5
#: Prior strengths (in pages) are kept within these bounds.
WEAKEST, STRONGEST = 1.0, 1000.0

#: The path rules, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/ ? #``; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (``host + path``) and its verdict; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == F.lit(h)) | host.endswith(F.lit("." + h))) & path.startswith(F.lit(p))
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column) -> Column:
    """The last two labels (the whole host if it has fewer)."""
    return F.substring_index(host, ".", -2)


def host_suffix(host: Column) -> Column:
    """The last label."""
    return F.substring_index(host, ".", -1)


def _strength(df: DataFrame) -> float:
    """The prior strength of a level (``n, bad, prior``) by the method of moments.

    With n outcomes of rate p around mean m, E[n (p-m)^2] = m (1-m) (1 + (n-1) r),
    where r = 1 / (strength + 1). Summed over the level's rows this gives r.
    """
    mean = F.col("prior")
    noise = mean * (1 - mean)
    spread = F.col("n") * (F.col("bad") / F.col("n") - mean) * (F.col("bad") / F.col("n") - mean)
    sums = df.where(F.col("n") > 0).agg(F.sum(spread).alias("a"), F.sum(noise).alias("b"),
                                        F.sum(noise * (F.col("n") - 1)).alias("c"))
    r = F.round((F.col("a") - F.col("b")) / F.col("c"), 9)
    strength = F.when(F.coalesce(F.col("c"), F.lit(0.0)) <= 0, F.lit(STRONGEST)) \
        .when(r <= F.lit(1 / (STRONGEST + 1)), F.lit(STRONGEST)) \
        .otherwise(F.greatest(F.lit(WEAKEST), 1 / r - 1))
    return sums.select(strength.alias("strength")).first()["strength"]


def reputation(pages: DataFrame) -> DataFrame:
    """Host reputations from ``host, outcome`` rows (outcome 1 bad, 0 good, null unknown).

    One row per host: ``host, n, bad, mean, sd``: outcomes, bad ones, posterior
    mean and standard deviation. Hosts without outcomes get their prior. The counts
    by host are stored once; the rate and the three prior strengths are numbers computed from them. An empty
    table gives no rows; without any outcome every mean is 0.5.
    """
    hosts = pages.groupBy("host").agg(
        F.count("outcome").cast("double").alias("n"),
        F.coalesce(F.sum("outcome"), F.lit(0)).cast("double").alias("bad"))
    hosts = stored(hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": host_suffix(F.col("host"))}), "url-hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0.0)) + 0.5)
                          / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1.0)).alias("prior")).first()["prior"]

    def shrunk(level: DataFrame, name: str) -> DataFrame:
        level = stored(level, f"url-{name}")
        strength = F.lit(_strength(level))
        return level.withColumn("strength", strength) \
            .withColumn("mean", (F.col("bad") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength")))

    s = shrunk(suffixes.withColumn("prior", F.lit(total)), "suffixes")
    d = shrunk(domains.join(s.select("suffix", F.col("mean").alias("prior")), "suffix"), "domains")
    h = shrunk(hosts.join(d.select("suffix", "domain", F.col("mean").alias("prior")), ["suffix", "domain"]), "priors")
    variance = F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("strength") + 1)
    return h.select("host", "n", "bad", "mean", F.sqrt(variance).alias("sd"))


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
                z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule decides the pages that it fits (the longest wins); the others are
    blocked when the lower posterior bound ``mean - z * sd`` of their host's
    block rate is above ``threshold``, else allowed. Null urls and urls
    without ``://`` have an empty host and path, fit no rule and share the
    reputation of the empty host. Repeated rows give repeated rows, a null id
    stays null, an empty table gives an empty result, other columns are ignored.
    """
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    parsed = src.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rule, decided = rule_columns(F.col("host"), F.col("path"), rules)
    judged = parsed.withColumns({"rule": rule, "decided": decided})
    outcome = F.when(F.col("decided") == "block", 1).when(F.col("decided") == "allow", 0)
    rep = reputation(judged.select("host", outcome.alias("outcome")))
    bad = F.round(F.col("mean") - F.lit(z) * F.col("sd"), 9) > F.lit(threshold)
    hosts = rep.select("host", F.when(bad, F.lit("block")).otherwise(F.lit("allow")).alias("by_host"))
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("decided", "by_host").alias("verdict"))
