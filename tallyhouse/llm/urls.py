"""URL filters: host rules, and reputations of hosts learned from labelled pages.

Native columns throughout.  The share of bad pages of a host is shrunk towards
that of its registered domain, that towards its suffix, and that towards all
pages, each through a beta-binomial prior whose strength comes from the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.common import let, small, stored

#: Rules as (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Rules that fit one expression.  Each page is held against each of them.
MAX_RULES = 10_000

#: A host is blocked when its share of bad pages is above ``BLOCK_ABOVE`` even
#: at the lower bound of the posterior, ``BOUND`` deviations below its mean.
BLOCK_ABOVE = 0.5
BOUND = 1.645

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def domain_of(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else NULL.

    A rule fits its host, all subdomains of it, and paths that begin with its path.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES} fit one expression")
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in reversed(ordered):
        fits = (
            (host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))
        ) & F.startswith(path, F.lit(rule_path))
        named = F.struct(
            F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")
        )
        chosen = F.when(fits, named).otherwise(chosen)
    return chosen


def _strength(groups: DataFrame, mean: str) -> Column:
    """Prior strength by moments, from n and bad of groups and their parents' means.

    With ``v = mean (1 - mean)`` a group's ``n (bad/n - mean)^2`` is expected to
    be ``v (1 + (n - 1) rho)``; ``rho`` is kept within 0.0001 and 0.5.
    """
    m, n = F.col(mean), F.col("n")
    v = m * (1 - m)
    seen = n > 0
    spread = F.sum(F.when(seen, n * F.pow(F.col("bad") / n - m, 2)))
    rho = (spread - F.sum(F.when(seen, v))) / F.nullif(F.sum(F.when(seen, v * (n - 1))), F.lit(0.0))
    bounded = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1e-4)), F.lit(0.5))
    return 1 / bounded - 1


def host_reputations(hosts: DataFrame) -> DataFrame:
    """(host, n, bad, alpha, beta, lower) of hosts (host, n, bad), one row per host.

    Level by level: the mean of a group is ``(bad + k parent) / (n + k)`` with the
    strength ``k`` of its level.  A host without labelled pages gets its domain's
    mean.  Without any labelled page the overall mean is 0.
    """
    counted = stored(
        hosts.select(
            "host", suffix_of(F.col("host")).alias("suffix"), domain_of(F.col("host")).alias("domain"),
            F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"),
        ),
        "hosts",
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = counted.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    overall = suffixes.agg(
        (F.coalesce(F.sum("bad"), F.lit(0.0)) / F.greatest(F.sum("n"), F.lit(1.0))).alias("parent")
    )

    def shrunk(groups: DataFrame, name: str) -> DataFrame:
        groups = stored(groups, name)
        k = groups.agg(_strength(groups, "parent").alias("k"))
        # One row beside each group: a scalar, broadcast.
        held = groups.join(F.broadcast(k), how="cross").drop("row")
        return held.withColumn(
            "mean", (F.col("bad") + F.col("k") * F.col("parent")) / (F.col("n") + F.col("k"))
        )

    by_suffix = shrunk(suffixes.join(F.broadcast(overall), how="cross"), "suffixes")
    parents = by_suffix.select("suffix", F.col("mean").alias("parent"))
    by_domain = shrunk(domains.join(parents, "suffix"), "domains")
    parents = by_domain.select("suffix", "domain", F.col("mean").alias("parent"))
    by_host = shrunk(counted.join(parents, ["suffix", "domain"]), "host-parents")
    alpha = F.col("k") * F.col("parent") + F.col("bad")
    beta = F.col("k") * (1 - F.col("parent")) + F.col("n") - F.col("bad")
    posterior = by_host.select("host", "n", "bad", alpha.alias("alpha"), beta.alias("beta"))
    total = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / total
    return posterior.withColumn("lower", mean - BOUND * F.sqrt(mean * (1 - mean) / (total + 1)))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    block_above: float = BLOCK_ABOVE,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, lower) of every page.

    ``outcomes`` has (page_id, bad): whether a labelled page turned out bad; a
    page that has several is bad when one of them is, NULL outcomes are passed over.

    * A NULL url, or one without ``://``, has an empty host and path; such pages
      make one host of their own.
    * A rule's verdict goes before the reputation.
    * Repeated pages are judged alike, each row counted by its host.
    * Empty tables: no pages give no rows, no outcomes block nothing.
    """
    url = F.col("url")
    # Hosts are shared by many pages: what pages say of them is combined first.
    located = stored(
        pages.select("page_id", url_host(url).alias("host"), url_path(url).alias("path")), "page-urls"
    )
    known = (
        outcomes.filter("bad IS NOT NULL AND page_id IS NOT NULL")
        .groupBy("page_id")
        .agg(F.max(F.col("bad").cast("int")).alias("bad"))
    )
    hosts = (
        located.select("page_id", "host")
        .join(known, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    reputations = stored(host_reputations(hosts).select("host", "lower"), "reputations")
    judged = located.join(small(reputations, 256), "host")
    found = judged.withColumn(
        "found", matching_rule(F.col("host"), F.col("path"), rules)
    )
    learned = F.when(F.col("lower") > block_above, F.lit("block")).otherwise(F.lit("allow"))
    return found.select(
        "page_id", "host", "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), learned).alias("verdict"),
        "lower",
    )


def labelled_outcomes(labels: DataFrame) -> DataFrame:
    """(page_id, bad) from the label table: poor quality or toxic is bad."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def url_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_urls(pages, labelled_outcomes(labels)).drop("lower")
