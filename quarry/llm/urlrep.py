"""URL filters: explicit host and path rules first, host reputation else.

Reputation is empirical Bayes: labelled page outcomes are beta-binomial
counts, shrunk from host to registered domain to public suffix to the whole
corpus, and a host is blocked when the posterior bound of its bad share is
too high. Counts shuffle once by host with map-side sums; the levels above
are aggregated from host counts, never from pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import maybe_broadcast, written

#: Public suffixes of two labels that are common in crawls; fixed values, replaceable by a parameter.
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br",
    "com.cn", "com.mx", "com.ar", "com.tr", "co.in", "co.kr", "co.za", "com.sg", "com.hk", "com.tw", "co.il",
)


@dataclass(frozen=True)
class Reputation:
    """A host is blocked when mean - ``z`` standard deviations of its posterior bad share exceeds ``max_bad``."""

    z: float = 1.645
    max_bad: float = 0.5
    two_label_suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, two: Sequence[str]) -> Column:
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    last_two = F.substring_index(name, ".", -2)
    return F.when(last_two.isin(*two), last_two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    n = F.size(F.split(suffix, "\\.")) + 1
    labels = F.split(name, "\\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule, or null. ``rules``: (verdict, ``host/path``); a bounded list, as it becomes part of the plan."""
    cases = []
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        cut = rule.index("/")
        own, prefix = rule[:cut], rule[cut:]
        fits = (host == own) | host.endswith("." + own)
        cases.append(F.when(fits & path.startswith(prefix), F.lit(rule)))
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def _spread(groups: DataFrame) -> float:
    """Prior strength by moments: how little the groups' rates differ beyond chance from the rate ``m`` expected above.

    ``groups``: n, bad, m. Five sums over the level; with no sign of
    difference the strength is capped, so that every group takes its parent's rate."""
    v = F.col("m") * (1 - F.col("m"))
    row = groups.filter("n > 0").agg(
        F.sum(F.lit(1.0)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * v).alias("nv"), F.sum(v).alias("v"),
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), F.lit(2.0)) / F.col("n")).alias("s")).first()
    if not row["n"] or not row["nv"] or row["n"] <= row["k"]:
        return 1e6
    rho = (row["s"] - row["v"]) / (row["nv"] - row["v"]) if row["nv"] > row["v"] else 0.0
    rho = min(max(rho, 1e-6), 0.999999)
    return (1 - rho) / rho


def host_bounds(outcomes: DataFrame, conf: Reputation = Reputation()) -> DataFrame:
    """``host, n, bad, mean, lower`` from rows ``host, bad`` (0, 1 or null for unlabelled pages).

    Every host of the input gets a row; without labels its posterior is its domain's."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"),
                                         F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"))
    suffix = suffix_of(F.col("host"), conf.two_label_suffixes)
    hosts = written(hosts.withColumn("suffix", suffix).withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0.0) + 0.5) / ((total["n"] or 0.0) + 1.0)

    def sums(*keys):
        return hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def posterior(level):
        strength = F.lit(_spread(level))
        return level.withColumn("mean", (F.col("m") * strength + F.col("bad")) / (strength + F.col("n"))), strength

    suffixes, _ = posterior(written(sums("suffix").withColumn("m", F.lit(overall)), "suffixes"))
    up = suffixes.select("suffix", F.col("mean").alias("m"))
    domains, _ = posterior(written(sums("suffix", "domain").join(up, "suffix"), "domains"))
    up = domains.select("suffix", "domain", F.col("mean").alias("m"))
    own, strength = posterior(written(hosts.join(up, ["suffix", "domain"]), "host-priors"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (strength + F.col("n") + 1))
    return own.withColumn("lower", F.col("mean") - conf.z * sd).select("host", "n", "bad", "mean", "lower")


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = (), id_col: str = "page_id",
          url_col: str = "url", conf: Reputation = Reputation()) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``labels``: page_id, bad (0 or 1); rows with a null in either are left
    out, several labels of a page all count. Null urls have an empty host,
    which has a reputation like any other. Null and repeated page ids stay;
    other columns are not carried. No labels at all: every host is allowed. An empty page table gives no rows."""
    own = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    known = labels.select(F.col("page_id").alias("_id"), F.col("bad").alias("_bad")).filter("_id is not null and _bad is not null")
    outcomes = own.select("page_id", "host").join(known, own["page_id"] == known["_id"], "left").select("host", F.col("_bad").alias("bad"))
    blocked = host_bounds(outcomes, conf).filter(F.col("lower") > conf.max_bad).select(F.col("host").alias("_host"), F.lit("block").alias("_verdict"))
    blocked = maybe_broadcast(written(blocked, "blocked-hosts"), 256)
    df = own.join(blocked, own["host"] == F.col("_host"), "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.lit(None).cast("string")
    for v, rule in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(v)).otherwise(verdict)
    return df.select("page_id", "host", "path", "rule", F.coalesce(verdict, F.col("_verdict"), F.lit("allow")).alias("verdict"))
