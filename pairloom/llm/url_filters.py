"""URL filters: host rules first, then an empirical-Bayes reputation of the host.

Pages that a rule decides are the labelled outcomes: blocked or allowed. Each host's share of
blocked pages has a beta-binomial posterior whose prior is the posterior of its registered domain,
whose prior is that of the suffix, whose prior is the share of all labelled pages; a prior is as
wide as its parent's posterior and the spread of the parent's members together. How strongly
each level shrinks is estimated from the spread between its members (method of moments). A page
without a rule is blocked if the lower bound of its host's posterior lies above one half.

A null url, or one without `://`, has an empty host and path. Repeated rows are judged alike, and
each counts as an outcome; an empty table gives an empty result. Other columns are not read.
Null ids are kept, and a very long url is read whole.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.scratch import scratch_dir

BOUND = 1.645          # standard deviations below the mean
LIMIT = 0.5
LEAST_STRENGTH = 0.05
#: Suffixes of several labels, unless others are given; any other is the last label of a host.
WIDE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """host/path, which fits the host, its subdomains, and paths that start with /path."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        return (((host == name) | host.endswith("." + name)) & path.startswith("/" + rest))


def parse(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    scheme = F.instr(url, "://")
    rest = F.coalesce(F.when(scheme > 0, F.substr(url, scheme + F.lit(3))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _decision(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = rule.fits(host, path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def suffix_and_domain(host: Column, wide: Collection[str] = WIDE_SUFFIXES) -> tuple[Column, Column]:
    """The suffix of a host, the longest of `wide` if one fits, and it with the label before it."""
    suffix, domain = (F.substring_index(host, ".", -n) for n in (1, 2))
    of_labels: dict[int, list[str]] = {}
    for name in wide:
        of_labels.setdefault(name.count(".") + 1, []).append(name)
    for n, names in sorted(of_labels.items()):
        own = F.substring_index(host, ".", -n)
        fits = own.isin(*names)
        suffix = F.when(fits, own).otherwise(suffix)
        domain = F.when(fits, F.substring_index(host, ".", -n - 1)).otherwise(domain)
    return suffix, domain


def _strength(groups: DataFrame) -> float:
    """How many outcomes a prior is worth, from groups with n, bad and the prior's mean.

    The one row that comes back holds two sums. Rates spread by mu (1 - mu) (1 + (n - 1) rho) / n,
    and rho is 1 / (strength + 1).
    """
    mu, n = F.col("mean"), F.col("n")
    row = groups.where("n > 0").agg(
        F.sum(n * F.pow(F.col("bad") / n - mu, F.lit(2)) - mu * (1 - mu)).alias("excess"),
        F.sum(mu * (1 - mu) * (n - 1)).alias("room")).first()
    rho = (row.excess or 0.0) / row.room if row.room else 0.5
    return 1 / min(max(rho, 1e-3), 0.9) - 1


def _posterior(groups: DataFrame, strength: float) -> DataFrame:
    """`mean` and `spread` of the posterior in place of the parent's.

    The prior's variance is the parent's own and that between the parent's members.
    """
    mean = F.col("mean")
    wide = mean * (1 - mean)
    variance = F.col("spread") * F.col("spread") + wide / F.lit(strength + 1)
    worth = F.greatest(wide / variance - 1, F.lit(LEAST_STRENGTH))
    a = worth * mean + F.col("bad")
    b = worth * (1 - mean) + F.col("n") - F.col("bad")
    return groups.withColumns({
        "mean": a / (a + b),
        "spread": F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))})


def reputations(outcomes: DataFrame, wide: Collection[str] = WIDE_SUFFIXES) -> DataFrame:
    """host, mean and spread of the blocked share, from (host, blocked); null: no outcome.

    Each level is stored before the next joins it, so that the joins shuffle both sides
    themselves and can split a suffix or domain with very many hosts.
    """
    spark = outcomes.sparkSession
    folder = scratch_dir(spark, "reputation")

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def level(frame: DataFrame, *keys: str) -> DataFrame:
        return frame.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffix, domain = suffix_and_domain(F.col("host"), wide)
    counted = outcomes.groupBy("host").agg(
        F.count("blocked").alias("n"),
        F.sum(F.coalesce(F.col("blocked").cast("bigint"), F.lit(0))).alias("bad"))
    hosts = stored(counted.withColumns({"suffix": suffix, "domain": domain}), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n = (total.n or 0) + 1
    mean = ((total.bad or 0) + 0.5) / n
    root = {"mean": F.lit(mean), "spread": F.lit((mean * (1 - mean) / (n + 1)) ** 0.5)}

    def shrunk(groups: DataFrame, name: str) -> DataFrame:
        groups = stored(groups, f"{name}_counts")
        return stored(_posterior(groups, _strength(groups)), name)

    suffixes = shrunk(level(hosts, "suffix").withColumns(root), "suffix")
    domains = shrunk(level(hosts, "domain", "suffix").join(
        suffixes.select("suffix", "mean", "spread"), "suffix"), "domain")
    return shrunk(hosts.join(domains.select("domain", "suffix", "mean", "spread"),
                             ["domain", "suffix"]), "host").select("host", "mean", "spread")


def judge(pages: DataFrame, rules: list[Rule], *, id_col: str = "page_id",
          url_col: str = "url", wide: Collection[str] = WIDE_SUFFIXES) -> DataFrame:
    """One row per page: id_col, host, path, rule (null: none), verdict, blocked_share.

    wide: suffixes of several labels, such as those of a public list, in lower case.
    """
    host, path = parse(F.col(url_col))
    parsed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, decided = _decision(rules, F.col("host"), F.col("path"))
    parsed = parsed.withColumns({"rule": rule, "decided": decided})
    known = reputations(parsed.select("host", (F.col("decided") == "block").alias("blocked")),
                        wide)
    low = F.col("mean") - F.lit(BOUND) * F.col("spread")
    verdict = F.coalesce("decided", F.when(low > LIMIT, F.lit("block")).otherwise(F.lit("allow")))
    return parsed.join(known, "host", "left").select(
        id_col, "host", "path", "rule", verdict.alias("verdict"),
        F.col("mean").alias("blocked_share"))
