"""URL filter by rules, and by an empirical-Bayes reputation of hosts where no rule fits.

Labelled pages are outcomes of their host: bad or not. A host's bad rate has a beta prior whose mean
is the posterior mean of its registered domain, whose prior is that of its suffix, whose prior is
the rate of all labelled pages. How strongly a level pulls is estimated from the spread of the
rates below it (method of moments for a beta-binomial). A host is blocked if the lower bound of its
posterior lies above a limit, so few or mixed outcomes block nothing.

Outcomes are counted per host in the map tasks, so a host with a third of all pages is one row per
task. Only a few sums per level reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.scratch import save

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


#: Rules of the result (fixed values).
RULES = (
    UrlRule("block", "net"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)
#: Suffixes of several labels that hold where the caller gives no table; all others are the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "com.cn")


@dataclass(frozen=True)
class Reputation:
    """Block where the posterior bad rate exceeds ``limit`` by ``deviations`` standard deviations."""

    limit: float = 0.5
    deviations: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 1000.0


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER), F.regexp_extract(text, pattern, 2)


def with_domain(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` (different ``host``) with ``suffix``, under which others register, and ``domain``, one label more.

    ``suffixes`` has a column ``suffix`` in the form of public suffix lists: ``co.uk``; ``*.ck`` for any
    label before ``ck``; ``!www.ck`` for a domain such a rule leaves out. The longest that fits counts,
    an exception before all others; where none fits, the last label is the suffix. The table may be of
    any size: a host meets it by its own last labels, as many as the widest rule has.
    """
    if suffixes is None:
        suffixes = hosts.sparkSession.createDataFrame([(s,) for s in SUFFIXES], "suffix string")
    rules = suffixes.select(F.translate(F.trim("suffix"), UPPER, LOWER).alias("key")).where("key <> ''").distinct()
    widest = rules.agg(F.max(F.size(F.split("key", r"\.")))).first()[0] or 1
    ends = F.expr(f"""transform(sequence(1, least({widest}, size(split(host, '[.]')))), i -> array(
        struct(substring_index(host, '.', -i) as key, false as exempt, i as labels),
        struct('*.' || substring_index(host, '.', -i) as key, false as exempt, i + 1 as labels),
        struct('!' || substring_index(host, '.', -i) as key, true as exempt, i - 1 as labels)))""")
    fitting = (
        hosts.select("host", F.inline(F.flatten(ends))).join(rules, "key").groupBy("host")
        .agg(F.max(F.struct("exempt", "labels")).alias("best")).select("host", F.col("best.labels").alias("labels"))
    )
    placed = hosts.join(fitting, "host", "left").withColumn("labels", F.coalesce("labels", F.lit(1)))
    return placed.withColumns({
        "suffix": F.expr("substring_index(host, '.', -labels)"),
        "domain": F.expr("substring_index(host, '.', -labels - 1)")}).drop("labels")


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. Of equal lengths the first counts."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def strength(groups: DataFrame, settings: Reputation) -> float:
    """Prior weight in outcomes, from rates of ``groups`` (n, bad) around their parents' rates (mean)."""
    rate = F.col("bad") / F.col("n")
    k, n, squares, between, within = groups.where("n > 0").agg(
        F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") * F.col("n")),
        F.sum(F.col("n") * (rate - F.col("mean")) * (rate - F.col("mean"))),
        F.sum(F.col("n") * rate * (1 - rate))).first()
    if not k or k < 2 or n <= k:
        return settings.least_strength
    typical = (n - squares / n) / (k - 1)
    mean_within = within / (n - k)
    spread = between / (k - 1) - mean_within
    total = spread + typical * mean_within
    share = spread / total if total > 0 else 0.0
    weight = 1 / share - 1 if share > 0 else settings.most_strength
    return min(settings.most_strength, max(settings.least_strength, weight))


def posteriors(outcomes: DataFrame, settings: Reputation = Reputation(), suffixes: DataFrame | None = None) -> DataFrame:
    """``(host, n, bad, mean, deviation)`` of every host in ``outcomes`` (host, n, bad)."""
    hosts = save(with_domain(save(outcomes, "outcomes"), suffixes), "hosts")
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    overall = bad / n if n else 0.0
    counted = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    ends = save(hosts.groupBy("suffix").agg(*counted).withColumn("mean", F.lit(float(overall))), "suffixes")

    def posterior(groups, weight):
        a = F.col("mean") * weight + F.col("bad")
        b = (1 - F.col("mean")) * weight + F.col("n") - F.col("bad")
        return groups.withColumns({"a": a, "b": b}).withColumn("rate", F.col("a") / (F.col("a") + F.col("b")))

    rated = posterior(ends, strength(ends, settings)).select("suffix", F.col("rate").alias("mean"))
    domains = save(hosts.groupBy("domain", "suffix").agg(*counted).join(rated, "suffix"), "domains")
    rated = posterior(domains, strength(domains, settings)).select("domain", F.col("rate").alias("mean"))
    leaves = save(hosts.join(rated, "domain"), "rated_hosts")
    return posterior(leaves, strength(leaves, settings)).select(
        "host", "n", "bad", F.col("rate").alias("mean"),
        F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("a") + F.col("b") + 1)).alias("deviation"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[UrlRule, ...] = RULES,
                settings: Reputation = Reputation(), suffixes: DataFrame | None = None) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``bad_rate``,
    ``lower_bound``.

    ``outcomes`` has ``page_id`` and ``bad`` (0 or 1) of labelled pages; a page with several counts as
    bad if one is, null outcomes count as none. The verdict is the longest fitting rule's, else block
    if the host's posterior lower bound is above the limit, else allow. A null URL, or one without
    ``://``, has an empty host and path, which is a host like any other. Without outcomes every rate is
    0 and nothing but rules blocks; where all outcomes are bad every rate is 1 and all hosts are blocked that
    no rule allows. Repeated pages count each time. Further columns are ignored.
    ``suffixes`` is a table of public suffixes, see :func:`with_domain`.
    """
    host, path = host_and_path("url")
    placed = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    counted = placed.join(known, "page_id", "left").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    rated = posteriors(counted, settings, suffixes).select(
        "host", F.col("mean").alias("bad_rate"), (F.col("mean") - settings.deviations * F.col("deviation")).alias("lower_bound"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return placed.join(rated, "host").select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("lower_bound") > settings.limit, "block").otherwise("allow")).alias("verdict"),
        "bad_rate", "lower_bound")
