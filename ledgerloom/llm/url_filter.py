"""URL filters by empirical-Bayes host reputation (DataFrame operations).

Labelled page outcomes (bad or not) are counted per host and shrunk through
beta-binomial priors: a suffix towards the rate of all pages, a registered
domain towards its suffix, a host towards its registered domain. The strength
of each prior is the moment estimate of the over-dispersion between the
children of a level. A host is blocked when the lower bound of its posterior
bad rate is above ``BLOCK_ABOVE``; a host without outcomes is judged by its prior
alone, the rate and spread that its domain, its suffix or all pages give it. Listed rules come before reputation.

Cases: a null url, or one without ``://``, has an empty host and path, fits no
rule, and is judged by the rate of all pages; without any outcome the prior
rate is ``NO_OUTCOME_RATE``; repeated pages count once each; a doc_id labelled
several times counts as bad if any of its labels is; an empty table gives no
rows. Only page_id, url, doc_id and quality are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

#: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Suffixes of two labels; any other suffix is the last label.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
BLOCK_ABOVE, Z, NO_OUTCOME_RATE = 0.5, 1.64, 0.1
SALTS = 32
#: Over-dispersion is kept within these bounds (prior strength 1 / rho - 1).
LEAST_RHO, MOST_RHO = 0.001, 0.9


def host_and_path(url: Column) -> tuple[Column, Column]:
    parts = r"://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(url, parts, 1)), F.regexp_extract(url, parts, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for own, prefix, say in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        rule, verdict = F.when(fits, own + prefix).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    two = F.substring_index(host, ".", -2)
    suffix = F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)
    return domain, suffix


def outcomes_from_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, bad): a page's outcome is the quality label of the document whose number ends its path."""
    host, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"/(\d{1,18})(?:\.html|/)?$", 1)
    seen = pages.select(host.alias("host"), F.when(number != "", number).cast("long").alias("doc_id")).where("doc_id is not null")
    judged = labels.where("quality is not null").groupBy("doc_id").agg((F.min("quality") == 0).cast("long").alias("bad"))
    return seen.join(judged, "doc_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))


def _strength(children: DataFrame) -> float:
    """Prior strength from the spread of children (n, bad) around their prior rates m."""
    m, n = F.col("m"), F.col("n")
    noise = m * (1 - m)
    s, base, room = children.where("n > 0").agg(
        F.sum(n * F.pow(F.col("bad") / n - m, 2.0)), F.sum(noise), F.sum((n - 1) * noise)
    ).first()  # three numbers
    rho = (s - base) / room if room else MOST_RHO
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def _bound(rate: Column, n, k) -> Column:
    """Lower bound of the bad rate after n outcomes on a prior of strength k."""
    return rate - Z * F.sqrt(rate * (1 - rate) / (n + k + 1))


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, tuple[Column, Column]]:
    """Posteriors (rate, bound) by host; (rate, bound) of a host without outcomes by its
    domain, by its suffix (of a domain without outcomes), and by all pages."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = stored(outcomes.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()  # two numbers
    rate = bad / n if n and 0 < bad < n else NO_OUTCOME_RATE if not n else min(max(bad / n, 0.5 / n), 1 - 0.5 / n)

    def shrunk(children: DataFrame) -> tuple[DataFrame, Column]:
        k = F.lit(_strength(children))
        return children.withColumn("rate", (F.col("bad") + k * F.col("m")) / (F.col("n") + k)), k

    total = lambda *by: hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    everything, r = F.lit(float(rate)), F.col("rate")
    suffixes, k_suffix = shrunk(total("suffix").withColumn("m", everything))
    rates = suffixes.select("suffix", r.alias("m"))
    domains, k_domain = shrunk(total("domain", "suffix").join(rates, "suffix"))
    own, k_host = shrunk(hosts.join(domains.select("domain", r.alias("m")), "domain"))
    return (
        own.select("host", "rate", _bound(r, F.col("n"), k_host).alias("bound")),
        domains.select("domain", "rate", _bound(r, 0, k_host).alias("bound")),
        suffixes.select("suffix", "rate", _bound(r, 0, k_domain).alias("bound")),
        (everything, _bound(everything, 0, k_suffix)),
    )


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the posterior bad rate with its lower bound."""
    hosts, domains, suffixes, everything = reputation(outcomes_from_labels(pages, labels))
    host, path = host_and_path(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    # reputations of the hosts that pages have, looked up per distinct host
    domain, suffix = domain_and_suffix(F.col("host"))
    known = (
        seen.select("host").distinct().withColumn("domain", domain).withColumn("suffix", suffix)
        .join(hosts, "host", "left")
        .join(domains.toDF("domain", "domain_rate", "domain_bound"), "domain", "left")
        .join(suffixes.toDF("suffix", "suffix_rate", "suffix_bound"), "suffix", "left")
        .select(
            "host", F.coalesce("rate", "domain_rate", "suffix_rate", everything[0]).alias("bad_rate"),
            F.coalesce("bound", "domain_bound", "suffix_bound", everything[1]).alias("bound"),
        )
    )
    rule, say = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > BLOCK_ABOVE, "block").otherwise("allow")
    # a host may hold a third of all pages: its pages are dealt over SALTS tasks
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    seen = seen.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    return seen.join(salted, ["host", "salt"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(say, own).alias("verdict"),
        F.round("bad_rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bad_rate_bound"),
    )
