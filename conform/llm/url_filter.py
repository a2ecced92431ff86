"""URL filter: explicit host/path rules first, an empirical-Bayes host reputation for the rest.

Reputation: of every host the labelled pages n and the bad ones b are counted. The bad rate of a host gets
a beta prior whose mean is the shrunk rate of its registered domain, that of the domain one around its
suffix, that of the suffix one around the whole set. How strongly a level is drawn to the next one is
estimated from the counts themselves (moment estimator of the beta-binomial's overdispersion). A host is
blocked if the lower bound of its posterior bad rate reaches a threshold: one with few labels only if its domain's and
suffix's pages leave little doubt.

DataFrame functions only. Everything grows with the number of hosts after one partial aggregation;
three numbers a level come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.llm.common import ascii_lower

# The rules of the contract.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

LEVELS = ("host", "domain", "suffix")

# Public suffixes of two labels. All others are taken to have one; a fuller list may be put here.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "net.uk", "org.uk", "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "com.au", "net.au", "org.au", "co.nz", "org.nz",
            "co.za", "org.za", "com.br", "net.br", "org.br", "com.cn", "net.cn", "org.cn", "com.mx", "com.ar", "com.tr", "co.in", "co.kr", "or.kr",
            "com.sg", "com.hk", "com.tw", "org.tw", "co.il", "co.id", "com.my", "com.ph", "com.ua", "com.pl")
ADDRESS = "address"


@dataclass(frozen=True)
class Reputation:
    """``bound_z`` standard deviations below the posterior mean is the bound; ``threshold`` blocks."""

    threshold: float = 0.5
    bound_z: float = 1.645
    min_strength: float = 2.0
    max_strength: float = 1000.0


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after(url), r"^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.regexp_replace(_after(url), r"^[^/?#]*", "")
    return F.coalesce(F.regexp_extract(rest, r"^[^?#]*", 0), F.lit(""))


def _after(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))


def site_of(host: Column) -> Column:
    """The host without a port."""
    return F.regexp_replace(host, r":[0-9]*$", "")


def _is_address(site: Column) -> Column:
    return site.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$") | site.startswith("[")


def suffix_of(site: Column) -> Column:
    """Public suffix: one of ``SUFFIXES``, else the last label; addresses have one of their own."""
    two = F.substring_index(site, ".", -2)
    return F.when(_is_address(site), F.lit(ADDRESS)).when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(site, ".", -1))


def domain_of(site: Column) -> Column:
    """Registered domain: the public suffix and the label before it; an address is one as it is."""
    return F.when(_is_address(site), site).when(F.substring_index(site, ".", -2).isin(*SUFFIXES), F.substring_index(site, ".", -3)) \
        .otherwise(F.substring_index(site, ".", -2))


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; of equally long ones that with the longer host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    def split(r: str) -> tuple[str, str]:
        h, _, p = r.partition("/")
        return h, "/" + p
    for says, text in sorted(rules, key=lambda r: (len(r[1]), len(split(r[1])[0]))):
        h, p = split(text)
        fits = ((host == F.lit(h)) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _strength(counts: DataFrame, conf: Reputation) -> tuple[float, float]:
    """(bad rate, prior strength) over the units of a level; one row of sums comes to the driver."""
    c = counts.where("n > 0").select(F.col("n").cast("double").alias("n"), F.col("b").cast("double").alias("b"))
    s = c.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("b").alias("b"),
              F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("b") * F.col("b") / F.col("n")).alias("r")).first()
    if not s["n"]:
        return 0.5, conf.min_strength
    k, n, p = s["k"], s["n"], s["b"] / s["n"]
    spread = s["r"] - n * p * p                      # sum of n * (rate - p)^2
    noise, room = p * (1 - p), n - s["nn"] / n - (k - 1)
    if noise <= 0 or room <= 0:
        return p, conf.max_strength
    rho = (spread - noise * (k - 1)) / (noise * room)
    strength = (1 - rho) / rho if rho > 0 else conf.max_strength
    return p, min(max(strength, conf.min_strength), conf.max_strength)


def reputation(hosts: DataFrame, conf: Reputation = Reputation()) -> DataFrame:
    """(host, n, b) -> (host, n, b, bad_rate, bound). Hosts without labels get their domain's prior.

    Null counts count as zero. An empty table gives an empty one.
    """
    h = hosts.select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("b", F.lit(0)).alias("b"),
                     domain_of(site_of(F.col("host"))).alias("domain"))
    d = h.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).withColumn("suffix", suffix_of(F.col("domain")))
    s = d.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    all_rate, m_s = _strength(s, conf)
    _, m_d = _strength(d, conf)
    _, m_h = _strength(h, conf)

    def shrunk(m: float, prior: Column) -> Column:
        return (F.lit(m) * prior + F.col("b")) / (F.lit(m) + F.col("n"))

    s = s.select("suffix", shrunk(m_s, F.lit(all_rate)).alias("suffix_rate"))
    d = d.join(s, "suffix", "left").select("domain", shrunk(m_d, F.col("suffix_rate")).alias("domain_rate"))
    out = h.join(d, "domain", "left").withColumn("bad_rate", shrunk(m_h, F.col("domain_rate")))
    sd = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.lit(m_h) + F.col("n") + 1))
    return out.select("host", "n", "b", "bad_rate", (F.col("bad_rate") - F.lit(conf.bound_z) * sd).alias("bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
                conf: Reputation = Reputation()) -> DataFrame:
    """Verdict for every row of ``pages`` (page_id, url).

    ``outcomes`` holds labelled pages: (host, bad), bad 1 or 0 (null: not labelled). Output: page_id, host,
    path, rule, verdict, host_labelled, host_bad, bad_bound (4 digits).
    A null url, or one without ``://``, has an empty host and path and is judged by the reputation of the
    empty host. Repeated rows come out as often as they came in; other columns are not read.
    """
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    counted = (outcomes.select("host", F.col("bad").cast("long").alias("bad"))
               .unionByName(seen.select("host", F.lit(None).cast("long").alias("bad")))
               .groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("b")))
    rep = reputation(counted, conf).select(
        F.col("host").alias("__host"), F.col("n").alias("host_labelled"), F.col("b").alias("host_bad"),
        F.col("bound").alias("__bound"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    judged = seen.join(rep, seen["host"] == rep["__host"], "left")
    by_method = F.when(F.col("__bound") >= conf.threshold, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"),
                         "host_labelled", "host_bad", F.round("__bound", 4).alias("bad_bound"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled pages of the synthetic tables: a url's last path part starts with the id of the document that
    the page shows, and ``labels`` marks documents. Bad: quality 0 or toxic 1 (repeated labels: any of them)."""
    doc = F.regexp_extract(url_path(F.col("url")), r"/(\d{1,18})[^/]*/?$", 1)
    shown = pages.select(url_host(F.col("url")).alias("host"), doc.alias("doc")).where("doc <> ''")
    shown = shown.select("host", F.col("doc").cast("long").alias("doc"))
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    marked = (labels.where("quality is not null or toxic is not null")
              .groupBy(F.col("doc_id").alias("doc")).agg(F.max(bad).alias("bad")))
    return shown.join(marked, "doc", "inner").select("host", "bad")
