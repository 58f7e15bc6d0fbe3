"""URL filters: explicit rules first, then empirical-Bayes host reputation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.session import materialize

# Second labels under which country domains (of two letters) register names, and
# hosts under which a service gives names to unrelated sites.
SECOND_LABELS = (
    "ac", "co", "com", "ed", "edu", "ernet", "firm", "gen", "go", "gob", "gouv", "gov", "gv", "id", "ind", "inf", "info", "k12",
    "ltd", "me", "mil", "muni", "name", "ne", "net", "nhs", "nic", "nom", "or", "org", "plc", "police", "pro", "res", "sch",
    "school", "web",
)
SHARED_HOSTS = (
    "altervista.org", "appspot.com", "azurewebsites.net", "blogspot.com", "cloudfront.net", "deviantart.com", "duckdns.org",
    "eu.org", "firebaseapp.com", "fly.dev", "free.fr", "github.io", "gitlab.io", "glitch.me", "herokuapp.com", "livejournal.com",
    "myshopify.com", "neocities.org", "netlify.app", "nom.co", "ngrok.io", "onrender.com", "pages.dev", "readthedocs.io", "surge.sh",
    "tumblr.com", "typepad.com", "us.com", "uk.com", "vercel.app", "web.app", "weebly.com", "wixsite.com", "wordpress.com", "workers.dev",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host and path, such as example.com/en/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url: Column) -> Column:
    """Lower-cased host; empty for a null url or one without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls; of equally long rules the first."""
    text = verdict = F.when(F.lit(False), F.lit(""))
    for r in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = text.when(fits, F.lit(r.text)), verdict.when(fits, F.lit(r.verdict))
    return text, verdict


def with_levels(
    hosts: DataFrame, second: Sequence[str] = SECOND_LABELS, shared: Sequence[str] = SHARED_HOSTS
) -> DataFrame:
    """Append ``domain`` (registered) and ``suffix`` to a table with ``host``.

    A suffix has two labels if the last one is a country's and the other one of ``second``, or if both are one of ``shared``; else
    it is the last label. A domain is its suffix and one label more, as far as the host has one.
    """
    labels = F.split("host", r"\.")
    two = F.array_join(F.slice(labels, -2, 2), ".")
    country = F.element_at(labels, -1).rlike(r"\A[a-z]{2}\z") & F.try_element_at(labels, F.lit(-2)).isin(*second)
    long = (F.size(labels) > 2) & (country | two.isin(*shared))
    suffix = F.when(long, two).otherwise(F.element_at(labels, -1))
    domain = F.when(long, F.array_join(F.slice(labels, -3, 3), ".")).when(F.size(labels) > 1, two).otherwise(F.col("host"))
    return hosts.withColumn("domain", domain).withColumn("suffix", suffix)


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction."""
    x, a, b = np.broadcast_arrays(*(np.asarray(v, float) for v in (x, a, b)))
    swap = x > (a + 1) / (a + b + 2)
    x, a, b = np.where(swap, 1 - x, x), np.where(swap, b, a), np.where(swap, a, b)
    tiny = 1e-300
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    c, d = np.ones_like(x), 1 / np.where(np.abs(t := 1 - (a + b) * x / (a + 1)) < tiny, tiny, t)
    h = d.copy()
    for m in range(1, 300):
        before = h.copy()
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / np.where(np.abs(t := 1 + step * d) < tiny, tiny, t)
            c = np.where(np.abs(t := 1 + step / c) < tiny, tiny, t)
            h = h * d * c
        if np.allclose(h, before, rtol=1e-12, atol=0):
            break
    value = np.clip(np.nan_to_num(front * h), 0, 1)
    return np.where(swap, 1 - value, value)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after raising the argument over 8."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift = np.where(low, shift + np.log(np.where(low, y, 1)), shift)
        y = np.where(low, y + 1, y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def beta_quantile(p: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low, high = np.zeros_like(np.asarray(a, float)), np.ones_like(np.asarray(a, float))
    for _ in range(40):
        mid = (low + high) / 2
        under = beta_cdf(mid, a, b) < p
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return (low + high) / 2


#: Prior strengths tried, and the log of a weak prior over them that decides where counts do not.
STRENGTHS = np.geomspace(1, 999, 40)
_LEANING = -0.5 * (np.log(STRENGTHS / 10) / 1.5) ** 2


def log_likelihoods(n: np.ndarray, bad: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Log marginal likelihood of beta-binomial counts at each of ``STRENGTHS``, summed over the groups."""
    n, bad, s = n[:, None].astype(float), bad[:, None].astype(float), STRENGTHS[None]
    a = np.clip(mean[:, None], 1e-9, 1 - 1e-9) * s
    g = _log_gamma
    value = g(a + bad) - g(a) + g(s - a + n - bad) - g(s - a) - g(s + n) + g(s + 0 * n)
    return value.sum(axis=0)


def _concentration(children: DataFrame, parent_mean: str) -> float:
    """Prior strength of a level: the most likely one for the counts of its groups.

    The evidence of a group grows with the logarithm of its size, so that one large group does
    not decide for all. ``parent_mean`` must leave out the group's own counts.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(STRENGTHS))
        for f in frames:
            for i in range(0, len(f), 2048):
                part = f.iloc[i : i + 2048]
                total += log_likelihoods(*(part[c].to_numpy() for c in ("n", "bad", "mean")))
        yield pd.DataFrame({"i": np.arange(len(STRENGTHS)), "value": total})

    own = children.filter("n > 0").select("n", "bad", F.col(parent_mean).alias("mean"))
    sums = own.mapInPandas(run, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    value = _LEANING.copy()
    for row in sums:
        value[row["i"]] += row["value"]
    return float(STRENGTHS[int(np.argmax(value))])


def host_reputation(outcomes: DataFrame, bound: float = 0.05, prior: tuple[float, float] = (1.0, 9.0)) -> DataFrame:
    """(host, n, bad, rate, low): shrunken share of bad pages of each host and its lower posterior bound.

    ``outcomes`` has ``host`` and ``bad`` (0, 1, or null where no label is known). A suffix
    is drawn towards the rate of all pages, a domain towards its suffix, a host towards its domain, each
    by a beta prior whose strength is estimated from all groups of that level. What a group is drawn towards
    leaves out its own counts, at each level above it. The rate of all pages itself starts from ``prior`` bad and good pages, so that a few labels decide nothing.
    """
    hosts = materialize(
        with_levels(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))),
        "host-counts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = F.col("n"), F.col("bad")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]

    def without(mean: Column, strength: float, level: str) -> Column:
        """The rate of the level above without the counts of the group itself."""
        return (mean * strength + F.col(f"{level}_bad") - bad) / (F.col(f"{level}_n") - n + strength)

    every = lambda t, level: t.withColumnRenamed("n", f"{level}_n").withColumnRenamed("bad", f"{level}_bad")
    rest = (total["bad"] or 0) + prior[0] - bad
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("root_mean", rest / ((total["n"] or 0) + sum(prior) - n))
    suffixes = materialize(suffixes, "suffixes")
    strength = _concentration(suffixes, "root_mean")
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(every(suffixes, "suffix"), "suffix")
    domains = materialize(domains.select("domain", "n", "bad", without(F.col("root_mean"), strength, "suffix").alias("suffix_mean")), "domains")
    strength = _concentration(domains, "suffix_mean")
    joined = hosts.join(every(domains, "domain"), "domain")
    joined = materialize(joined.select("host", "n", "bad", without(F.col("suffix_mean"), strength, "domain").alias("domain_rate")), "hosts")
    strength = _concentration(joined, "domain_rate")
    rated = joined.withColumn("rate", (F.col("domain_rate") * strength + bad) / (n + strength))

    @F.pandas_udf("double")
    def low(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(beta_quantile(bound, a.to_numpy(), b.to_numpy()))

    alpha = F.col("domain_rate") * strength + F.col("bad")
    beta = (1 - F.col("domain_rate")) * strength + F.col("n") - F.col("bad")
    return rated.select("host", "n", "bad", "rate", low(alpha, beta).alias("low"))


def url_filter(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), page_id: str = "page_id", url: str = "url",
    label_id: str = "doc_id", limit: float = 0.5, bound: float = 0.05,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, rate, low) for every page.

    The longest rule that fits decides. Without one a page is blocked if the share of bad pages of its
    host lies above ``limit`` even at the lower posterior ``bound``. ``labels`` gives the outcome
    of a page by its id: bad if quality is 0 or toxic is 1; null labels say nothing, of repeated
    labels the worst counts. A null or malformed url has an empty host and path and is judged as
    that host. Repeated pages are judged alike; without any label all hosts pass.
    """
    at = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("toxic") == 1, F.col("quality") == 0)
    known = labels.filter(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("page_id")).agg(F.max(bad.cast("int")).alias("bad"))
    reputation = host_reputation(at.select("page_id", "host").join(known, "page_id", "left").select("host", "bad"), bound)
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return at.join(reputation, "host", "left").select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "rate", "low"
    )
