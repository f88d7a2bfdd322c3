"""URL filter: rules first, then gradient-boosted trees on lexical features.

A rule is (verdict, pattern) with a pattern ``host/path``: it fits its host and
all subdomains if the url's path starts with the rule's path. Of the rules that
fit, the longest pattern wins. Urls that no rule decides get the verdict of
boosted trees trained on labelled urls: lengths, depth, digit ratio, entropy,
parameter counts and the block rates of the url's suffixes (registered name with
and without the label before it, last label, file suffix).

Suffixes are counted exactly, over all rows. A suffix with fewer than
MIN_LABELLED labelled rows has the rate of all of them. Suffixes that hold at least
FREQUENT of the rows, at most 1 / FREQUENT for each kind, travel with the tasks; the
rates of the others, however many there are, are joined by suffix, and rows
without such a suffix are dealt over the join's tasks. The trees are fitted on
a bounded sample; to half of its hosts the rates of their names are hidden, so that
the trees also learn to judge hosts that nobody has labelled.

A null url, or one without ``://``, has an empty host and path, which no rule
fits; the trees judge it like any other. Without labelled urls, or with one label
only, the trees give a constant. Repeated urls are separate rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .boosting import BoostedTrees
from .common import bounded_sample, staged

KINDS = 4  # of suffixes, the first two of which are names
FREQUENT = 0.001
MIN_LABELLED = 5
SUFFIX_WEIGHT = 20.0
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return pages.withColumn("host", F.translate(host, UPPER, LOWER)).withColumn("path", path)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(pattern, verdict) of the longest fitting rule, else nulls: one chain of
    conditions, evaluated in generated code. Equal patterns: the first listed."""
    pattern = verdict = F.lit(None).cast("string")
    seen = {}
    for v, p in rules:
        seen.setdefault(p, v)
    for p in sorted(seen, key=lambda p: (len(p), p)):  # the last one added is asked first
        rule_host, _, rule_path = p.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        pattern, verdict = F.when(fits, F.lit(p)).otherwise(pattern), F.when(fits, F.lit(seen[p])).otherwise(verdict)
    return pattern, verdict


def suffixes_of(url: str) -> list[str]:
    """The last three and two labels of the host, its last label and the file
    suffix of the path ('' if there is none)."""
    host, _, path = re.split(r"[?#]", url.partition("://")[2], maxsplit=1)[0].partition("/")
    labels = host.lower().split(".")
    name = path.rpartition("/")[2]
    return [".".join(labels[-3:]), ".".join(labels[-2:]), labels[-1], "." + name.rpartition(".")[2] if "." in name else ""]


def suffixes(url: Column) -> Column:
    @F.pandas_udf("array<string>")
    def found(urls: pd.Series) -> pd.Series:
        return urls.map(suffixes_of)

    return found(url)


def _lexical(url: str) -> list[float]:
    rest = url.partition("://")[2]
    head, _, query = rest.partition("?")
    host, _, path = head.partition("#")[0].partition("/")
    n = max(1, len(url))
    counts = np.array(list(Counter(url).values()) or [1], float) / n
    runs = max((len(x) for x in "".join(c if c.isdigit() else " " for c in url).split()), default=0)
    letters = sum(c.isalpha() for c in host)
    return [len(url), len(host), len(path), path.strip("/").count("/") + bool(path.strip("/")), host.count("."),
            host.count("-"), sum(c.isdigit() for c in url) / n, sum(c.isdigit() for c in host), runs,
            float(-(counts * np.log2(counts)).sum()), query.count("=") + query.count("&"), len(query), url.count("%"),
            float("@" in host), float(":" in host), float(host.startswith("www.")), float(url.startswith("https")),
            sum(c in "aeiou" for c in host) / max(1, letters), max((len(x) for x in host.split(".")), default=0)]


def suffix_counts(rows: DataFrame) -> DataFrame:
    """(kind, suffix, n, labelled, blocked) of all rows (url, y); y may be null."""
    found = rows.select("y", suffixes(F.col("url")).alias("suffixes")).select("y", F.posexplode("suffixes").alias("kind", "suffix"))
    return found.groupBy("kind", "suffix").agg(F.count("*").alias("n"), F.count("y").alias("labelled"),
                                               F.coalesce(F.sum("y"), F.lit(0)).alias("blocked"))


@dataclass
class SuffixRates:
    """Smoothed block rates: of frequent suffixes by kind, and a table (kind,
    suffix, rate) of the others."""

    prior: float
    frequent: list[dict[str, float]]
    others: DataFrame

    def joined(self, rows: DataFrame, url_col: str) -> DataFrame:
        """``rows`` as a column ``row``, with ``url`` and the ``rates`` of its
        suffixes (null for a suffix whose rate the tasks know)."""
        url = F.coalesce(F.col(url_col), F.lit(""))
        out = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), url.alias("url"),
                          suffixes(url).alias("suffixes"))
        out = out.withColumn("deal", F.concat(F.lit("\n"), F.xxhash64("row").cast("string")))
        rates = []
        for kind, known in enumerate(self.frequent):
            suffix = F.col("suffixes")[kind]
            key = F.when(suffix.isin(list(known)), F.col("deal")).otherwise(suffix) if known else suffix
            other = self.others.where(F.col("kind") == kind).select(
                F.col("suffix").alias(f"suffix_{kind}"), F.col("rate").alias(f"rate_{kind}"))
            out = out.join(other, key == F.col(f"suffix_{kind}"), "left").drop(f"suffix_{kind}")
            rates.append(F.col(f"rate_{kind}"))
        return out.select("row", "url", "suffixes", F.array(*rates).alias("rates"))

    def known(self, suffixes: list[list[str]], rates: list[list[float | None]]) -> np.ndarray:
        """One rate per url and kind."""
        return np.array([[known.get(s, self.prior) if r is None or r != r else r
                          for known, s, r in zip(self.frequent, ss, rr)] for ss, rr in zip(suffixes, rates)],
                        float).reshape(-1, KINDS)


def suffix_rates(rows: DataFrame) -> SuffixRates:
    """Rates from rows (url, y); those with a null y count towards how frequent
    a suffix is, and so how its rate is looked up, only."""
    counts = staged(suffix_counts(rows), "url-suffixes")
    n, labelled, blocked = counts.where("kind = 0").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "labelled", "blocked")]).first()
    prior = (blocked + 1) / (labelled + 2)
    rate = (F.col("blocked") + SUFFIX_WEIGHT * prior) / (F.col("labelled") + SUFFIX_WEIGHT)
    rated = counts.select("kind", "suffix", F.when(F.col("labelled") >= MIN_LABELLED, rate).otherwise(prior).alias("rate"), "n", "labelled")
    often = F.col("n") >= n * FREQUENT
    frequent = [{} for _ in range(KINDS)]
    for kind, suffix, r, *_ in rated.where(often).collect():  # at most 1 / FREQUENT of a kind
        frequent[kind][suffix] = r
    return SuffixRates(prior, frequent, rated.where(~often & (F.col("labelled") >= MIN_LABELLED)).select("kind", "suffix", "rate"))


def features(urls: list[str], rates: np.ndarray) -> np.ndarray:
    if not urls:
        return np.zeros((0, 19 + KINDS))
    return np.hstack([np.array([_lexical(u) for u in urls], float), rates])


class UrlModel:
    def __init__(self, trees: BoostedTrees, rates: SuffixRates):
        self.trees, self.rates = trees, rates

    def scored(self, rows: DataFrame, url_col: str = "url") -> DataFrame:
        """``rows`` with block_score, the probability that a url is to be blocked."""
        model, rates = self.trees, SuffixRates(self.rates.prior, self.rates.frequent, None)

        @F.pandas_udf("double")
        def block(urls: pd.Series, suffixes: pd.Series, found: pd.Series) -> pd.Series:
            return pd.Series(model.predict(features(urls.tolist(), rates.known(suffixes.tolist(), found.tolist()))))

        found = self.rates.joined(rows, url_col)
        score = block("url", "suffixes", "rates").alias("block_score")
        return found.select("row", score).select("row.*", "block_score")


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> UrlModel:
    """Fit on rows (url, y): y is 1 to block, 0 to allow, null if there is no label.
    The trees see about ``sample_rows`` of the distinct labelled urls, chosen by
    hash; suffix rates see all rows. A url with both labels is one to block."""
    rows = staged(rows.select("url", F.col("y").cast("int").alias("y")).where("url IS NOT NULL"), "url-labels")
    rates = suffix_rates(rows)
    labelled = rows.where("y IS NOT NULL").groupBy("url").agg(F.max("y").alias("y"))
    sample = rates.joined(bounded_sample(labelled, [F.col("url")], sample_rows), "url") \
        .select("url", "row.y", "suffixes", "rates").orderBy("url").toPandas()
    known = rates.known(sample["suffixes"].tolist(), sample["rates"].tolist())
    hidden = [zlib.crc32(s[0].encode("utf-8", "replace")) & 1 == 0 for s in sample["suffixes"]]
    known[np.array(hidden, bool), :2] = rates.prior
    return UrlModel(BoostedTrees().fit(features(sample["url"].tolist(), known), sample["y"].to_numpy()), rates)


def judged(pages: DataFrame, rules: list[tuple[str, str]], model: UrlModel, url_col: str = "url",
           threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the trees' block_score."""
    rows = with_parts(model.scored(pages.drop("block_score"), url_col), url_col)
    pattern, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", pattern)
    method = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce(verdict, method))
