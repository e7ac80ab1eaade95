"""URL rules and a classifier on lexical features of URLs.

Rules decide first: a rule (host, path) fits its host and all subdomains when the
path starts with the rule's; the longest fitting rule wins. The other URLs are
judged by gradient-boosted trees on lexical features, trained from labelled URLs.

Defined cases: a null URL, or one without ``://``, has empty host and path, meets
no rule and is judged by the trees; without labelled rows of both kinds every such
URL is allowed; rows that repeat a page_id are judged alike, one row each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hubcast.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ["length", "host_length", "depth", "digit_ratio", "entropy", "params", "hyphens", "labels"]
FEATURES = [*LEXICAL, "suffix_rate"]


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without it."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def decide(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits.

    ``rules``: (``host/path``, verdict); a bounded list that is part of the query.
    """
    rule = verdict = F.lit(None).cast("string")
    for text, then in sorted(rules, key=lambda r: len(r[0])):
        of, slash, start = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, then).otherwise(verdict)
    return rule, verdict


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (url, host, path) with the LEXICAL features and the host's suffix."""
    url, host = F.coalesce("url", F.lit("")), F.col("host")
    n = F.length(url)
    count = lambda c, x: (F.length(x) - F.length(F.replace(x, F.lit(c), F.lit("")))).cast("double")
    total = F.length(host).cast("double")
    shares = F.transform(F.array_distinct(F.split(host, "")),
                         lambda c: (total - F.length(F.replace(host, c, F.lit("")))) / total)
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return pages.withColumns({
        "length": n.cast("double"), "host_length": total, "depth": count("/", F.col("path")),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(n, F.lit(1)),
        "entropy": F.when(total > 0, entropy).otherwise(0.0),
        "params": count("=", url), "hyphens": count("-", host), "labels": count(".", host),
        "suffix": F.substring_index(host, ".", -2)})


class UrlModel:
    """Gradient-boosted trees with smoothed block rates of host suffixes.

    Fitted on at most ``max_rows`` labelled rows, those with the lowest hash of
    page_id. The suffix statistics cover all labelled rows.
    """

    def __init__(self, max_rows: int = 20_000, trees: int = 12, depth: int = 3, prior: float = 20.0):
        self.max_rows, self.trees, self.depth, self.prior = max_rows, trees, depth, prior
        self.model, self.base = None, 0.0

    def fit(self, labelled: DataFrame) -> UrlModel:
        """``labelled``: page_id, url, host, path, blocked (boolean)."""
        rows = lexical(labelled.filter("blocked IS NOT NULL")).withColumn("y", F.col("blocked").cast("double"))
        self.suffixes = common.cut(rows.groupBy("suffix").agg(F.sum("y").alias("bad"), F.count("y").alias("n")))
        seen = self.suffixes.agg(F.sum("bad"), F.sum("n")).first()
        if not seen[0] or seen[0] == seen[1]:
            return self
        self.base = seen[0] / seen[1]
        sample = rows.orderBy(F.xxhash64("page_id"), "page_id").limit(self.max_rows)
        fitted = GBTClassifier(featuresCol="features", labelCol="y", maxIter=self.trees, maxDepth=self.depth,
                               stepSize=0.3, seed=1)
        self.model = fitted.fit(self._vectors(sample).select("features", "y"))
        return self

    def _vectors(self, rows: DataFrame) -> DataFrame:
        rate = (F.coalesce("bad", F.lit(0.0)) + self.prior * self.base) / (F.coalesce("n", F.lit(0)) + self.prior)
        joined = rows.join(self.suffixes, "suffix", "left").withColumn("suffix_rate", rate)
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)

    def probability(self, pages: DataFrame) -> DataFrame:
        """``pages`` with ``block_probability``."""
        if self.model is None:
            return pages.withColumn("block_probability", F.lit(0.0))
        scored = self.model.transform(self._vectors(lexical(pages)))
        return scored.select(*pages.columns, vector_to_array("probability")[1].alias("block_probability"))


def seed_labels(pages: DataFrame, seeds: Sequence[str]) -> DataFrame:
    """Labels a page's URL as blocked when a host label is one of the seed names."""
    names = F.split("host", r"\.")
    known = F.arrays_overlap(names, F.array(*[F.lit(s) for s in seeds]))
    return pages.withColumn("blocked", F.when(F.col("host") != "", known))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], seeds: Sequence[str],
          model: UrlModel | None = None, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, block_probability for every page."""
    parts = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    model = (model or UrlModel()).fit(seed_labels(parts, seeds))
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("block_probability") >= threshold, "block").otherwise("allow")
    return model.probability(parts).select("page_id", "host", "path", rule.alias("rule"),
                                           F.coalesce(verdict, learned).alias("verdict"), "block_probability")
