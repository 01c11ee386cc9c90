"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for all that no rule fits.

The trees learn from URLs that the rules judge (or any labelled ones): a bounded sample comes to the driver, where trees
are grown on binned features with the logistic loss.  A trained model is one column expression of nested conditions; the
rates by suffix, which have no more rows than the sample, are broadcast.  Nothing but built-in functions touches the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "depth", "digits", "entropy", "params", "labels", "hyphens", "top_rate", "site_rate")
#: Of the rate of one half, and into how many parts the sample is dealt for its own rates.
WEIGHT, FOLDS = 8.0, 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first `://` up to `/`, `?`, `#` or the end, in ASCII lower case; then up to `?`, `#` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def parsed(pages: DataFrame, rules: dict[str, str], key: str) -> DataFrame:
    """(key, _url, host, path, rule, ruled): the longest rule that fits, and what it says."""
    host, path = host_and_path(F.col("_url"))
    rows = pages.select(pages[key], pages["url"].cast("string").alias("_url")).select(key, "_url", host.alias("host"), path.alias("path"))
    rule = ruled = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), r)):
        fit = fits(r, F.col("host"), F.col("path"))
        rule, ruled = F.when(fit, F.lit(r)).otherwise(rule), F.when(fit, F.lit(rules[r])).otherwise(ruled)
    return rows.select("*", rule.alias("rule"), ruled.alias("ruled"))


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the features that a URL has by itself, and its suffixes: top (last label) and site (last two)."""
    url = F.coalesce("_url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    share = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(c == "", 0.0).otherwise((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n))
    entropy = F.aggregate(share, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return rows.select(
        "*", F.length(url).cast("double").alias("length"), F.length("host").cast("double").alias("host_length"), F.regexp_count("path", F.lit("/")).cast("double").alias("depth"),
        (F.regexp_count(url, F.lit("[0-9]")) / n).alias("digits"), entropy.alias("entropy"), F.regexp_count(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit("=")).cast("double").alias("params"),
        F.regexp_count("host", F.lit("[.]")).cast("double").alias("labels"), F.regexp_count(url, F.lit("-")).cast("double").alias("hyphens"),
        F.regexp_extract("host", r"[^.]*$", 0).alias("_top"), F.regexp_extract("host", r"[^.]*\.?[^.]*$", 0).alias("_site"),
    )


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    below: Node | None = None
    above: Node | None = None

    def column(self, names: tuple[str, ...]) -> Column:
        if self.feature < 0:
            return F.lit(self.value)
        return F.when(F.col(names[self.feature]) <= self.cut, self.below.column(names)).otherwise(self.above.column(names))

    def apply(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.cut, self.below.apply(x), self.above.apply(x))


@dataclass
class Boosted:
    """Gradient-boosted trees for a label of 0 or 1."""

    start: float = 0.0
    trees: list[Node] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, bins: int = 32, leaf: float = 1.0) -> Boosted:
        if not len(y):
            return cls(-math.inf)
        prior = (y.sum() + 0.5) / (len(y) + 1)
        out = cls(float(np.log(prior / (1 - prior))))
        if y.min() == y.max():
            return out
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), out.start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            tree = cls._grow(binned, cuts, y - p, p * (1 - p), np.arange(len(y)), depth, rate, leaf)
            out.trees.append(tree)
            score = score + tree.apply(x)
        return out

    @staticmethod
    def _grow(binned: np.ndarray, cuts: list, g: np.ndarray, h: np.ndarray, rows: np.ndarray, depth: int, rate: float, leaf: float) -> Node:
        total, weight = g[rows].sum(), h[rows].sum()
        node = Node(float(rate * total / (weight + leaf)))
        best = 1e-6
        for f, cut in enumerate(cuts if depth else []):
            gl = np.bincount(binned[rows, f], g[rows], len(cut) + 1).cumsum()[:-1]
            hl = np.bincount(binned[rows, f], h[rows], len(cut) + 1).cumsum()[:-1]
            gain = gl**2 / (hl + leaf) + (total - gl) ** 2 / (weight - hl + leaf) - total**2 / (weight + leaf)
            if len(gain) and gain.max() > best:
                best, node.feature, node.cut = gain.max(), f, float(cut[gain.argmax()])
        if node.feature >= 0:
            low = binned[rows, node.feature] <= np.searchsorted(cuts[node.feature], node.cut, side="left")
            node.below, node.above = (Boosted._grow(binned, cuts, g, h, part, depth - 1, rate, leaf) for part in (rows[low], rows[~low]))
        return node

    def column(self, names: tuple[str, ...] = FEATURES) -> Column:
        """The probability of label 1."""
        if self.start == -math.inf:
            return F.lit(0.0)
        return 1 / (1 + F.exp(-reduce(lambda a, t: a + t.column(names), self.trees, F.lit(self.start))))


def elsewhere(suffix: np.ndarray, y: np.ndarray, fold: np.ndarray, weight: float = WEIGHT) -> np.ndarray:
    """For each row of the sample the rate that rated() would give if the row's own fold weren't in it, so that no label is told by
    itself."""
    _, of = np.unique(suffix, return_inverse=True)
    groups = int(of.max(initial=-1)) + 1
    both = of * FOLDS + fold
    ones, n = (np.bincount(of, w, groups)[of] - np.bincount(both, w, groups * FOLDS)[both] for w in (y, np.ones(len(y))))
    return np.where(n > 0, (ones + weight / 2) / (n + weight), 0.5)


def rated(rows: DataFrame, sample: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """Adds how often the sample's URLs of the same suffix are labelled 1, drawn towards one half.

    What is broadcast has a row for each suffix in the sample, so no more than the sample.
    """
    for of, name in (("_top", "top_rate"), ("_site", "site_rate")):
        seen = sample.groupBy(F.col(of).alias("_suffix")).agg(((F.sum("label") + weight / 2) / (F.count("*") + weight)).alias(name))
        rows = rows.join(F.broadcast(seen), F.col(of) == F.col("_suffix"), "left").drop("_suffix").withColumn(name, F.coalesce(name, F.lit(0.5)))
    return rows


def filtered(pages: DataFrame, rules: dict[str, str], key: str = "page_id", labelled: DataFrame | None = None, sample: int = 10_000) -> DataFrame:
    """A row for each page (key, url): key, host, path, rule, verdict ('allow' or 'block') and score.

    The longest rule that fits decides; else the trees, which block from a score of 0.5 on.  They learn from labelled
    (url, label: 1 to block), or else from the pages that rules judge: `sample` of them, in the order of a hash of the URL.
    Null URLs and those without `://` have an empty host and path, which no rule fits.  With nothing to learn from the
    score is 0.  Long URLs are read whole; of rules of one length the last by code point wins; labelled rows whose URL is null or
    whose label is null teach nothing, and repeated ones teach once.  Repeated rows have the same answer; no rows give none; other columns are ignored.
    """
    rows = parsed(pages, rules, key)
    if labelled is None:
        taught = rows.where("rule is not null").select(F.lit(0).alias("_k"), "_url", "host", "path", "rule", "ruled", (F.col("ruled") == "block").cast("int").alias("label"))
    else:
        taught = parsed(labelled.where("url is not null").select(F.lit(0).alias("_k"), "url").distinct(), rules, "_k").join(labelled.select(F.col("url").alias("_url"), F.col("label").cast("int").alias("label")).where("label is not null").distinct(), "_url")
    taught = written(lexical(taught.distinct().orderBy(F.xxhash64("_url"), "_url", "label").limit(sample)), "taught")
    told = taught.select(*FEATURES[:-2], "label", "_top", "_site", F.pmod(F.xxhash64(F.lit(1), "_url"), F.lit(FOLDS)).cast("int").alias("fold")).toPandas()
    y, fold = told["label"].to_numpy(float), told["fold"].to_numpy()
    x = np.column_stack([told[list(FEATURES[:-2])].to_numpy(float), *(elsewhere(told[c].to_numpy(str), y, fold) for c in ("_top", "_site"))])
    model = Boosted.fit(x, y)
    scored = rated(lexical(rows), taught).select(key, "host", "path", "rule", "ruled", model.column().alias("score"))
    return scored.select(key, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
