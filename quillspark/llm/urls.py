"""URL filters: host and path rules first, gradient-boosted trees on lexical features for what no rule fits.

Everything that touches rows is a DataFrame operation. The trees are grown on the driver from a bounded sample
of labelled URLs (chosen by md5 of the id and gathered as counts of binned features) and become nested
conditional expressions over the feature columns. Suffix statistics are smoothed block rates by the host's last
label, learned from all labelled URLs; a row's rate is that of the other folds, so that neither in learning nor in
judging its own label, or that of a URL on the same host, stands behind its feature. Features are computed once and written.

Labels: a rule's verdict; else block where a seed term stands in the host, or the host is a number or has a port;
else a weak allow, of a small weight.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no rule and is judged by the
trees as it is. Rules of equal length that both fit: the smaller string wins. Rows that repeat, and rows without
page_id, are judged each for itself; ties of the sample's md5 are broken by page_id. Very long urls are read whole,
in time that grows with their length. Only page_id and url are read, whatever else a table holds. Empty tables give
no rows; without any label the trees allow.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import bounded_sample, staged

#: Host and path prefix, verdict.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Terms in a host that label a URL as block for training.
SEEDS = ("ads-", "casino", "cheap", "clickbait", "farm", "free-", "loan", "malware", "phish", "pills", "porn", "spam", "viagra", "xxx")
#: Folds that block rates are learned in.
FOLDS = 5
#: Labelled URLs that trees are grown from at most; the weight of an allow that nothing but silence supports.
MAX_TRAIN_ROWS, WEAK = 20_000, 0.3
#: Rules up to this number are one expression; more are a table that hosts' suffixes are joined with.
MAX_INLINE_RULES = 256
THRESHOLD = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHAPE = r"(?s)^.*?://([^/?#]*+)([^?#]*+)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _SHAPE, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SHAPE, 2), F.lit(""))


def _parts(rule: str) -> tuple[str, str]:
    host, _, path = rule.partition("/")
    return host, f"/{path}"


def _inline(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    rule = verdict = None
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        host, path = _parts(text)
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    none = F.lit(None).cast("string")
    return df.withColumn("rule", none if rule is None else rule).withColumn("rule_verdict", none if verdict is None else verdict)


def _joined(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """The same by a join of each distinct host and path with the rules of the host's suffixes."""
    spark = df.sparkSession
    table = spark.createDataFrame([(*_parts(r), r, v) for r, v in rules], "suffix string, head string, text string, says string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    places = df.select("host", "path").distinct()
    fits = places.withColumn("suffix", F.explode(suffixes)).join(table, "suffix").where(F.expr("startswith(path, head)"))
    best = fits.groupBy("host", "path").agg(F.min(F.struct((-F.length("text")).alias("n"), "text", "says")).alias("best"))
    return df.join(best, ["host", "path"], "left").withColumn("rule", F.col("best.text")).withColumn("rule_verdict", F.col("best.says")).drop("best")


def with_rules(df: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """df (url) with host, path, rule and rule_verdict; the last two are null where no rule fits."""
    placed = df.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return _inline(placed, rules) if len(rules) <= MAX_INLINE_RULES else _joined(placed, rules)


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what)))


def _entropy(text: Column) -> Column:
    """Bits a character, from the runs of its sorted characters."""
    n = F.length(text).cast("double")
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    part = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(0.0)
    start = F.struct(F.lit("").alias("char"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def step(done: Column, c: Column) -> Column:
        same = done["char"] == c
        return F.struct(c.alias("char"), F.when(same, done["run"] + 1.0).otherwise(1.0).alias("run"), (done["total"] + F.when(same, 0.0).otherwise(part(done["run"]))).alias("total"))

    total = F.aggregate(chars, start, step, lambda done: done["total"] + part(done["run"]))
    return F.when(n > 0, F.greatest(F.log2(n) - total / n, F.lit(0.0))).otherwise(0.0)


def _digits(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1))


def lexical() -> dict[str, Column]:
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*+\?([^#]*+)", 1)
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": _count(host, ".").cast("double"),
        "depth": _count(path, "/").cast("double"),
        "hyphens": _count(host, "-").cast("double"),
        "host_digits": _digits(host),
        "path_digits": _digits(path),
        "entropy": _entropy(host),
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
        "secure": F.startswith(url, F.lit("https:")).cast("double"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
    }


FEATURES = (*("url_length host_length path_length labels depth hyphens host_digits path_digits entropy parameters secure fragment".split()), "suffix_rate")


@dataclass(frozen=True)
class Node:
    """An inner node sends value <= cut to low; a leaf has a value."""

    value: float = 0.0
    feature: str = ""
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None

    def column(self) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(F.col(self.feature) <= F.lit(self.cut), self.low.column()).otherwise(self.high.column())

    def apply(self, x: dict[str, np.ndarray]) -> np.ndarray:
        if not self.feature:
            return np.full(len(next(iter(x.values()))), self.value)
        return np.where(x[self.feature] <= self.cut, self.low.apply(x), self.high.apply(x))


@dataclass(frozen=True)
class Trees:
    bias: float = 0.0
    trees: tuple[Node, ...] = ()

    def column(self) -> Column:
        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + tree.column()
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _grow(x: dict[str, np.ndarray], g: np.ndarray, h: np.ndarray, inside: np.ndarray, depth: int, rate: float, cuts: dict[str, np.ndarray], smooth: float = 1.0, least: float = 2.0) -> Node:
    total_g, total_h = g[inside].sum(), h[inside].sum()
    leaf = Node(value=float(-rate * total_g / (total_h + smooth)))
    if depth == 0 or total_h < least:
        return leaf
    best, gain = None, 1e-6
    for name, edges in cuts.items():
        at = np.searchsorted(edges, x[name][inside])  # value <= edges[i] falls into a bin up to i
        sums_g = np.cumsum(np.bincount(at, g[inside], len(edges) + 1))[:-1]
        sums_h = np.cumsum(np.bincount(at, h[inside], len(edges) + 1))[:-1]
        rest_g, rest_h = total_g - sums_g, total_h - sums_h
        gains = sums_g**2 / (sums_h + smooth) + rest_g**2 / (rest_h + smooth) - total_g**2 / (total_h + smooth)
        gains[(sums_h < 1e-3) | (rest_h < 1e-3)] = -1
        if len(gains) and gains.max() > gain:
            gain, best = gains.max(), (name, float(edges[int(gains.argmax())]))
    if best is None:
        return leaf
    low = inside & (x[best[0]] <= best[1])
    high = inside & ~low
    return Node(0.0, *best, _grow(x, g, h, low, depth - 1, rate, cuts), _grow(x, g, h, high, depth - 1, rate, cuts))


def grow(x: dict[str, np.ndarray], block: np.ndarray, weight: np.ndarray, trees: int = 16, depth: int = 3, rate: float = 0.4, bins: int = 32) -> Trees:
    """Boosting by gradients and second derivatives of the logistic loss over quantile cuts."""
    cuts = {k: np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[:-1])) for k, v in x.items()}
    share = np.clip((block * weight).sum() / weight.sum(), 1e-4, 1 - 1e-4)
    total = np.full(len(block), np.log(share / (1 - share)))
    out = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        out.append(_grow(x, weight * (p - block), weight * p * (1 - p), np.ones(len(block), bool), depth, rate, cuts))
        total = total + out[-1].apply(x)
    return Trees(float(np.log(share / (1 - share))), tuple(out))


def with_features(df: DataFrame) -> DataFrame:
    """df (url, host, path) with the lexical features and the host's last label as suffix."""
    for name, column in lexical().items():
        df = df.withColumn(name, column)
    return df.withColumn("suffix", F.substring_index("host", ".", -1))


def labelled(df: DataFrame, seeds: Sequence[str] = SEEDS) -> DataFrame:
    """df (host, rule_verdict) with block (0 or 1) and weight."""
    spam = F.regexp_like("host", F.lit(r"^[0-9.]+(:[0-9]+)?$|:[0-9]+$")) & (F.col("host") != "")
    for term in seeds:
        spam = spam | F.contains(F.col("host"), F.lit(term))
    sure = F.col("rule_verdict").isNotNull()
    block = F.when(sure, (F.col("rule_verdict") == "block").cast("double")).otherwise(spam.cast("double"))
    return df.withColumn("block", block).withColumn("weight", F.when(sure | spam, 1.0).otherwise(WEAK))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, seeds: Sequence[str] = SEEDS, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' block score of every row."""
    fold = F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")  # one host is in one fold
    marked = labelled(with_features(with_rules(pages.select("page_id", "url"), rules)), seeds).withColumn("fold", fold)
    full = staged(marked.drop("url"), "urls")
    sums = full.groupBy("suffix", "fold").agg(F.sum(F.col("block") * F.col("weight")).alias("blocked"), F.sum("weight").alias("all"))
    totals = sums.groupBy("suffix").agg(F.sum("blocked").alias("t_blocked"), F.sum("all").alias("t_all"))
    rate = (F.col("t_blocked") - F.col("blocked") + 1.0) / (F.col("t_all") - F.col("all") + 2.0)
    rates = sums.join(totals, "suffix").select("suffix", "fold", rate.alias("suffix_rate"))
    rated = full.join(rates, ["suffix", "fold"])
    rows = bounded_sample(rated, "page_id", max_rows)
    counts = rows.groupBy(*FEATURES).agg(F.sum(F.col("block") * F.col("weight")).alias("blocked"), F.sum("weight").alias("weight")).orderBy(*FEATURES).collect()
    if counts:
        x = {name: np.array([r[name] for r in counts], float) for name in FEATURES}
        weight = np.array([r.weight for r in counts])
        model = grow(x, np.array([r.blocked for r in counts]) / weight, weight)
    else:
        model = Trees()
    out = rated.withColumn("score", model.column())
    verdict = F.coalesce("rule_verdict", F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
