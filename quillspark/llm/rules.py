"""Quality rules as a learned decision list.

Statistics of every whole text come from one vectorised pass. Sequential covering then learns, on a bounded
sample of labelled documents, an ordered list of threshold conjunctions for the class "reject": each rule
grows literal by literal on a growing set by information gain, is pruned from its end on a pruning set, and
is kept only if it is precise there. The list becomes a Spark conditional expression over the statistics.

Only the sample's statistics are computed for learning; every text's are computed once, where it is judged.

Defined cases: a null text has no words; all statistics are 0 and it fails the base rules. Without labels of both
classes the list is empty and only the base rules decide. Labels that are null, or of no document, are left out; of
several labels of a doc_id the lowest counts. Repeated rows are judged each for itself; a doc_id with several rows is
learned from its smallest text. Ties of the sample's md5 are broken by doc_id, ties between literals by their order.
Very long texts are read whole. Other columns pass through; names that begin with __q_ are ours. Empty tables give
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import tokens
from quillspark.llm.shared import bounded_sample

#: Labelled rows that the list is learned from at most.
MAX_TRAIN_ROWS = 20_000
#: Bases: fewer words, or a larger share of repeated words in percent, always fail.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_digits", "n_upper", "n_marks", "n_bytes", "n_distinct")
STATS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

_SYMBOL = tokens._class(lambda b: b in b"#*$%&|<>")
_DIGIT = tokens._class(lambda b: 48 <= b <= 57)
_UPPER = tokens._class(lambda b: 65 <= b <= 90)
_MARK = tokens._class(lambda b: b in b".,;:!?")
_HEAD = tokens._class(lambda b: b & 0xC0 != 0x80) & tokens.PLAIN
_BLANKS = b" \t\n\x0b\x0c\r"


def repeated_words(words: np.ndarray, first: np.ndarray, size: int = 3) -> np.ndarray:
    """For each text, the words that stand in a run of `size` words that the text holds twice or more."""
    runs, at = tokens.shingles(words, first, size)
    cover = np.zeros(len(words) + 1, np.int64)
    if len(runs):
        owner = tokens.owners(first)[at].astype(np.uint64)
        key = tokens.mix(runs + tokens.mix(owner))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + size, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return covered[first[1:]] - covered[first[:-1]]


def _distinct(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    owner = tokens.owners(first)
    key = np.unique(tokens.mix(words + tokens.mix(owner.astype(np.uint64))), return_index=True)[1]
    return np.bincount(owner[key], minlength=len(first) - 1)


def _repeated_lines(text: bytes) -> tuple[int, int]:
    lines = text.split(b"\n")
    if len(lines) == 1:
        return 1, 0
    filled = [x for x in lines if x.strip(_BLANKS)]
    return len(lines), len(filled) - len(set(filled))


def text_counts(column: pa.Array) -> pa.Array:
    """The COUNTS of each text of an Arrow column, as structs."""
    parts: list[np.ndarray] = []
    for _, b in tokens.batches(column):
        starts, ends, first = b.words(tokens.PLAIN)
        words = b.hashes(starts, ends, fold=False)
        raw = b.buf.tobytes()
        lines = np.array([_repeated_lines(raw[i:j]) for i, j in zip(b.off[:-1], b.off[1:], strict=True)], np.int64).reshape(-1, 2)
        parts.append(np.stack([np.diff(first), b.count(_HEAD), b.count(_SYMBOL), lines[:, 1], repeated_words(words, first), lines[:, 0], b.count(_DIGIT), b.count(_UPPER), b.count(_MARK), np.diff(b.off), _distinct(words, first)], axis=1))
    table = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(COUNTS))], names=list(COUNTS))


@F.arrow_udf(STATS)
def counts_of(text: pa.Array) -> pa.Array:
    return text_counts(text)


def base_failed(at: str = "") -> Column:
    """The fixed rules; `at` is the prefix of the counts, such as `stats.`."""
    n = F.col(f"{at}n_words")
    return (n < MIN_WORDS) | (F.lit(100) * F.col(f"{at}n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * n)


def _ratio(a: str, b: str):
    return lambda get: get(a) / (get(b) + 1.0)


#: What literals compare: a name and a formula over the counts, the same for Columns and numpy arrays.
FEATURES = {
    "words": lambda get: get("n_words") * 1.0,
    "mean_word": _ratio("word_chars", "n_words"),
    "symbols_per_word": _ratio("n_symbols", "n_words"),
    "dup_lines": _ratio("n_dup_lines", "n_lines"),
    "repeats": _ratio("n_repeat_words", "n_words"),
    "words_per_line": _ratio("n_words", "n_lines"),
    "digits": _ratio("n_digits", "n_bytes"),
    "upper": _ratio("n_upper", "n_bytes"),
    "marks_per_word": _ratio("n_marks", "n_words"),
    "distinct": _ratio("n_distinct", "n_words"),
}


@dataclass(frozen=True)
class Literal:
    feature: str
    above: bool  # >= threshold, else <=
    threshold: float

    def column(self, at: str) -> Column:
        value = FEATURES[self.feature](lambda c: F.col(f"{at}{c}"))
        return value >= F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.above else x[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first that holds rejects, and what none holds for is kept."""

    rules: tuple[tuple[Literal, ...], ...] = ()

    def rejects(self, at: str = "") -> Column:
        out = None
        for rule in self.rules:
            test = rule[0].column(at)
            for literal in rule[1:]:
                test = test & literal.column(at)
            out = F.when(test, True) if out is None else out.when(test, True)
        return F.lit(False) if out is None else out.otherwise(False)

    def applies(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            out |= np.logical_and.reduce([literal.holds(x) for literal in rule])
        return out


def _candidates(x: dict[str, np.ndarray], bins: int) -> list[Literal]:
    out = []
    for name, values in x.items():
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1])) if len(values) else []
        out += [Literal(name, above, float(t)) for t in cuts for above in (True, False)]
    return out


def learn(x: dict[str, np.ndarray], bad: np.ndarray, *, precision: float = 0.9, support: int = 8, max_rules: int = 16, max_literals: int = 4, bins: int = 48) -> DecisionList:
    """Sequential covering of the rows marked bad. Every third row only prunes and judges rules."""
    n = len(bad)
    prune = np.arange(n) % 3 == 2
    left = np.ones(n, bool)
    rules: list[tuple[Literal, ...]] = []
    while len(rules) < max_rules and (left & bad & ~prune).sum() >= support:
        grow = left & ~prune
        rule: list[Literal] = []
        pool = _candidates({k: v[grow] for k, v in x.items()}, bins)
        held = {literal: literal.holds(x) for literal in pool}
        inside = grow.copy()
        while len(rule) < max_literals and (inside & ~bad).any():
            p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
            before = np.log2(p0 / (p0 + n0))
            best, gain = None, 1e-9
            for literal in pool:
                now = inside & held[literal]
                p = (now & bad).sum()
                if p < support:
                    continue
                g = p * (np.log2(p / now.sum()) - before)
                if g > gain:
                    best, gain = literal, g
            if best is None:
                break
            rule.append(best)
            inside &= held[best]
        if not rule:
            break

        def score(k: int) -> float:
            hit = left & prune & np.logical_and.reduce([held[literal] for literal in rule[:k]])
            p, q = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - q) / max(p + q, 1)

        size = max(range(1, len(rule) + 1), key=lambda k: (score(k), -k))
        rule = rule[:size]
        hit = np.logical_and.reduce([held[literal] for literal in rule])
        judged = left & prune & hit
        left &= ~hit  # a rule that is not precise enough still leaves the search, or it would be found again
        if judged.sum() >= max(1, support // 2) and (judged & bad).sum() >= precision * judged.sum():
            rules.append(tuple(rule))
    return DecisionList(tuple(rules))


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, **options) -> DecisionList:
    """Learn from the labelled documents; quality 0 is the class to reject."""
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = bounded_sample(documents.select("doc_id").join(marked, "doc_id").distinct(), "doc_id", max_rows)
    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # max_rows ids
    texts = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # a repeated doc_id is one row
    rows = texts.select("doc_id", "quality", counts_of("text").alias("s")).select("doc_id", "quality", *[f"s.{c}" for c in COUNTS]).collect()
    if not rows:
        return DecisionList()
    rows.sort(key=lambda r: r.doc_id)  # which rows prune must not depend on where they were read
    table = np.array([r[1:] for r in rows], float)
    at = {c: table[:, k + 1] for k, c in enumerate(COUNTS)}
    return learn({name: f(at.__getitem__) for name, f in FEATURES.items()}, table[:, 0] == 0, **options)


def document_stats(documents: DataFrame) -> DataFrame:
    """doc_id and COUNTS of each row."""
    return documents.select("doc_id", counts_of(F.col("text").cast("string")).alias("s")).select("doc_id", "s.*")


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Each document's counts, base_failed and kept."""
    list_ = fit(documents, labels)
    return document_stats(documents).withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | list_.rejects()))


def filtered(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, all columns as they came."""
    list_ = fit(documents, labels)
    held = documents.withColumn("__q_stats", counts_of(F.col("text").cast("string")))
    return held.where(~(base_failed("__q_stats.") | list_.rejects("__q_stats."))).drop("__q_stats")
