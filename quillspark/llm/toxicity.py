"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are single words, neighbouring pairs and pairs around one word, hashed into a fixed number of
coordinates; so are words' heads (their first bytes), which stand for all forms of a stem. A text's value in a
coordinate is how often it holds it, up to a limit. Learning is online: each coordinate has its own
learning rate, and L1 keeps at exactly 0 all weights that the data don't support, so the model is a short
list of coordinates. The number of coordinates bounds what is broadcast. Scoring reads whole texts.

Learning uses a bounded sample of labelled texts, taken by md5 of doc_id. Defined cases: null and empty texts
score by the bias alone. A label that is null, or a doc_id that is null or that no document has, is left out; a
doc_id with several labels counts as toxic if one of them does, and one with several rows is learned from its
smallest text. Without any row to learn from, every score is 0. Rows that repeat are scored each for itself. Very
long texts are read whole, for learning and scoring. Ties of the sample's md5 are broken by doc_id. An empty
table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import tokens
from quillspark.llm.shared import bounded_sample, remainder

#: Labelled documents that the model is learned from at most, and coordinates that features are hashed into.
MAX_TRAIN_ROWS, BITS = 8_000, 20
THRESHOLD = 0.3
#: Bytes of a word's heads, and how often a feature counts at most.
HEADS, MOST = (4, 6, 8), 4
_U = np.uint64


def coordinates(b: tokens.Batch, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Texts and coordinates of all words, heads, pairs and skip-pairs, repeats included."""
    starts, ends, first = b.words(tokens.ALNUM)
    words, owner = b.hashes(starts, ends, fold=True), tokens.owners(first)
    out = [(owner, words)]
    for gap, salt in ((1, 0x8CB92BA72F3D8DD7), (2, 0xD2B74407B1CE6E93)):
        if len(words) > gap:
            same = owner[gap:] == owner[:-gap]
            out.append((owner[gap:][same], (words[:-gap] * _U(salt) + words[gap:])[same]))
    for size in HEADS:
        longer = ends - starts > size
        if longer.any():
            out.append((owner[longer], b.hashes(starts[longer], starts[longer] + size, fold=True) ^ _U(size)))
    return [(o, (tokens.mix(h) >> _U(64 - bits)).astype(np.int64)) for o, h in out]


def held(b: tokens.Batch, bits: int, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, coordinates and values, each pair once, sorted by text; with `only`, coordinates whose weight isn't 0."""
    keys = []
    for owner, at in coordinates(b, bits):
        if only is not None:
            hit = np.flatnonzero(only[at])
            owner, at = owner[hit], at[hit]
        keys.append((owner << bits) | at)
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key >> bits, key & ((1 << bits) - 1), np.minimum(count, MOST)


@dataclass
class Ftrl:
    """Weights that aren't 0, the bias, and the number of coordinates."""

    at: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits, np.float32)
        out[self.at] = self.weights
        return out


def learn(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, *, alpha: float = 0.3, beta: float = 1.0, l1: float = 10.0, l2: float = 0.0, epochs: int = 3) -> Ftrl:
    """rows: each text's coordinates and values, as coordinate * 8 + value. An epoch's order is fixed by its number."""
    size = 1 << bits
    z, n, bias = np.zeros(size + 1), np.zeros(size + 1), np.array([size])
    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x = np.concatenate((rows[i] >> 3, bias)), np.append(rows[i] & 7, 1).astype(float)
            zi, ni = z[at], n[at]
            penalty = np.full(len(at), l1)
            penalty[-1] = 0
            w = np.where(np.abs(zi) <= penalty, 0.0, -(zi - np.sign(zi) * penalty) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - labels[i]) * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[at] = ni + g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    b = -z[size] / ((beta + np.sqrt(n[size])) / alpha + l2)
    at = np.flatnonzero(w[:size])
    return Ftrl(at, w[at].astype(np.float32), float(b), bits)


def training_rows(column: pa.Array, bits: int) -> pa.Array:
    """Each text's coordinates and values, as coordinate * 8 + value."""
    parts = []
    for _, b in tokens.batches(column):
        text, at, value = held(b, bits)
        off = np.searchsorted(text, np.arange(b.n + 1))
        parts.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array((at * 8 + value).astype(np.int32))))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))


def probabilities(column: pa.Array, model: Ftrl) -> np.ndarray:
    dense, out = model.dense(), []
    for _, b in tokens.batches(column):
        text, at, value = held(b, model.bits, dense)
        total = model.bias + np.bincount(text, dense[at] * value, minlength=b.n)
        out.append(1 / (1 + np.exp(-np.clip(total, -700, 700))))
    return np.concatenate(out) if out else np.zeros(0)


def fit(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, bits: int = BITS, **options) -> Ftrl | None:
    """Learn from the labelled documents (toxic 0 or 1); None where there are none."""
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    chosen = bounded_sample(documents.select("doc_id").join(marked, "doc_id").distinct(), "doc_id", max_rows)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def rows_of(text: pa.Array) -> pa.Array:
        return training_rows(text, bits)

    texts = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # max_rows ids
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # a repeated doc_id is one row on the driver
    table = texts.select("doc_id", "label", rows_of("text").alias("at")).toArrow().sort_by("doc_id")
    if not table.num_rows:
        return None
    lists = table.column("at").combine_chunks()
    off, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    rows = [flat[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
    return learn(rows, table.column("label").to_numpy().astype(float), bits, **options)


def scores(model: Ftrl, spark: SparkSession):
    """A function of a text column: the probability that the text is toxic."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        return pa.array(probabilities(text, shared.value))

    return score


def scored(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; the held-out quarter's labels are not read."""
    held_out = remainder("doc_id", 4) == 2
    model = fit(documents, labels.where(~held_out), **options)
    score = F.lit(0.0) if model is None else scores(model, documents.sparkSession)(F.col("text").cast("string"))
    out = documents.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
