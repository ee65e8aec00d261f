"""Groups of spelling variants: a symmetric-delete join finds all words at distance one, and forms are followed to roots.

Words are counted inside the tasks, document by document, and added up by word. Each word then emits a key for itself
and one for each of its distinct single deletions; a key is a 64-bit hash, computed for all of a word's deletions in one
pass, with the range of places whose deletion gives it (equal letters in a row give the same). Two words at distance one
share exactly one key that fits: both deleted a place that is in both ranges (a letter replaced), or one of them is the
key itself (a letter inserted). That condition is part of the equi-join, so the join gives near pairs only; each is then
verified on the words themselves. A key is shared by no more words than one insertion into it can make, so no key grows
with the corpus.

Words get ids in code-point order, so ties and joins need no strings. A word's form is its most frequent near word,
where that is at least twice as frequent. Chains of forms therefore are short (each step doubles the count), and roots
are found by joining the table of forms with itself, doubling the steps, until nothing changes.

Defined cases: null and empty texts have no words; very long texts are read piece by piece, and very long words cost
time and keys by their length only. Rows that share a doc_id, or have none (its text is then empty), count each for
itself. Without words the result is empty. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import staged, unstaged
from quillspark.llm.tokens import mix, signed

#: Least code points and occurrences of a word; a word's form is at least so many times as frequent.
LETTERS, TIMES, MORE = 5, 3, 2
#: One run in so many loses a letter.
LOSES = 97
#: Characters of a text that are cut at once, and distinct words that a task holds before it hands their counts on.
PIECE, HELD = 1 << 20, 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")
_FOLD = {c: c + 32 for c in range(65, 91)}
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def runs(text: str) -> Counter:
    """The text's runs of letters with A-Z lower-cased, and how often each occurs."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        found.update(_RUN.findall(text, at, end))
        at = end
    out: Counter = Counter()
    for run, n in found.items():
        out[run.lower() if run.isascii() else run.translate(_FOLD)] += n
    return out


def word_of(doc_id: str, run: str) -> str:
    """The run, or what is left of it if this document's copy loses a letter."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % LOSES:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def word_counts(documents: DataFrame, least: int = LETTERS) -> DataFrame:
    """word and n of all words of at least so many code points."""

    def batch_of(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in it:
            for doc_id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                name = doc_id.as_py()
                for run, n in runs(text.as_py()).items():
                    word = word_of(name, run)
                    if len(word) >= least:
                        counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD:
                    yield batch_of(counts)
                    counts = {}
        if counts:
            yield batch_of(counts)

    rows = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text"))
    return rows.where("text is not null").mapInArrow(step, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def deletion_keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word's keys the word's place, the key, and the first and last place whose deletion gives it (-1: none)."""
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    up, down = np.full(len(points) + 2, _BASE, _U), np.full(len(points) + 2, pow(_BASE, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    total = np.zeros(len(points) + 1, _U)
    np.cumsum(mix(points.astype(_U) + _U(1)) * up[: len(points)], out=total[1:])
    owner = np.repeat(np.arange(len(size)), size)
    new = np.ones(len(points), bool)
    new[1:] = (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(points)) - 1
    word = owner[low]
    a, z = first[word], first[word + 1]
    gone = (total[low] - total[a]) * down[a] + (total[z] - total[low + 1]) * down[a + 1]
    gone = mix(gone + (z - a - 1).astype(_U) * _U(0xA24BAED4963EE407))
    whole = (total[first[1:]] - total[first[:-1]]) * down[first[:-1]]
    whole = mix(whole + size.astype(_U) * _U(0xA24BAED4963EE407))
    none = np.full(len(size), -1)
    return (np.concatenate(x) for x in ((word, np.arange(len(size))), (gone, whole), (low - a, none), (high - a, none)))


def _keyed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        if batch.num_rows:
            word, key, low, high = deletion_keys(batch.column("word"))
            ids = batch.column("id").take(pa.array(word))
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), ids, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["key", "id", "low", "high"])


def near_pairs(words: DataFrame) -> DataFrame:
    """a and b (a < b): the ids of all words (id, word) at distance one."""
    keys = staged(words.select("id", "word").mapInArrow(_keyed, "key long, id long, low int, high int"), "word-keys")
    one, two = keys.alias("one"), keys.alias("two")
    replaced = (F.col("one.low") >= 0) & (F.col("two.low") >= 0) & (F.col("one.low") <= F.col("two.high")) & (F.col("two.low") <= F.col("one.high"))
    inserted = (F.col("one.low") < 0) != (F.col("two.low") < 0)
    pairs = one.join(two, (F.col("one.key") == F.col("two.key")) & (F.col("one.id") < F.col("two.id")) & (replaced | inserted)).select(F.col("one.id").alias("a"), F.col("two.id").alias("b"))
    texts = lambda n: words.select(F.col("id").alias(n), F.col("word").alias(f"{n}_word"))
    return pairs.join(texts("a"), "a").join(texts("b"), "b").where(F.levenshtein("a_word", "b_word", 1) == 1).select("a", "b")


def roots_of(forms: DataFrame) -> DataFrame:
    """id and root of every row of forms (id, form): the last word that forms lead to."""
    steps = staged(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        longer = staged(steps.join(ahead, "root", "left").select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        unstaged(steps)
        if longer.where("moved").isEmpty():
            return longer.select("id", "root")
        steps = longer


def grouped(documents: DataFrame, letters: int = LETTERS, times: int = TIMES, more: int = MORE) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of at least so many letters and occurrences."""
    counted = word_counts(documents, letters).where(F.col("n") >= times)
    words = staged(counted.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")  # written, so the ids stay
    pairs = staged(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
    met = both.join(words.select(F.col("id").alias("other"), F.col("n").alias("other_n")), "other")
    near = met.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    near = near.join(words.select("id", "n"), "id")
    good = -F.col("best.less") >= more * F.col("n")
    near = staged(near.select("id", "n_near", F.when(good, F.col("best.other")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")), "forms")
    unstaged(pairs)
    roots = roots_of(near.where("form is not null"))
    names = lambda n: words.select(F.col("id").alias(n), F.col("word").alias(f"{n}_word"))
    out = words.join(near, "id", "left").join(roots, "id", "left").join(names("form"), "form", "left").join(names("root"), "root", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("form_word").alias("form"), "form_n", F.coalesce("root_word", "word").alias("root"))
