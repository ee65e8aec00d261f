"""Benchmark decontamination as a prefix-filtered set join.

An item's windows are its runs of ten words (an item of fewer words is one window). A window is a set of
shingles; a document holds the window only if it holds all of them, so by the prefix principle one shingle,
the rarest, is enough to find every candidate. Shingle rarity is counted over all documents. A document
position whose shingle is some window's prefix shingle is a candidate if the window then fits into the
document's words (length and positional bound); each candidate is verified word by word.

Benchmark items are handled in blocks of a bounded number of windows, and only one block at a time is
broadcast; any number of items is therefore exact. A block reads the documents twice, for rarity and for its hits.
With one block the hits are a column right away; with more, each block writes only the hits of texts that have any,
under a digest of the text, and one join at the end brings them together, so the documents are never written again.

Defined cases: null texts have no words. An item without words has no window. Items with a null id mark
words but are not counted or listed. Equal items each count. Rows that repeat are marked each; rows that share a
doc_id are marked by their own text. Ties between equally rare shingles go to the smaller hash. Very long texts are
read whole. Other columns are kept; names that begin with __q_ are ours. Empty tables give no rows, or no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import tokens
from quillspark.llm.shared import staged

WINDOW, SHINGLE = 10, 5
#: Windows in one block; a block takes some 400 bytes a window on each executor.
BLOCK_WINDOWS = 200_000
_U = np.uint64


def words_of(b: tokens.Batch) -> tuple[np.ndarray, np.ndarray]:
    """Folded word hashes and the first word of each text."""
    starts, ends, first = b.words(tokens.ALNUM)
    return b.hashes(starts, ends, fold=True), first


def item_words(text: str | None) -> np.ndarray:
    return next(iter((words_of(b)[0] for _, b in tokens.batches(pa.array([text or ""], pa.string())))))


@dataclass
class Block:
    """Windows of some items: their word hashes, flat, and what is needed to find and verify them."""

    words: np.ndarray  # all distinct windows' words, flat
    start: np.ndarray  # of each window in words; one more than windows
    items: list[list]  # item ids of each window
    rare: np.ndarray  # prefix shingles, sorted
    window: np.ndarray  # the window of each prefix shingle
    offset: np.ndarray  # place of the shingle in its window


def windows_of(items: list[tuple[object, str | None]]) -> dict[bytes, list]:
    """Distinct windows (their word hashes as bytes) and the items that hold each."""
    out: dict[bytes, list] = {}
    for item, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - WINDOW + 1) if len(w) else 0):
            holders = out.setdefault(w[i : i + WINDOW].tobytes(), [])
            if item is not None and (not holders or holders[-1] != item):
                holders.append(item)
    return out


def _run(w: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles of one window and their length."""
    size = min(SHINGLE, len(w))
    return tokens.shingles(w, np.array([0, len(w)]), size)[0], size


def _found(runs: np.ndarray, sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of runs that occur in the sorted array, and where."""
    if not len(sorted_) or not len(runs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a table of 2**20 bits on the hash's top bits rejects nearly all runs before the search
    head = np.zeros(1 << 20, bool)
    head[(sorted_ >> _U(44)).astype(np.int64)] = True
    hit = np.flatnonzero(head[(runs >> _U(44)).astype(np.int64)])
    at = np.searchsorted(sorted_, runs[hit])
    good = (at < len(sorted_)) & (sorted_[np.minimum(at, len(sorted_) - 1)] == runs[hit])
    return hit[good], at[good]


def _sizes(distinct: dict[bytes, list]) -> list[int]:
    return sorted({min(SHINGLE, len(k) // 8) for k in distinct})


def rarity(documents: DataFrame, distinct: dict[bytes, list]) -> dict[int, int]:
    """Occurrences of each of the windows' shingles in all documents."""
    own = np.unique(np.concatenate([_run(np.frombuffer(k, _U))[0] for k in distinct] or [np.zeros(0, _U)]))
    sizes = _sizes(distinct)
    shared = documents.sparkSession.sparkContext.broadcast(own)

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        total = np.zeros(len(own), np.int64)
        for batch in it:
            for _, b in tokens.batches(batch.column("text")):
                w, first = words_of(b)
                for size in sizes:
                    total += np.bincount(_found(tokens.shingles(w, first, size)[0], own)[1], minlength=len(own))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(tokens.signed(own[at])), pa.array(total[at])], ["run", "n"])

    counts = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(step, "run long, n long")
    return {r.run: r.n for r in counts.groupBy("run").agg(F.sum("n").alias("n")).collect()}


def block_of(distinct: dict[bytes, list], counts: dict[int, int]) -> Block:
    """Each window's rarest shingle as its prefix; ties go to the smaller hash, then to the earlier place."""
    words, items, rare, offset = [], [], [], []
    for key, holders in distinct.items():
        w = np.frombuffer(key, _U)
        runs, _ = _run(w)
        seen = [counts.get(int(x), 0) for x in tokens.signed(runs)]
        at = min(range(len(runs)), key=lambda i: (seen[i], int(runs[i]), i))
        words.append(w)
        items.append(holders)
        rare.append(runs[at])
        offset.append(at)
    order = np.argsort(np.array(rare, _U), kind="stable") if rare else np.zeros(0, np.int64)
    start = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    return Block(np.concatenate(words) if words else np.zeros(0, _U), start, items, np.array(rare, _U)[order], order, np.array(offset, np.int64)[order])


def occurrences(b: tokens.Batch, block: Block, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words of the texts, and of each window that occurs: its text, its first word, the window."""
    w, first = words_of(b)
    owner = tokens.owners(first)
    texts, places, windows = [], [], []
    lengths = np.diff(block.start)
    prefixes, begin = np.unique(block.rare, return_index=True)
    count = np.diff(np.append(begin, len(block.rare)))
    for size in sizes:
        runs, at = tokens.shingles(w, first, size)
        hit, found = _found(runs, prefixes)
        if not len(hit):
            continue
        each = count[found]
        place = np.repeat(at[hit], each)
        entry = np.repeat(begin[found], each) + (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
        win = block.window[entry]
        place = place - block.offset[entry]
        text = owner[np.repeat(at[hit], each)]
        fits = (place >= first[text]) & (place + lengths[win] <= first[text + 1]) & (np.minimum(lengths[win], SHINGLE) == size)
        place, win, text = place[fits], win[fits], text[fits]
        good = np.ones(len(place), bool)
        for k in range(WINDOW):
            inside = lengths[win] > k
            i = np.flatnonzero(good & inside)
            good[i] = w[place[i] + k] == block.words[block.start[win[i]] + k]
        texts.append(text[good])
        places.append(place[good])
        windows.append(win[good])
    none = np.zeros(0, np.int64)
    return first, np.concatenate(texts or [none]), np.concatenate(places or [none]), np.concatenate(windows or [none])


def _listed(ids: set) -> tuple[int, str]:
    return len(ids), hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


HITS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(T.LongType()))])


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[dict[bytes, list]]:
    """The items' windows, some at a time; the driver never holds more than a block and one item."""
    distinct: list[tuple] = []
    total = 0
    for r in benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct().orderBy("item_id", "text").toLocalIterator():
        distinct.append((r.item_id, r.text))
        total += len(r.text or "") // 2 + 1
        if total > limit:
            yield windows_of(distinct)
            distinct, total = [], 0
    if distinct:
        yield windows_of(distinct)


def _marker(documents: DataFrame, distinct: dict[bytes, list]):
    """A function of a text column: what one block's windows mark, as HITS."""
    block = block_of(distinct, rarity(documents, distinct))
    shared, sizes = documents.sparkSession.sparkContext.broadcast(block), _sizes(distinct)

    @F.arrow_udf(HITS)
    def mark(text: pa.Array) -> pa.Array:
        block = shared.value
        n_words, n_hit, n_items, sha, ids_, spans_ = [], [], [], [], [], []
        for _, b in tokens.batches(text):
            first, texts, places, windows = occurrences(b, block, sizes)
            lengths = np.diff(block.start)
            cover = np.zeros(first[-1] + 1, np.int64)
            np.add.at(cover, places, 1)
            np.add.at(cover, places + lengths[windows], -1)
            hit = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
            n_words += np.diff(first).tolist()
            n_hit += (hit[first[1:]] - hit[first[:-1]]).tolist()
            held: dict[int, tuple[set, list]] = {}
            for t, p, v in zip(texts.tolist(), places.tolist(), windows.tolist(), strict=True):
                ids, spans = held.setdefault(t, (set(), []))
                ids.update(block.items[v])
                spans.append((p - int(first[t]), p - int(first[t]) + int(lengths[v])))
            for t in range(b.n):
                ids, spans = held.get(t, ((), ()))
                n, digest = _listed(set(ids))
                n_items.append(n)
                sha.append(digest)
                ids_.append(sorted(map(str, ids)))
                spans_.append([x for s in _merged(spans) for x in s])
        arrays = [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(sha, pa.string()), pa.array(ids_, pa.list_(pa.string())), pa.array(spans_, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(arrays, names=HITS.names)

    return mark


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@F.arrow_udf(HITS)
def _union(blocks: pa.Array) -> pa.Array:
    """What several blocks mark in the same text, as one."""
    rows = []
    for parts in blocks.to_pylist():
        ids = {x for p in parts for x in p["item_ids"]}
        spans = _merged([tuple(p["spans"][i : i + 2]) for p in parts for i in range(0, len(p["spans"]), 2)])
        n, digest = _listed(ids)
        rows.append({"n_words": parts[0]["n_words"], "n_hit": sum(b - a for a, b in spans), "n_items": n, "items_sha256": digest, "item_ids": sorted(ids), "spans": [x for s in spans for x in s]})
    fields = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(pa.int64()))])
    return pa.array(rows, fields)


@F.arrow_udf(T.LongType())
def _n_words(text: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([np.zeros(0, np.int64), *(np.diff(words_of(b)[1]) for _, b in tokens.batches(text))]))


def _digest(text: Column) -> list[Column]:
    """128 bits that name a text."""
    return [F.xxhash64(text).alias("__q_a"), F.xxhash64(F.lit("second"), text).alias("__q_b")]


def marked(documents: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """documents with a struct column __q_hits (HITS); spans are in words, end exclusive."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    blocks = _blocks(benchmark, block_windows)
    first, second = next(blocks, {}), next(blocks, None)
    if second is None:
        return documents.withColumn("__q_hits", _marker(documents, first)(text))
    hits = None
    for distinct in chain((first, second), blocks):
        held = documents.select(*_digest(text), _marker(documents, distinct)(text).alias("h")).where("h.n_hit > 0")
        one = staged(held.groupBy("__q_a", "__q_b").agg(F.any_value("h").alias("h")), "hits")  # equal texts have equal hits
        hits = one if hits is None else hits.unionByName(one)
    found = hits.groupBy("__q_a", "__q_b").agg(F.collect_list("h").alias("h")).withColumn("__q_found", _union("h")).drop("h")
    digests = dict(zip(("__q_a", "__q_b"), _digest(text), strict=True))
    out = documents.withColumns(digests).join(found, ["__q_a", "__q_b"], "left")
    none = F.struct(_n_words(text).alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256"), F.array().cast("array<string>").alias("item_ids"), F.array().cast("array<bigint>").alias("spans"))
    return out.withColumn("__q_hits", F.coalesce("__q_found", none)).drop("__q_a", "__q_b", "__q_found")


def filtered(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without those that hold any benchmark window."""
    return marked(documents, benchmark).where("__q_hits.n_hit = 0").drop("__q_hits")
