"""Substring dedup by hashing normalised units and keeping the earliest ranked occurrence.

Units are lines, and lines are cut further where the content says so: a new unit starts at a word if a hash of it
and the word before it falls into one fifth of all values, so a passage is cut the same way wherever it stands,
also inside different lines. A digest covers a unit and the units after it up to a number of words, and every whole
line has a digest of its own, however short, so lines that repeat go whole, and exact copies with them; units are
normalised to their words, lower-cased, without punctuation. Digests are grouped over all documents; the
occurrence in the smallest doc_id, and the first there, is kept. What other occurrences cover is removed, and the
spans' offsets in the original text (code points, end exclusive) are what the operator returns.

Digests are shuffled once. A Bloom filter of bounded size over the shared ones then lets the second pass move little
more than what repeats; a full filter lets everything through, and a join with the exact table decides in any case.

Defined cases: null texts and lines without words have nothing to remove. Texts are ranked by doc_id, a null doc_id
as the largest, and texts that share a doc_id by a hash of the text; each has spans of its own. Rows that repeat both
doc_id and text are one: they stay or lose the same, and a span is returned once. What a text repeats itself goes
from its second place on, where that is clear of the first; ties can't arise otherwise. Very long texts are read
whole. Other columns don't matter. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm import tokens
from quillspark.llm.shared import LAST_ID, holds, ordered_id, staged, unstaged, words_of_filter

#: Words of a unit, about, and words that a digest covers at least.
UNIT_WORDS, MIN_WORDS = 5, 12
#: Words after which a unit ends in any case.
LONGEST = 32
_U = np.uint64
_HEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])

ROWS = "key long, check int, id long, text_key long, first_word int, last_word int, start int, end int, again boolean"
SPANS = "id long, text_key long, start int, end int, words int, first_id long"
#: Texts of one id are ranked by a hash below this.
_KEYS = 10**18


def blocks(b: tokens.Batch, size: int = UNIT_WORDS, least: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """All digests of a batch in reading order: text, key, check, the words and code points they cover, and again."""
    starts, ends, first = b.words(tokens.ALNUM)
    names = ("text", "key", "check", "first_word", "last_word", "start", "end", "again")
    if not len(starts):
        return dict.fromkeys(names, np.zeros(0, np.int64))
    words = b.hashes(starts, ends, fold=True)
    owner = tokens.owners(first)
    line = np.cumsum(b.buf == 10)[starts]
    new = np.ones(len(words), bool)
    pair = tokens.mix(words[:-1] * _U(0x8CB92BA72F3D8DD7) + words[1:])
    new[1:] = (owner[1:] != owner[:-1]) | (line[1:] != line[:-1]) | (pair % _U(size) == 0)
    since = np.arange(len(words)) - np.maximum.accumulate(np.where(new, np.arange(len(words)), 0))
    new |= (since > 0) & (since % LONGEST == 0)  # a run of one word shows no cut of its own
    at = np.flatnonzero(new)
    stops = np.append(at[1:], len(words))
    stop = np.searchsorted(stops, at + least)  # the first unit end that is far enough
    held = stop < len(stops)
    at, stop = at[held], stops[stop[held]]
    inside = stop <= first[owner[at] + 1]
    lines = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (line[1:] != line[:-1]))))
    at, stop = np.concatenate((at[inside], lines)), np.concatenate((stop[inside], np.append(lines[1:], len(words))))
    order = np.lexsort((stop, at))
    at, stop = at[order], stop[order]
    once = np.append(True, (at[1:] != at[:-1]) | (stop[1:] != stop[:-1]))  # a line may be a digest already
    at, stop = at[once], stop[once]
    one = tokens.spans(words, at, stop)
    two = tokens.spans(tokens.mix(words ^ _U(0x27D4EB2F165667C5)), at, stop)
    text = owner[at]
    _, earliest, group = np.unique(tokens.mix(one ^ tokens.mix(text.astype(_U))), return_index=True, return_inverse=True)
    again = at >= stop[earliest][group]
    heads = np.concatenate(([0], np.cumsum(_HEAD[b.buf])))
    base = heads[b.off[text]]
    small = lambda x: x.astype(np.int32)
    values = (text, tokens.signed(one), small(two >> _U(33)), small(at - first[text]), small(stop - first[text]), small(heads[starts[at]] - base), small(heads[ends[stop - 1]] - base), again)
    return dict(zip(names, values, strict=True))


def text_key(text: Column) -> Column:
    """What ranks texts of one doc_id."""
    return F.pmod(F.xxhash64(text), F.lit(_KEYS))


def _rank() -> Column:
    """id and text_key as one number, which unlike a struct is summed up by hashing."""
    return (F.col("id").cast("decimal(20,0)") * F.lit(_KEYS).cast("decimal(19,0)") + F.col("text_key")).cast("decimal(38,0)")


def _rows(documents: DataFrame, size: int, least: int, shared=None) -> DataFrame:
    """key, check, id and text_key of all digests; with the filter of shared ones, ROWS of what may be shared or repeats itself."""
    names = ("key", "check", "id", "text_key") if shared is None else ("key", "check", "id", "text_key", "first_word", "last_word", "start", "end", "again")
    types = {"key": pa.int64(), "id": pa.int64(), "text_key": pa.int64(), "again": pa.bool_()}

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, keys = batch.column("id").to_numpy(), batch.column("text_key").to_numpy()
            for i, b in tokens.batches(pc.utf8_lower(batch.column("text"))):  # letter for letter, so code points keep their places
                found = blocks(b, size, least)
                again = found["again"].astype(bool)
                keep = np.flatnonzero(~again if shared is None else again | holds(shared.value, found["key"]))
                at = i + found["text"][keep].astype(np.int64)
                found = {n: v[keep] for n, v in found.items()} | {"id": ids[at], "text_key": keys[at]}
                yield pa.RecordBatch.from_arrays([pa.array(found[n], types.get(n, pa.int32())) for n in names], list(names))

    schema = "key long, check int, id long, text_key long" if shared is None else ROWS
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(ordered_id().alias("id"), text_key(text).alias("text_key"), text.alias("text")).mapInArrow(step, schema)


def _merged(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins what sorted rows cover to spans; a batch's last document waits for the next batch."""
    names = ("id", "text_key", "first_word", "last_word", "start", "end", "first_id")
    held: dict[str, np.ndarray] | None = None

    def spans(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        new = np.ones(len(rows["id"]), bool)
        new[1:] = (rows["id"][1:] != rows["id"][:-1]) | (rows["text_key"][1:] != rows["text_key"][:-1])
        above = np.cumsum(new) << 32  # a document's rows are above those of the one before
        reach = lambda name: np.maximum.accumulate(above + rows[name]) - above  # noqa: E731  a line may hold the rows after it
        last_word, end = reach("last_word"), reach("end")
        new[1:] |= rows["first_word"][1:] > last_word[:-1]
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(new)) - 1
        out = (rows["id"][at], rows["text_key"][at], rows["start"][at], end[last], last_word[last] - rows["first_word"][at], rows["first_id"][at])
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["id", "text_key", "start", "end", "words", "first_id"])

    for batch in it:
        rows = {n: batch.column(n).to_numpy() for n in names}
        if held is not None:
            rows = {n: np.concatenate((held[n], rows[n])) for n in names}
        if not len(rows["id"]):
            continue
        other = np.flatnonzero((rows["id"] != rows["id"][-1]) | (rows["text_key"] != rows["text_key"][-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        held = {n: v[cut:] for n, v in rows.items()}
        if cut:
            yield spans({n: v[:cut] for n, v in rows.items()})
    if held is not None and len(held["id"]):
        yield spans(held)


def removed_spans(documents: DataFrame, unit_words: int = UNIT_WORDS, min_words: int = MIN_WORDS) -> DataFrame:
    """id, text_key, start, end, words and first_id (where the span's beginning stays) of every span to remove."""
    keys = _rows(documents, unit_words, min_words).groupBy("key", "check").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.min(_rank()).alias("first"))
    held = staged(keys.where("n > 1").drop("n"), "digests")
    shared = documents.sparkSession.sparkContext.broadcast(words_of_filter(held.select(F.col("key").alias("h"))))
    rows = _rows(documents, unit_words, min_words, shared).join(held, ["key", "check"], "left")
    gone = rows.where(F.col("again") | (_rank() > F.col("first"))).select("id", "text_key", "first_word", "last_word", "start", "end", F.coalesce("first_id", "id").alias("first_id"))
    gone = gone.distinct().repartition("id", "text_key").sortWithinPartitions("id", "text_key", "first_word")
    out = staged(gone.mapInArrow(_merged, SPANS), "spans")
    unstaged(held)
    return out


def without(text: Column, spans: Column) -> Column:
    """A text without the given spans (array of start, end), which are in order and apart from each other."""
    empty = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    step = lambda done, s: F.struct(F.concat(done["kept"], F.substring(text, done["at"] + 1, s["start"] - done["at"])).alias("kept"), s["end"].alias("at"))
    return F.aggregate(spans, empty, step, lambda d: F.concat(d["kept"], F.substring(text, d["at"] + 1, F.length(text))))


def cleaned(documents: DataFrame, **options) -> DataFrame:
    """doc_id, the text without its spans, and the removed spans with their original offsets, of every row."""
    spans = removed_spans(documents, **options).groupBy("id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed"))
    text = F.col("text").cast("string")
    joined = documents.select("doc_id", text.alias("text"), ordered_id().alias("id"), text_key(F.coalesce(text, F.lit(""))).alias("text_key")).join(spans, ["id", "text_key"], "left")
    kept = F.when(F.col("removed").isNull(), F.col("text")).otherwise(without(F.col("text"), F.col("removed")))
    return joined.select("doc_id", kept.alias("text"), "removed")


def original_id(column: str) -> Column:
    """The doc_id behind an ordered id."""
    return F.when(F.col(column) != LAST_ID, F.col(column))
