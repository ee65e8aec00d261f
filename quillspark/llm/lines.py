"""Line dedup that stays reversible: sharded cuckoo filters, backed by exact reference tables.

A line's key is the line without blanks at its ends and with A-Z lower-cased. A store holds a log of references, one
row for each key and text that came or went; counts and first holders are sums over it, so insertion and deletion of
documents are exact, and neither rewrites what is there. Over the keys that several documents share stand cuckoo
filters, one a shard, kept as a table. An insertion or deletion changes them in place: only keys that it makes shared,
or no longer shared, are put into or taken out of their shard's filter, and a shard that is too full is built anew
from the exact table. A document's digests are routed to their shards by a shuffle, in parts, where its filter passes
in front of them: what it doesn't know stays without any look-up, and what it lets through is joined with the
exact table. So no filter is broadcast, and nothing changes with their number.

Defined cases: a null or empty text is one empty line. Rows that share a doc_id are one document; each text of it
loses its own lines. A null doc_id counts as the largest id. Short keys are never dropped. Ties can't arise: of a key's
holders the smallest id keeps it, in all its rows and places. Very long texts are read whole. An empty table gives an
empty result. Other columns are kept as they are; names that begin with __q_ are ours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.cuckoo import CuckooFilter
from quillspark.llm.shared import ordered_id, staged, unstaged

#: Code points of a key from which on its lines may go.
MIN_KEY = 10
#: Keys that one shard's filter holds, about; with more than twice as many the store doubles its shards. Parts that a
#: shard's questions are dealt over, so that a line in very many documents doesn't meet its filter in one task.
SHARD_KEYS, PARTS = 1 << 15, 8

_BLANKS = b" \t\n\x0b\x0c\r"
KEY = ["key_hi", "key_lo"]
REFS = "key_hi long, key_lo long, id long, text_key long"


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANKS).lower()  # bytes.lower() changes A-Z only


def long_enough(key: bytes) -> bool:
    if len(key) < MIN_KEY:
        return False
    return len(key) >= 4 * MIN_KEY or len(key.decode("utf-8", "replace")) >= MIN_KEY


def digest(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_digest(key)
    return int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _digests(text: bytes) -> dict[bytes, tuple[int, int]]:
    """The digests of one text's keys that are long enough, each once."""
    keys = {line_key(x) for x in text.split(b"\n")}
    return {k: digest(k) for k in keys if long_enough(k)}


def text_key(text: str = "text") -> Column:
    """What tells texts of one doc_id apart."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def references(documents: DataFrame) -> DataFrame:
    """One row for each key and document row that holds it."""

    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            held = [list(set(_digests(text).values())) for text in _texts(batch)]
            n = [len(x) for x in held]
            keys = np.array([k for x in held for k in x], np.int64).reshape(-1, 2)
            owners = [np.repeat(batch.column(c).to_numpy(), n) for c in ("id", "text_key")]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (*keys.T, *owners)], ["key_hi", "key_lo", "id", "text_key"])

    return documents.select(ordered_id().alias("id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text")).mapInArrow(step, REFS)


def shared_keys(refs: DataFrame) -> DataFrame:
    """Keys in two documents or more, with the smallest holder. Partial sums first, so a hot key moves as a row a task."""
    held = refs.groupBy(*KEY).agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return held.where("first_id < last_id").drop("last_id")


def _by_shard(it: Iterator[pa.RecordBatch], use) -> Iterator[pa.RecordBatch]:
    """Splits rows that are sorted by shard and part into runs of one shard and part, and calls use(shard, part, run) for each run of a batch."""
    for batch in it:
        if not batch.num_rows:
            continue
        shard, part = (batch.column(c).to_numpy() for c in ("shard", "part"))
        cuts = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (part[1:] != part[:-1]), [True])))
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            yield from use(int(shard[i]), int(part[i]), batch.slice(i, j - i))


def _probe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The questions that their shard's filter, the first row of a run, does not rule out."""
    held: dict = {"at": None, "filter": None}

    def use(shard: int, part: int, run: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if held["at"] != (shard, part):
            held["at"], held["filter"] = (shard, part), None
        if run.column("cells")[0].is_valid:
            held["filter"], run = CuckooFilter.load(run.column("cells")[0].as_py()), run.slice(1)
        if held["filter"] is not None and run.num_rows:
            maybe = held["filter"].maybe(run.column("key_lo").to_numpy().view(np.uint64))
            yield run.filter(pa.array(maybe)).select(["key_hi", "key_lo", "id", "text_key"])

    return _by_shard(it, use)


def _changed(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each shard's filter after its changes (sign 1 or -1); null cells where it is too full for them."""
    held: dict = {"at": None, "cells": None, "come": [], "gone": []}

    def done() -> Iterator[pa.RecordBatch]:
        if held["at"] is None:
            return
        come, gone = (np.concatenate(held[n] or [np.zeros(0, np.uint64)]) for n in ("come", "gone"))
        if held["cells"] is None:
            filter_, fits = CuckooFilter.of(come), True
        else:
            filter_ = CuckooFilter.load(held["cells"])
            for key in gone:
                filter_.delete(key)
            fits = all(map(filter_.insert, come))
        yield pa.RecordBatch.from_arrays([pa.array([held["at"]], pa.int64()), pa.array([filter_.dump() if fits else None], pa.binary())], ["shard", "cells"])

    def use(shard: int, part: int, run: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if held["at"] != shard:
            yield from done()
            held.update(at=shard, cells=None, come=[], gone=[])
        if run.column("cells")[0].is_valid:
            held["cells"], run = run.column("cells")[0].as_py(), run.slice(1)
        keys, sign = run.column("key_lo").to_numpy().view(np.uint64), run.column("sign").to_numpy()
        held["come"].append(keys[sign > 0])
        held["gone"].append(keys[sign < 0])

    yield from _by_shard(it, use)
    yield from done()


class LineStore:
    """The log of references, kept in the shared folder, and the filters over the keys that are shared now."""

    def __init__(self, spark: SparkSession, log: tuple[DataFrame, ...] = (), filters: DataFrame | None = None, shards: int = 0, keys: int = 0):
        self.spark, self.log, self.filters, self.shards, self.keys = spark, log, filters, shards, keys
        self._shared: DataFrame | None = None

    @classmethod
    def empty(cls, spark: SparkSession) -> LineStore:
        return cls(spark)

    @property
    def refs(self) -> DataFrame:
        """The references that are held: what came and has not gone since."""
        if not self.log:
            return self.spark.createDataFrame([], REFS)
        if len(self.log) == 1:
            return self.log[0].drop("sign")
        rows = self.log[0]
        for more in self.log[1:]:
            rows = rows.unionByName(more)
        return rows.groupBy(*KEY, "id", "text_key").agg(F.sum("sign").alias("sign")).where("sign > 0").drop("sign")

    def insert(self, documents: DataFrame) -> LineStore:
        """The store with these documents too."""
        new = references(documents).distinct()
        if self.log:
            new = new.join(self.refs, [*KEY, "id", "text_key"], "left_anti")
        return self._after(staged(new.withColumn("sign", F.lit(1)), "line-refs"))

    def delete(self, ids: DataFrame) -> LineStore:
        """The store without the documents of these doc_ids; whatever only they held is as if never seen."""
        gone = ids.select(ordered_id().alias("id")).distinct()
        return self._after(staged(self.refs.join(gone, "id", "left_semi").withColumn("sign", F.lit(-1)), "line-refs"))

    def _after(self, change: DataFrame) -> LineStore:
        out = LineStore(self.spark, (*self.log, change))
        if not self.log or not self.keys:
            return out._built()
        touched = change.select(*KEY).distinct()
        was, now = (shared_keys(s.refs.join(touched, KEY, "left_semi")).select(*KEY) for s in (self, out))
        come, gone = now.join(was, KEY, "left_anti"), was.join(now, KEY, "left_anti")
        changes = staged(come.withColumn("sign", F.lit(1)).unionByName(gone.withColumn("sign", F.lit(-1))), "line-changes")
        out.keys = self.keys + int(changes.agg(F.sum("sign")).first()[0] or 0)
        if out.keys > 2 * SHARD_KEYS * self.shards:
            return out._built()
        out.shards = self.shards
        filters = staged(self._filters_after(self.filters, changes, self.shards), "line-filters")
        full = filters.where("cells is null").select("shard")
        if not full.isEmpty():
            keys = out.shared.withColumn("shard", self._shard(self.shards)).join(full, "shard", "left_semi").withColumn("sign", F.lit(1))
            filters = staged(filters.where("cells is not null").unionByName(self._filters_after(None, keys.select(*KEY, "sign"), self.shards)), "line-filters")
        out.filters = filters
        unstaged(changes)
        return out

    def _built(self) -> LineStore:
        """With filters made anew from the exact table."""
        self.keys = self.shared.count()
        self.shards = 1 << max(0, (self.keys // SHARD_KEYS).bit_length())
        self.filters = staged(self._filters_after(None, self.shared.select(*KEY).withColumn("sign", F.lit(1)), self.shards), "line-filters")
        return self

    @staticmethod
    def _shard(shards: int) -> Column:
        return F.col("key_lo").bitwiseAND(F.lit(shards - 1).cast("long"))

    def _filters_after(self, filters: DataFrame | None, changes: DataFrame, shards: int) -> DataFrame:
        rows = changes.select(self._shard(shards).alias("shard"), F.lit(0).alias("part"), "key_lo", "sign", F.lit(None).cast("binary").alias("cells"))
        if filters is not None:
            rows = rows.unionByName(filters.select("shard", F.lit(0).alias("part"), F.lit(None).cast("long").alias("key_lo"), F.lit(None).cast("int").alias("sign"), "cells"))
        return rows.repartition("shard").sortWithinPartitions("shard", F.col("cells").isNull(), "sign", "key_lo").mapInArrow(_changed, "shard long, cells binary")

    @property
    def shared(self) -> DataFrame:
        if self._shared is None:
            self._shared = staged(shared_keys(self.refs), "line-keys")
        return self._shared

    def counts(self) -> DataFrame:
        """Exact references of each key: documents that hold it, and the first of them."""
        return self.refs.groupBy(*KEY).agg(F.countDistinct("id").alias("n_docs"), F.min("id").alias("first_id"))

    def doomed(self, asked: DataFrame) -> DataFrame:
        """For each text (id, text_key) with lines to drop the digests of their keys; asked: REFS."""
        part = F.pmod(F.xxhash64("id", "text_key"), F.lit(PARTS)).cast("int")
        none = lambda kind: F.lit(None).cast(kind)
        rows = asked.select(self._shard(self.shards).alias("shard"), part.alias("part"), *KEY, "id", "text_key", none("binary").alias("cells"))
        parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
        filters = self.filters.select("shard", parts.alias("part"), *[none("long").alias(c) for c in (*KEY, "id", "text_key")], "cells")
        routed = rows.unionByName(filters).repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("cells").isNull())
        hits = routed.mapInArrow(_probe, REFS).join(self.shared, KEY).where("id > first_id")
        return hits.groupBy("id", "text_key").agg(F.collect_set(F.struct(*KEY)).alias("keys"))


CLEANED = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())])


@F.arrow_udf(CLEANED)
def without_lines(text: pa.Array, keys: pa.Array) -> pa.Array:
    """Each text without the lines of the given keys."""
    lines, dropped, kept = [], [], []
    for t, gone in zip(text.cast(pa.binary()).to_pylist(), keys.to_pylist(), strict=True):
        parts = (t or b"").split(b"\n")
        lines.append(len(parts))
        if gone:
            out = {(g["key_hi"], g["key_lo"]) for g in gone}
            stay = [x for x in parts if not long_enough(k := line_key(x)) or digest(k) not in out]
            dropped.append(len(parts) - len(stay))
            kept.append(b"\n".join(stay))
        else:
            dropped.append(0)
            kept.append(t or b"")
    return pa.StructArray.from_arrays([pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=CLEANED.names)


def deduplicated(documents: DataFrame, store: LineStore | None = None) -> DataFrame:
    """documents with a struct column __q_lines: n_lines, n_dropped and kept_text. Without a store, one of these documents."""
    asked = None
    if store is None:
        store = LineStore.empty(documents.sparkSession).insert(documents)
        asked = store.refs
    doomed = store.doomed(references(documents) if asked is None else asked)
    doomed = doomed.select(F.col("id").alias("__q_id"), F.col("text_key").alias("__q_text"), F.col("keys").alias("__q_keys"))
    joined = documents.withColumn("__q_id", ordered_id()).withColumn("__q_text", text_key()).join(doomed, ["__q_id", "__q_text"], "left")
    once = without_lines.asNondeterministic()  # else a later filter on it would have every text cut twice
    return joined.withColumn("__q_lines", once(F.col("text").cast("string"), "__q_keys")).drop("__q_id", "__q_text", "__q_keys")


def filtered(documents: DataFrame) -> DataFrame:
    """documents, all columns, their texts without lines that an earlier document holds, and n_chars to match.

    A document that loses all its words this way is a copy of earlier ones and goes; one without words from the start stays.
    """
    out = deduplicated(documents)
    out = out.where((F.col("__q_lines.n_dropped") == 0) | F.regexp_like(F.col("__q_lines.kept_text"), F.lit(r"[^\x20\x09-\x0D]")))
    text = F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.col("__q_lines.kept_text"))
    changed = out.withColumn("text", text)
    if "n_chars" in documents.columns:
        n = F.when(F.col("__q_lines.n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", n.cast(documents.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in documents.columns])
