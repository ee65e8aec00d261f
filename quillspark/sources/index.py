"""A positional inverted index: which documents say a phrase, answered from postings, without reading a text.

A posting is a term, a document and the term's places in it. Postings are grouped before they are shuffled: a task turns
some documents at a time into blocks, each a term with the documents that have it and its places in every one of them.
Blocks lie in folders by bucket (a hash of the term), sorted by term, so that a search reads the buckets of its terms
and, in these, the row groups of them. Documents are appended batch by batch; a batch counts once it is listed, so one
that failed half-way is never seen.

A phrase is sought from its rarest term on: the documents that have it are looked up in the postings of each term of
the phrase, whose places, moved back by the term's place in the phrase, must have a value in common. Postings
of frequent terms are joined by term and document, so a term that every document has makes no pairs.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.sources.store import exists

BUCKETS = 64
#: Parts over which a bucket's blocks are dealt at least; where the session has more shuffle partitions, there are more.
PARTS = 4
#: Places to look up (query, doc, term) that are broadcast; more are joined by a shuffle of the terms' postings.
MOST_BROADCAST = 200_000
#: Words that are turned into blocks at once, however many documents a batch has; a longer document is alone.
WORDS = 1 << 19
TERM = r"[\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """The terms of a text in their order: letters and digits, lower-cased."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _slices(batch: pa.RecordBatch):
    """The batch in parts of WORDS words at most, and of one document at least."""
    ends = batch.column("words").offsets.to_numpy().astype(np.int64)
    a = 0
    while a < batch.num_rows:
        z = max(a + 1, int(np.searchsorted(ends, ends[a] + WORDS, side="right")) - 1)
        yield batch.slice(a, z - a)
        a = z


def _blocks(batches):
    """Blocks of some documents (doc, words) of an Arrow batch at a time: for each term the docs that have it, and its places in each."""
    for whole in batches:
        for batch in _slices(whole):
            words = batch.column("words")
            held = words.flatten().dictionary_encode()
            sizes = np.diff(words.offsets.to_numpy())
            if not len(held):
                continue
            codes, row = held.indices.to_numpy(), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            at = (np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            order = np.argsort(codes, kind="stable")  # rows and places stay ascending inside a term
            codes, row, at = codes[order], row[order], at[order]
            term = np.flatnonzero(np.diff(codes, prepend=-1))
            posting = np.flatnonzero((np.diff(codes, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
            ends = np.append(np.searchsorted(posting, term), len(posting)).astype(np.int32)
            places = pa.ListArray.from_arrays(np.append(posting, len(at)).astype(np.int32), pa.array(at))
            docs = pa.ListArray.from_arrays(ends, batch.column("doc").take(pa.array(row[posting])))
            yield pa.RecordBatch.from_arrays([held.dictionary.take(pa.array(codes[term])), docs, pa.ListArray.from_arrays(ends, places)], ["term", "docs", "places"])


class Index:
    """An index at a path. `append` adds documents, `search` finds phrases, `compact` puts all batches together.

    `parts` deals a bucket's blocks over as many tasks and files; it should grow with the documents of a batch.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, parts: int | None = None):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.parts = parts or max(PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets)

    def _batches(self) -> DataFrame | None:
        where = f"{self.path}/batches"
        return self.spark.read.schema("batch string, replaces string").parquet(where) if exists(self.spark, where) else None

    def batches(self) -> list[str]:
        """Names of the batches that count, one for each append since the last compaction."""
        held = self._batches()
        if held is None:
            return []
        rows = held.collect()
        gone = {r.replaces for r in rows if r.replaces}
        return sorted({r.batch for r in rows} - gone)

    def _list(self, batch: str, replaces: list[str] | None = None) -> None:
        rows = [(batch, r) for r in replaces or [None]]
        self.spark.createDataFrame(rows, "batch string, replaces string").coalesce(1).write.mode("append").parquet(f"{self.path}/batches")

    def _write(self, blocks: DataFrame) -> str:
        batch = uuid.uuid4().hex
        part = F.pmod(F.xxhash64(F.get("docs", F.lit(0))), F.lit(self.parts))
        dealt = blocks.repartition("bucket", part).sortWithinPartitions("bucket", "term")
        dealt.write.partitionBy("bucket").parquet(f"{self.path}/postings/{batch}")
        held = self.spark.read.schema(blocks.schema).parquet(f"{self.path}/postings/{batch}")  # a batch without terms has no files
        held.groupBy("bucket", "term").agg(F.sum(F.size("docs")).alias("n_docs")).write.parquet(f"{self.path}/terms/{batch}")
        return batch

    def append(self, documents: DataFrame) -> str:
        """Index documents (doc, text); a doc that is there already is not replaced, it has the places of all its texts."""
        doc = documents.schema["doc"].dataType
        kinds = T.StructType([T.StructField("term", T.StringType()), T.StructField("docs", T.ArrayType(doc)), T.StructField("places", T.ArrayType(T.ArrayType(T.IntegerType())))])
        blocks = documents.select("doc", terms(F.col("text")).alias("words")).mapInArrow(_blocks, kinds)
        batch = self._write(blocks.withColumn("bucket", _bucket(F.col("term"), self.buckets)))
        self._list(batch)
        return batch

    def compact(self) -> str | None:
        """One batch in place of all; the old ones' files stay until someone deletes them, so running searches go on."""
        old = self.batches()
        if len(old) < 2:
            return old[0] if old else None
        batch = self._write(self.blocks())
        self._list(batch, old)
        return batch

    def _read(self, kind: str, schema: str) -> DataFrame:
        out = None
        for b in self.batches():
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/{b}")
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], schema) if out is None else out

    def blocks(self) -> DataFrame:
        """term, docs, places (by doc) and bucket."""
        return self._read("postings", "term string, docs array<long>, places array<array<int>>, bucket int")

    def postings(self, blocks: DataFrame | None = None) -> DataFrame:
        """term, doc and the term's places in it, of all blocks or of those given."""
        each = (self.blocks() if blocks is None else blocks).select("term", F.explode(F.arrays_zip("docs", "places")).alias("p"))
        return each.select("term", F.col("p.docs").alias("doc"), F.col("p.places").alias("places"))

    def document_counts(self) -> DataFrame:
        """term and n_docs over all batches."""
        return self._read("terms", "bucket int, term string, n_docs long").groupBy("bucket", "term").agg(F.sum("n_docs").alias("n_docs"))

    def search(self, queries: DataFrame) -> DataFrame:
        """query_id, doc and starts (places of first words, ascending) of every phrase (query_id, phrase) in every document that says it.

        A phrase without terms is nowhere.
        """
        asked = queries.select("query_id", terms(F.col("phrase")).alias("w")).where(F.size("w") > 0)
        each = asked.select("query_id", F.size("w").alias("size"), F.posexplode("w").alias("at", "term")).withColumn("bucket", _bucket(F.col("term"), self.buckets))
        buckets = [r.bucket for r in each.select("bucket").distinct().collect()]  # no more than there are folders
        counts = self.document_counts().where(F.col("bucket").isin(buckets)).join(each.select("term").distinct(), "term", "left_semi")
        known = each.join(counts.select("term", "n_docs"), "term")
        whole = known.groupBy("query_id", "size").agg(F.min(F.struct("n_docs", "at", "term")).alias("rare"), F.collect_list(F.struct("at", "term")).alias("parts")).where(F.size("parts") == F.col("size"))
        rare = whole.select("query_id", "size", F.col("rare.term").alias("term"), "parts")
        blocks = self.blocks().where(F.col("bucket").isin(buckets)).join(each.select("term").distinct(), "term", "left_semi")
        maybe = blocks.select("term", F.explode("docs").alias("doc")).join(rare, "term").select("query_id", "doc", "size", F.explode("parts").alias("r"))
        maybe = maybe.select("query_id", "doc", "size", "r.at", "r.term")
        most = whole.agg(F.sum(F.col("rare.n_docs") * F.col("size"))).first()[0] or 0  # rows of maybe, from counts alone
        held = self.postings(blocks).join(F.broadcast(maybe) if most <= MOST_BROADCAST else maybe, ["term", "doc"])
        held = held.select("query_id", "doc", "size", "at", F.transform("places", lambda p: p - F.col("at")).alias("starts"))
        # a doc given twice has several rows a term, so places are united by term before they are intersected
        both = held.groupBy("query_id", "doc", "size").agg(F.collect_list(F.struct("at", "starts")).alias("all"))
        of = lambda at: F.array_distinct(F.flatten(F.transform(F.filter("all", lambda x: x["at"] == at), lambda x: x["starts"])))
        starts = F.aggregate(F.sequence(F.lit(1), F.col("size")), of(F.lit(0)), lambda done, x: F.array_intersect(done, F.when(x < F.col("size"), of(x)).otherwise(done)))
        return both.select("query_id", "doc", F.array_sort(starts).alias("starts")).where(F.size("starts") > 0)
