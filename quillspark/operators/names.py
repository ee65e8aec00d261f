"""Names of all subjects in one pass over the texts.

An alias table (subject, name) becomes phrases, every variant of every name, collapsed and lower-cased; the phrases
become an automaton that finds all of them while a text is read once, however many subjects there are. Texts don't
move: rows meet subjects without a shuffle. An automaton holds BLOCK characters of phrases at most and is what is
broadcast; a larger alias table is dealt over several, each of which passes over the texts.

A subject is in a text if the text contains one of its phrases, part of a word counts: the same as a test of each
phrase by `contains`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import text as X

#: Characters of phrases in one automaton, and rows that a task hands on at a time.
BLOCK, ROWS = 1 << 24, 100_000

#: How the blanks beyond U+00FF begin in UTF-8.
_WIDE = (b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")

_HELD: dict[str, object] = {}


def folded(text: Column) -> Column:
    """Case and white space aside; null for null. A text without wide blanks is matched against the narrow ones only, which takes half the time."""
    wide = reduce(or_, [F.contains(text.cast("binary"), F.lit(x)) for x in _WIDE])
    return F.lower(X.strip(F.when(wide, F.regexp_replace(text, f"{X.SPACE}+", " ")).otherwise(F.regexp_replace(text, r"[\t-\r\x1c-\x20\x85\xa0]+", " "))))


def phrases(aliases: DataFrame) -> DataFrame:
    """subject and phrase of every variant of every name; a blank name says nothing and is left out."""
    rows = aliases.select("subject", F.explode(X.expand_variants(F.array("name"))).alias("name"))
    return rows.select("subject", folded(F.col("name")).alias("phrase")).where("phrase <> '' and subject is not null").distinct()


def _automaton(key: str, words: Sequence[str], subjects: Sequence[int]):
    """Finds phrases; each gives the places of its subjects. A worker keeps the last one."""
    if key not in _HELD:
        import ahocorasick

        by: dict[str, list[int]] = {}
        for w, s in zip(words, subjects, strict=True):
            by.setdefault(w, []).append(s)
        a = ahocorasick.Automaton()
        for w, s in by.items():
            a.add_word(w, tuple(s))
        a.make_automaton()
        _HELD.clear()
        _HELD[key] = a
    return _HELD[key]


def _finding(shared, keep: Sequence[str]):
    def step(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, places, subjects = shared.value
        automaton = _automaton(key, words, places)
        for batch in it:
            rows: list[int] = []
            found: list[int] = []
            masks: list[int] = []

            def out(batch=batch):
                at = pa.array(rows, pa.int64())
                columns = [batch.column(c).take(at) for c in keep]
                return pa.RecordBatch.from_arrays([*columns, subjects.take(pa.array(found, pa.int64())), pa.array(masks, pa.int32())], [*keep, "subject", "columns"])

            for i, texts in enumerate(batch.column("__texts")):
                met: dict[int, int] = {}
                for k, text in enumerate(texts.as_py()):
                    bit = 1 << k
                    for _, ids in automaton.iter(text):
                        for s in ids:
                            met[s] = met.get(s, 0) | bit
                rows += [i] * len(met)
                found += met.keys()
                masks += met.values()
                if len(rows) >= ROWS:
                    yield out()
                    rows, found, masks = [], [], []
            if rows:
                yield out()

    return step


def mentioned(rows: DataFrame, columns: Sequence[Column], aliases: DataFrame, keep: Sequence[str], block: int = BLOCK) -> DataFrame:
    """The kept columns, subject and columns for every row and every subject (aliases: subject, name) that it mentions.

    columns tells where, as bits in the order of the given columns. Null texts mention nothing; subjects without a
    name that says something are mentioned nowhere; equal rows each count.
    """
    spark = rows.sparkSession
    named = phrases(aliases)
    size = named.agg(F.sum(F.length("phrase"))).first()[0] or 0
    blocks = -(-size // block)
    texts = F.array(*[F.coalesce(folded(c), F.lit("")) for c in columns])
    source = rows.select(*keep, texts.alias("__texts"))
    subject = aliases.schema["subject"].dataType
    schema = T.StructType([*[source.schema[c] for c in keep], T.StructField("subject", subject), T.StructField("columns", T.IntegerType())])
    out = None
    for k in range(blocks):
        part = named.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k).orderBy("phrase", "subject").toArrow()  # at most about `block` characters
        ids = part.column("subject").combine_chunks().dictionary_encode()
        value = (f"{id(part)}-{k}-{part.num_rows}-{hash(tuple(part.column('phrase').slice(0, 100).to_pylist()))}", part.column("phrase").to_pylist(), ids.indices.to_pylist(), ids.dictionary)
        found = source.mapInArrow(_finding(spark.sparkContext.broadcast(value), list(keep)), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], schema)
    if blocks == 1:
        return out
    return out.groupBy(*keep, "subject").agg(F.bit_or("columns").alias("columns"))  # a subject's phrases may lie in several blocks
