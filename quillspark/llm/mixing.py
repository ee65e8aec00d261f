"""Mixing sources to target weights along a time-varying curriculum, with DataFrame operations only.

Each source has a weight and a schedule: its share of the demand at training time t in [0, 1] grows or falls
linearly. Targets share a budget by weight, and none exceeds a number of passes over its source; what a
capped source can't use goes to the others by weight. The integral of a source's schedule is its cumulative
token demand; documents stand in a fixed pseudo-random order in their source, each covers an interval of the
source's words, and inverting the cumulative demand at the interval's middle gives its training position.
Ranges of positions then order the documents globally.

The running sum of words is taken in two steps, so no source passes through one task: documents fall into
buckets by the head of their id's md5, bucket totals are summed over the buckets of a source, and inside a
bucket a window adds what stands before. Rows of one source, id and size are counted before that and dealt out
again after it, so copies, or rows without an id, don't meet in one bucket either. What is ordered in one task is
the table of sources, one row each.

Defined cases: null texts have size 0; null sources are one source and come last. Sources without words get
target 0. Rows of one source, id and size stand side by side in the order and are counted each; null ids count as
an empty one. Ties of the order's md5 are broken by size and id. Very long texts are counted whole. An empty table
gives no rows. Only doc_id, text and source are read, whatever else a table holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.shared import staged

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: Share of all words that the mix has, and passes over a source at most.
BUDGET, PASSES = 1.5, 2
#: Slopes of the schedules in order of the names, repeating: from -1 (only early) to 1 (only late).
SLOPES = (-0.5, 0.0, 0.5)
#: Hex digits of the md5 that make a bucket; 3 are 4096 buckets a source.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Words between blanks, tabs, line feeds, vertical tabs, form feeds and carriage returns."""
    n = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++"))
    return F.coalesce(n, F.lit(0)).cast("long")


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, source, size, place in the fixed order and number n of rows of the same; written once, the texts are read once."""
    source = F.col("source").cast("string")
    rows = documents.select("doc_id", source.alias("source"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source_key"), word_count(F.col("text").cast("string")).alias("size"))
    one = rows.groupBy("doc_id", "source", "source_key", "size").agg(F.count(F.lit(1)).alias("n"))
    place = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")).cast("binary"))
    return staged(one.withColumn("place", place), "sizes")


def _cycle(values: Sequence[float], rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(rank, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, passes: int = PASSES, slopes: Sequence[float] = SLOPES) -> DataFrame:
    """One row a source: source_size, target and slope.

    Sorted by what a source can give for each unit of weight, the capped sources are a head of the list, and
    the first one whose share of what is left stays below its cap sets the share for all that follow.
    """
    one = sizes.groupBy("source_key").agg(F.max("source").alias("source"), F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = F.col("source_size") * F.lit(float(passes))
    ranked = one.withColumn("rank", rank).select("source_key", "source_size", _cycle(weights, F.col("rank")).alias("weight"), _cycle(slopes, F.col("rank")).alias("slope"), "rank", cap.alias("cap"))
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, whole = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(budget) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shares = ranked.withColumn("share", left / weight_left)
    level = F.first(F.when(F.col("share") * F.col("weight") < F.col("cap"), F.col("share")), ignorenulls=True).over(whole)
    return shares.withColumn("level", level).select("source_key", "source_size", "slope", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _position(before: Column, size: Column, target: Column, slope: Column) -> Column:
    """The training time at which the source's cumulative demand reaches the middle of these words."""
    y = F.least(F.lit(1.0), (before + size / F.lit(2.0)) / target)
    bent = (slope - 1 + F.sqrt((F.lit(1.0) - slope) * (F.lit(1.0) - slope) + F.lit(4.0) * slope * y)) / (F.lit(2.0) * slope)
    return F.when(slope == 0, y).otherwise(bent)


def mixed(sizes: DataFrame, goals: DataFrame, digits: int = BUCKET_DIGITS, passes: int = PASSES) -> DataFrame:
    """Each row with its source's size and target, the words that the mix takes of it, and an array of the passes' positions.

    A source's words, in order and repeated, are a stream; the mix takes its first `target` words, so every pass
    takes a document whole but the one at the stream's end.
    """
    keyed = sizes.withColumn("bucket", F.substring("place", 1, digits))
    in_source = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("source_key", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("bucket_size"))
    starts = totals.select("source_key", "bucket", F.coalesce(F.sum("bucket_size").over(in_source), F.lit(0)).alias("bucket_start")).join(goals, "source_key")
    inside = Window.partitionBy("source_key", "bucket").orderBy("place", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("inside", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0))).join(starts, ["source_key", "bucket"])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    words = F.floor("target")
    before = F.col("bucket_start") + F.col("inside") + F.col("copy") * F.col("size")
    parts, places = [], []
    for k in range(passes):
        start = before + F.lit(k) * F.col("source_size")
        part = F.greatest(F.lit(0), F.least(F.col("size"), words - start))
        parts.append(part)
        places.append(F.when(part > 0, _position(start, F.col("size"), F.col("target"), F.col("slope"))))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return rows.select("doc_id", "source", "size", "source_size", "target", total.cast("long").alias("taken"), F.array(*places).alias("positions"))


def mix(documents: DataFrame, weights: Sequence[float] = WEIGHTS, budget: float = BUDGET, passes: int = PASSES, slopes: Sequence[float] = SLOPES, digits: int = BUCKET_DIGITS) -> DataFrame:
    """All documents in the order of their first training position; those that the mix does not take come last."""
    sizes = sized(documents)
    out = mixed(sizes, targets(sizes, weights, budget, passes, slopes), digits, passes)
    return out.orderBy(F.element_at("positions", 1).asc_nulls_last(), F.md5(F.col("doc_id").cast("string")))


def schedule(documents: DataFrame, **options) -> DataFrame:
    """One row for each document and pass that the mix takes, in training order: doc_id, pass and position."""
    one = mix(documents, **options).select("doc_id", F.posexplode("positions").alias("pass", "position"))
    return one.where("position is not null").orderBy("position", F.md5(F.col("doc_id").cast("string")))
