"""Order without a single task: numbers of rows, and what lies before a point, over split key ranges.

Rows are dealt into ranges by Spark's range partitioning and sorted inside them; what a range needs to know of those
before it (how many rows, the last value, a running count) is one small row a range, or a range and key, so that no
task sees all rows of a table or of a hot key. The dealt rows are written once: ranges are drawn from a sample, and a
lost task that drew them anew might number rows differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.sources.store import staged


def ranged(rows: DataFrame, *order: str | Column, parts: int | None = None) -> DataFrame:
    """rows with __range and __place: sorted ranges, numbered in the order, and an ascending place in each."""
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    dealt = dealt.sortWithinPartitions(*order)
    return staged(dealt.withColumn("__range", F.spark_partition_id()).withColumn("__place", F.monotonically_increasing_id()), "ranged")


def numbered(rows: DataFrame, *order: str | Column, name: str = "n", parts: int | None = None) -> DataFrame:
    """rows with a number from 0 in the given order, as row_number() - 1 without a partition would give.

    The order should be total; rows that are equal in it are numbered in any order.
    """
    dealt = ranged(rows, *order, parts=parts)
    sizes = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"), F.min("__place").alias("__first"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select("__range", "__first", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    out = dealt.join(F.broadcast(offsets), "__range")
    return out.withColumn(name, F.col("__place") - F.col("__first") + F.col("__before")).drop("__range", "__place", "__first", "__before")


def before(points: DataFrame, log: DataFrame, key: str, at: str, strict: bool = False, parts: int | None = None) -> DataFrame:
    """points with n_before and n_after (rows of log with that key up to the point, and beyond it) and last (the
    greatest `at` up to the point; null for none).

    A row of log at the point's own time counts as before it, unless strict. Null keys and times in log count nowhere;
    a point without key or time has nothing before or after it.
    """
    of = F.struct(*[F.col(c) for c in points.columns])
    later = 0 if strict else 1
    point = points.select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(later).alias("__kind"), of.alias("__row"))
    entry = log.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(1 - later).alias("__kind"), F.lit(None).cast(point.schema["__row"].dataType).alias("__row"))
    known = "__key is not null and __at is not null"
    dealt = ranged(point.where(known).unionByName(entry), "__key", "__at", "__kind", parts=parts)
    is_log = F.col("__row").isNull()
    here = Window.partitionBy("__range", "__key").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    rows = dealt.withColumn("__n", F.count_if(is_log).over(here)).withColumn("__last", F.max(F.when(is_log, F.col("__at"))).over(here))
    ends = dealt.groupBy("__key", "__range").agg(F.count_if(is_log).alias("n"), F.max(F.when(is_log, F.col("__at"))).alias("last"))
    of_key = Window.partitionBy("__key")  # at most one row a range
    ahead = of_key.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("__key", "__range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("__m"), F.max("last").over(ahead).alias("__carry"), F.sum("n").over(of_key).alias("__all"))
    out = rows.where(~is_log).join(ends, ["__key", "__range"])
    n = F.col("__n") + F.col("__m")
    out = out.select("__row.*", n.alias("n_before"), (F.col("__all") - n).alias("n_after"), F.coalesce("__last", "__carry").alias("last"))
    rest = points.where(F.col(key).isNull() | F.col(at).isNull())
    zero = F.lit(0).cast("long")
    return out.unionByName(rest.select("*", zero.alias("n_before"), zero.alias("n_after"), F.lit(None).cast(out.schema["last"].dataType).alias("last")))
