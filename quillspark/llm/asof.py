"""As-of join with a tolerance: each row of the left side meets the latest row of the right side at or before it.

Time is cut into buckets as wide as the tolerance, so what a left row may meet lies in its own bucket or in the one
before. Right rows are replicated into their own and the next bucket, and both sides are joined by key and bucket.
So that a hot key stays cheap, rows are reduced before they are replicated and joined:

* Right rows of one key and instant become one row, the first by the tie order, with their number. This is an
  aggregation, which combines before its shuffle.
* A bucket with more than ROWS rows of a key is cut into slices of equal width, 2**bits of them by its number of rows.
  An instant ends where the next one of its slice begins, so the join of a slice gives each left row one instant at
  most, however many the slice has.
* What reaches another slice or the next bucket can only be the last instant of a slice, so only that is replicated.
  The last one before a slice is found in groups of FAN slices and then over these groups: no window holds more than
  FAN slices, or groups, for each bucket of a key.

At last the left rows' copies are numbered in the tie order by row_number, and the first one stays.

Defined cases: a null key or time never matches, nor is it matched; such left rows are spread by their id. A row
without an id on the left is no row to match and gives no result. Copies of one id count once; if they differ, the
one of the smallest time, then of the smallest key, counts (nulls last). Rows of the right side that are equal in all
of the tie order count each for itself in n_tied. Empty tables, on either side, give unmatched rows or none. Columns
are selected by name, so extra ones do no harm.

What a slice can't divide, very many left rows of one key and instant, is left to Spark's splitting of skewed joins;
there the other side of the join has one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.shared import staged, unstaged

HOUR = 3_600_000_000
#: Rows of one key in a bucket, or on average in a slice of it.
ROWS = 128
#: log2 of the slices, and of their groups, that one window orders.
FAN = 15
#: Parts over which the rows of a bucket are dealt when they look up its number of slices.
SALTS = 16


def micros(column: str) -> Column:
    """Microseconds from 1970 to a timestamp without a zone, whatever the session's zone is."""
    c = F.col(column).cast("timestamp_ntz")
    seconds = F.unix_date(c.cast("date")).cast("long") * 86_400 + F.hour(c) * 3_600 + F.minute(c) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def _bucketed(df: DataFrame, tolerance: int) -> DataFrame:
    """df with the bucket of its time t; rows that match nothing get buckets by their id."""
    bucket = F.expr(f"(t - pmod(t, {tolerance})) div {tolerance}")
    return df.withColumn("bucket", F.when(F.col("key").isNull() | F.col("t").isNull(), F.xxhash64("id")).otherwise(bucket) if "id" in df.columns else bucket)


def _sliced(df: DataFrame, sizes: DataFrame, tolerance: int, by: str) -> DataFrame:
    """df with the slice of its bucket that its time is in; buckets that aren't in sizes are one slice."""
    wide = (tolerance - 1).bit_length()
    several = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")  # it grows with the rows: no broadcast
    out = df.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(several, ["key", "bucket", "salt"], "left")
    slice_ = F.when(F.col("bits").isNull(), F.lit(0).cast("long")).otherwise(F.expr(f"shiftright(pmod(t, {tolerance}), {wide} - bits)"))
    return out.withColumn("slice", slice_).drop("salt", "bits")


def _carried(lasts: DataFrame, cells: DataFrame) -> DataFrame:
    """key, bucket, slice and carry: the last instant before each of the cells, in its bucket or at the end of the one before."""
    group = F.shiftright("slice", FAN).alias("group")
    ends = lasts.select("key", "bucket", group, "slice", "last")
    both = ends.withColumn("cell", F.lit(False)).unionByName(cells.select("key", "bucket", group, "slice", F.lit(None).cast(lasts.schema["last"].dataType).alias("last"), F.lit(True).alias("cell")))
    before = Window.partitionBy("key", "bucket", "group").orderBy("slice").rangeBetween(Window.unboundedPreceding, -1)
    inside = both.withColumn("near", F.last("last", ignorenulls=True).over(before)).where("cell").drop("last", "cell")
    groups = ends.groupBy("key", "bucket", "group").agg(F.max("last").alias("last"))
    ahead = ends.groupBy("key", "bucket").agg(F.max("last").alias("last")).select("key", (F.col("bucket") + 1).alias("bucket"), F.lit(-1).cast("long").alias("group"), "last")
    wanted = cells.select("key", "bucket", group).distinct().select("key", "bucket", "group", F.lit(None).cast(lasts.schema["last"].dataType).alias("last"), F.lit(True).alias("cell"))
    outer = groups.unionByName(ahead).withColumn("cell", F.lit(False)).unionByName(wanted)
    earlier = Window.partitionBy("key", "bucket").orderBy("group").rangeBetween(Window.unboundedPreceding, -1)
    outer = outer.withColumn("far", F.last("last", ignorenulls=True).over(earlier)).where("cell").select("key", "bucket", "group", "far")
    return inside.join(outer, ["key", "bucket", "group"], "left").select("key", "bucket", "slice", F.coalesce("near", "far").alias("carry"))


def as_of(left: DataFrame, right: DataFrame, tolerance: int, rows: int = ROWS) -> DataFrame:
    """id, key, t, lag, n_tied and data of every id of left (id, key, t), by right (key, t, tie, data); times are longs.

    tie is what orders right rows of one instant, the smallest first; data is what the result tells of the match.
    lag is at most the tolerance; it and data are null where nothing matches, and n_tied is 0.
    """
    left = _bucketed(left.where("id is not null").select("id", "key", "t"), tolerance)
    instants = right.where("key is not null and t is not null").groupBy("key", "t").agg(F.count(F.lit(1)).alias("n_tied"), F.min(F.struct("tie", "data")).alias("best"))
    instants = staged(_bucketed(instants.select("key", "t", "n_tied", F.col("best.data").alias("data")), tolerance), "instants")
    known = "key is not null and t is not null"
    counted = left.where(known).select("key", "bucket").unionByName(instants.select("key", "bucket")).groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.lit((tolerance - 1).bit_length()), F.ceil(F.log2(F.col("n") / F.lit(rows)))).cast("int")
    sizes = staged(counted.where(F.col("n") > rows).select("key", "bucket", bits.alias("bits")), "slices")
    cell = Window.partitionBy("key", "bucket", "slice").orderBy("t")
    spans = staged(_sliced(instants, sizes, tolerance, "t").withColumn("until", F.lead("t").over(cell)), "instant-spans")
    asked = staged(_sliced(left, sizes, tolerance, "id"), "asked")
    unstaged(instants, sizes)

    lasts = spans.where("until is null").select("key", "bucket", "slice", F.struct("t", "n_tied", "data").alias("last"))
    carry = _carried(lasts, asked.where(known).select("key", "bucket", "slice").distinct())
    own = spans.select("key", "bucket", "slice", F.col("t").alias("since"), "until", F.struct("t", "n_tied", "data").alias("own"))
    met = asked.join(own, (asked.key == own.key) & (asked.bucket == own.bucket) & (asked.slice == own.slice) & (asked.t >= own.since) & (F.col("until").isNull() | (asked.t < F.col("until"))), "left")
    met = met.select(asked["*"], "own").join(carry, ["key", "bucket", "slice"], "left").withColumn("m", F.coalesce("own", "carry"))
    met = met.withColumn("m", F.when(F.col("t") - F.col("m.t") <= tolerance, F.col("m")))
    first = Window.partitionBy("id").orderBy(F.col("t").asc_nulls_last(), F.col("key").asc_nulls_last(), F.col("m.t").desc_nulls_last())
    out = met.withColumn("place", F.row_number().over(first)).where("place = 1")
    return out.select("id", "key", "t", (F.col("t") - F.col("m.t")).alias("lag"), F.coalesce("m.n_tied", F.lit(0).cast("long")).alias("n_tied"), F.col("m.data").alias("data"))


def _coarse(id_: Column, t: Column) -> Column:
    """t, floored to its hour where the id's crc32 is odd."""
    return F.when(_crc(id_) % 2 == 1, t - F.pmod(t, F.lit(HOUR))).otherwise(t)


def _crc(id_: Column) -> Column:
    return F.crc32(id_.cast("string").cast("binary"))


def clicks_to_orders(clicks: DataFrame, sales: DataFrame, hours: int = 240) -> DataFrame:
    """click_id, client_id, ts_us, sale_id, lag_us, total_cents and n_tied of every click_id.

    Each sale is an order. Where the crc32 of its id isn't divisible by 3 there is a second one of the same time, with
    the id -1 - sale_id and the priority 6 - priority. Orders of one time are ranked by priority, then by falling
    sale_id, nulls last; orders alike in both by falling total.
    """
    cents = F.floor(100 * F.col("total") + 0.5).cast("long")
    sold = sales.select("client_id", "sale_id", F.col("priority").cast("long").alias("priority"), cents.alias("cents"), micros("sold_at").alias("us"))
    one, two = F.struct("sale_id", "priority"), F.struct(F.expr("~sale_id").alias("sale_id"), (6 - F.col("priority")).alias("priority"))
    orders = sold.select(F.col("client_id").alias("key"), _coarse(F.col("sale_id"), F.col("us")).alias("t"), "cents", F.explode(F.when(_crc(F.col("sale_id")) % 3 != 0, F.array(one, two)).otherwise(F.array(one))).alias("o"))
    falling = lambda c: (c.isNull(), F.bitwise_not(c))  # noqa: E731  ~x falls as x grows, and no long overflows
    tie = F.struct(F.col("o.priority").isNull(), F.col("o.priority"), *falling(F.col("o.sale_id")), *falling(F.col("cents")))
    right = orders.select("key", "t", tie.alias("tie"), F.struct(F.col("o.sale_id").alias("sale_id"), F.col("cents").alias("cents")).alias("data"))
    seen = clicks.select(F.col("click_id").alias("id"), F.col("client_id").alias("key"), micros("ts").alias("us")).select("id", "key", _coarse(F.col("id"), F.col("us")).alias("t"))
    out = as_of(seen, right, hours * HOUR)
    return out.select(F.col("id").alias("click_id"), F.col("key").alias("client_id"), F.col("t").alias("ts_us"), "data.sale_id", F.col("lag").alias("lag_us"), F.col("data.cents").alias("total_cents"), "n_tied")
