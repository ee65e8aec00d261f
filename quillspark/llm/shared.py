"""Where intermediate tables go, and small helpers that every operator of this subpackage uses."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: log2 of the bits of a Bloom filter at most (16 MB); each key sets two bits.
MOST_BITS = 27
#: A null doc_id counts as the largest id wherever ids are compared.
LAST_ID = (1 << 63) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, else one of our own (local runs and tests only)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has several executors
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = spark.sparkContext.getCheckpointDir()
        if path is None:
            path = tempfile.mkdtemp(prefix="quillspark-")
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write df once into the shared folder, in folders by the given columns, and read it back.

    This cuts lineage and survives the loss of any executor, because no block lives on one machine only.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillspark/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def unstaged(*tables: DataFrame) -> None:
    """Delete what staged() wrote for these tables, once all that reads them has been written itself."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words_of_filter(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter of a table of 64-bit hashes (h), as 64-bit words.

    Spark ors the bits of each word, so that no task and not the driver sees more than the filter itself. Its size
    follows the table and is bounded; a full one lets everything through, so an exact join must follow it.
    """
    bits = min(MOST_BITS, max(16, (16 * hashes.count()).bit_length()))
    mask = F.lit((1 << bits) - 1).cast("long")
    places = hashes.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", 32).bitwiseAND(mask))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def holds(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """False where a hash is surely not in the filter."""
    mask, out = np.uint64(len(words) * 64 - 1), np.ones(len(h), bool)
    for shift in (0, 32):
        place = (h.view(np.uint64) >> np.uint64(shift)) & mask
        out &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def ordered_id(column: str = "doc_id") -> Column:
    """doc_id as a long that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def remainder(column: str, parts: int) -> Column:
    """crc32 of the id written as text, modulo parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most `rows` rows, chosen by their key's md5: the same at each run, whatever the order of reading.

    A threshold on the md5, set from the count, leaves few rows more than asked for, so the final ordering is
    small on every task and on the driver however large df is.
    """
    n = df.count()
    place = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    if n > rows:
        head = min((1 << 32) - 1, int((rows + 4 * rows**0.5 + 16) / n * (1 << 32)))
        df = df.where(F.substring(place, 1, 8) <= F.lit(f"{head:08x}"))
    return df.orderBy(place, F.col(key)).limit(rows)
