"""A table that holds each key once and grows batch by batch, as a stream's sink.

Rows lie in folders by batch and bucket (a hash of the key). A manifest says for every such file how many keys it has,
the least and the greatest of their hashes and a Bloom filter of them; a new batch reads the keys of those files only
that may hold one of its own. A batch counts once its manifest is complete, so one that failed is written anew, and one
that a stream repeats after a restart is known by its name and adds nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.store import exists

BUCKETS = 64
#: Bits of a filter for each key, about, and how many of them a key sets.
BITS, SETS = 12, 4
_ENTRY = "bucket int, n long, least long, greatest long, bloom binary"


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """For each hash the bits that it sets."""
    u = h.astype(np.uint64)
    step = (u >> np.uint64(32)) | np.uint64(1)
    return ((u[:, None] + step[:, None] * np.arange(SETS, dtype=np.uint64)[None, :]) % np.uint64(bits)).astype(np.int64)


def bloom_of(h: np.ndarray) -> bytes:
    bits = max(64, 1 << int(len(h) * BITS).bit_length())
    out = np.zeros(bits, np.uint8)
    out[_places(h, bits).reshape(-1)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def may_hold(bloom: bytes, h: np.ndarray) -> np.ndarray:
    """False where a hash is surely not in the filter."""
    raw = np.frombuffer(bloom, np.uint8)
    p = _places(h, len(raw) * 8)
    return ((raw[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(1)


def _entry(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    h = rows["h"].to_numpy()
    return pd.DataFrame([(int(key[0]), len(h), int(h.min()), int(h.max()), bloom_of(h))], columns=["bucket", "n", "least", "greatest", "bloom"])


def _wanted(rows: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
    """The batches of one bucket that may hold one of the hashes."""
    h = rows["h"].to_numpy()
    found = []
    for batch, least, greatest, bloom in zip(files["batch"], files["least"], files["greatest"], files["bloom"], strict=True):
        inside = h[(h >= least) & (h <= greatest)]
        if len(inside) and may_hold(bloom, inside).any():
            found.append((batch, int(files["bucket"].iloc[0])))
    return pd.DataFrame(found, columns=["batch", "bucket"])


class KeyedStore:
    """Rows by key at a path. `append` adds the rows whose key is new; what is stored is never written again."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def batches(self) -> list[str]:
        """Names of the batches that count."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        files = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(p):
            return []
        names = [s.getPath().getName() for s in files.listStatus(p)]
        return sorted(n.removeprefix("__batch=") for n in names if exists(self.spark, f"{self.path}/manifest/{n}/_SUCCESS"))

    def manifest(self) -> DataFrame | None:
        """batch, bucket, n, least, greatest and bloom of every file that counts."""
        held = self.batches()
        if not held:
            return None
        rows = self.spark.read.schema(_ENTRY + ", __batch string").option("basePath", f"{self.path}/manifest").parquet(*[f"{self.path}/manifest/__batch={b}" for b in held])
        return rows.withColumnRenamed("__batch", "batch")

    def rows(self) -> DataFrame | None:
        """All stored rows, or None before the first batch with rows."""
        held = self.manifest()
        if held is None or held.isEmpty():
            return None
        full = [f"{self.path}/data/__batch={r.batch}" for r in held.select("batch").distinct().collect()]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*full).drop("__batch", "__bucket", "__hash")

    def _files_for(self, rows: DataFrame) -> list[str]:
        """Folders whose keys have to be read before these rows (bucket, h) can be added."""
        held = self.manifest()
        if held is None:
            return []
        pairs = rows.select("bucket", "h").groupBy("bucket").cogroup(held.groupBy("bucket")).applyInPandas(_wanted, "batch string, bucket int")
        return [f"{self.path}/data/__batch={r.batch}/__bucket={r.bucket}" for r in pairs.collect()]  # no more than there are files

    def append(self, rows: DataFrame, batch: str) -> int:
        """Add the rows whose key isn't stored; returns how many the batch has added, also when it is repeated.

        Of several rows of a key in one batch the least in the order of the columns is taken. Rows without a key are
        left out.
        """
        if not re.fullmatch(r"[A-Za-z0-9._-]+", batch):
            raise ValueError(f"a batch's name has letters, digits, dots, dashes and underscores only: {batch!r}")
        if batch in self.batches():
            return self._added(batch)
        others = [c for c in rows.columns if c != self.key]
        one = rows.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.min(F.struct(*others) if others else F.lit(0)).alias("__r")).select(self.key, *([f"__r.{c}" for c in others]))
        one = one.withColumn("__hash", F.xxhash64(self.key)).withColumn("__bucket", F.pmod("__hash", F.lit(self.buckets)).cast("int"))
        files = self._files_for(one.select(F.col("__bucket").alias("bucket"), F.col("__hash").alias("h")))
        if files:
            held = self.spark.read.option("basePath", f"{self.path}/data").parquet(*files).select(self.key)
            one = one.join(held, self.key, "left_anti")
        data = f"{self.path}/data/__batch={batch}"
        one.repartition("__bucket").sortWithinPartitions("__bucket", "__hash").write.mode("overwrite").partitionBy("__bucket").parquet(data)
        written = self.spark.read.schema("__hash long, __bucket int").parquet(data).select(F.col("__hash").alias("h"), F.col("__bucket").alias("bucket"))
        written.groupBy("bucket").applyInPandas(_entry, _ENTRY).write.mode("overwrite").parquet(f"{self.path}/manifest/__batch={batch}")
        return self._added(batch)

    def _added(self, batch: str) -> int:
        return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/manifest/__batch={batch}").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def sink(self, name: str, added: list[int] | None = None):
        """A function for foreachBatch; name is the stream's, so that its batches are known again."""

        def put(rows: DataFrame, number: int) -> None:
            n = self.append(rows, f"{name}-{number}")
            if added is not None:
                added.append(n)

        return put

    def ingest(self, stream: DataFrame, name: str, state: str) -> int:
        """Add all that has arrived at a stream since the last call; returns the number of rows added."""
        added: list[int] = []
        query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", state).foreachBatch(self.sink(name, added)).start()
        query.awaitTermination()
        return sum(added)

