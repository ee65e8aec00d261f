"""Incremental ingest: files that arrive are read once, and only new keys are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.sources.files import append_new


def ingest(spark: SparkSession, source: str, schema: str, table: str, state: str, key: str) -> int:
    """Read all files that arrived since the last call and append the rows whose key the table lacks.

    A batch that runs twice after a failure adds nothing the second time. Returns the number of rows added.
    """
    added = []
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", state).foreachBatch(lambda rows, _: added.append(append_new(rows, table, key))).start()
    query.awaitTermination()
    return sum(added)


def once_within(events: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Events without repeats of a key inside the delay; a time without a zone is read in the session's."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
