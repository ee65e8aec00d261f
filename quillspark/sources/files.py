"""Scans of landed files and sinks that write only what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark import schemas
from quillspark.operators.notes import note_kind


def whole_texts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, dir, stem and text of every matching file below a folder, one row a file."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    at = F.col("_metadata.file_path")
    name = F.element_at(F.split(at, "/"), -1)
    return rows.select(at.alias("path"), F.regexp_replace(at, "/[^/]*$", "").alias("dir"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("value").alias("text"))


def notes(spark: SparkSession, path: str) -> DataFrame:
    """All Markdown notes, with their kind by place."""
    rows = whole_texts(spark, path, "*.md")
    return rows.withColumn("kind", note_kind(F.col("path")))


def full_texts(spark: SparkSession, path: str) -> DataFrame:
    """slug, stem, path and text; of a stem in several folders the first path counts."""
    rows = whole_texts(spark, path, "*.txt")
    first = rows.select("stem", "path").groupBy("stem").agg(F.min("path").alias("path"))
    return rows.join(first, ["stem", "path"], "left_semi").select(F.element_at(F.split("dir", "/"), -1).alias("slug"), "stem", "path", "text")


def runs(spark: SparkSession, path: str) -> DataFrame:
    """Stored runs (one JSON document a file); a file that can't be read is left out."""
    from pyspark.sql import types as T

    record = T.StructType([f for f in T.StructType.fromDDL(schemas.RECORDS) if f.name != "slug"])
    run = T.StructType([T.StructField("slug", T.StringType()), T.StructField("truncated", T.BooleanType()), T.StructField("records", T.ArrayType(record)), T.StructField("_bad", T.StringType())])
    options = {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "recursiveFileLookup": "true", "pathGlobFilter": "*.json"}
    return spark.read.schema(run).options(**options).json(path).where("_bad is null").drop("_bad")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Binary documents by path, with whether they begin as a PDF does."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", "length", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("is_pdf"))


def config(spark: SparkSession, registry: dict, schema: str) -> DataFrame:
    """A configuration mapping as a small dimension, keyed by name."""
    return spark.createDataFrame([(name, *(entry or {}).values()) for name, entry in registry.items()], schema)


def write_run(records: DataFrame, path: str) -> None:
    """Replace the partitions of the slugs in records, and no others."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slug").parquet(path)


def write_search_log(log: DataFrame, path: str) -> None:
    """Replace the logs of the slugs in log; decisions are a table of their own and are never touched by a search."""
    write_run(log, path)


def append_new(rows: DataFrame, path: str, key: str) -> int:
    """Append the rows whose key the stored table lacks; what is stored is never written again. Returns their number."""
    spark = rows.sparkSession
    try:
        held = spark.read.parquet(path).select(key)
        rows = rows.join(held, key, "left_anti")
    except Exception as e:  # the first write finds no table
        if "PATH_NOT_FOUND" not in str(e):
            raise
    rows = rows.dropDuplicates([key]).cache()
    n = rows.count()
    if n:
        rows.write.mode("append").parquet(path)
    rows.unpersist()
    return n


def write_json(row: DataFrame, path: str) -> None:
    """A small result as JSON lines in one file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def markdown(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A bounded result as a Markdown table, for people."""
    held = rows.limit(most).collect()
    lines = [f"## {title} ({len(held)})", "", "| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in held]) + "\n"
