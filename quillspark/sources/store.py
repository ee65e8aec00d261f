"""Tables that a job writes for itself, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder, for runs on one machine only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="quillspark-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/quillspark/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def kept(rows: DataFrame, path: str) -> DataFrame:
    """rows as they were written to this path before, or written there now. A write that didn't end counts as none."""
    spark = rows.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def staged(rows: DataFrame, name: str) -> DataFrame:
    """rows written once and read back, so that they aren't computed again and no executor's loss takes them."""
    return kept(rows, new_path(rows.sparkSession, name))
