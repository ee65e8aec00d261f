"""What a session needs so that Python workers find this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def reachable(spark: SparkSession) -> SparkSession:
    """Put this package's folder on the workers' path, for runs on one machine or from a shared folder.

    On other clusters the package is shipped with --py-files; the entry does no harm there.
    """
    root, env = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    held = env.get("PYTHONPATH", "")
    if root not in held.split(":"):
        env["PYTHONPATH"] = f"{root}:{held}" if held else root
    return spark
