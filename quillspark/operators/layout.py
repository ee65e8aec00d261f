"""Page layout of extracted texts: how many lines cross a gutter, and which texts have columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X


def file_metrics(documents: DataFrame) -> DataFrame:
    """slug, stem, n_useful, n_gutter, n_hyphen, share and multi_column; texts without useful lines are left out.

    Lines are counted inside the row, so nothing is exploded or shuffled.
    """
    useful = F.filter(X.all_lines(F.col("text")), lambda s: F.length(X.strip(s)) >= X.USEFUL_LINE)
    rows = documents.select("slug", "stem", useful.alias("u"))
    rows = rows.select("slug", "stem", F.size("u").cast("long").alias("n_useful"), F.size(F.filter("u", X.has_gutter)).cast("long").alias("n_gutter"), F.size(F.filter("u", X.ends_hyphenated)).cast("long").alias("n_hyphen"))
    rows = rows.where("n_useful > 0").withColumn("share", F.col("n_gutter") / F.col("n_useful"))
    return rows.withColumn("multi_column", F.col("share") > X.MULTI_COLUMN)


def metrics(documents: DataFrame) -> DataFrame:
    """The same summed for each slug, and for all (slug null)."""
    return file_metrics(documents).rollup("slug").agg(F.count(F.lit(1)).alias("n_files"), F.count_if("multi_column").alias("n_multi_column"), F.sum("n_useful").alias("n_useful"), F.sum("n_gutter").alias("n_gutter"), F.sum("n_hyphen").alias("n_hyphen"))


def widest(documents: DataFrame, n: int) -> DataFrame:
    """The n texts with the largest share of gutter lines."""
    return file_metrics(documents).orderBy(F.desc("share"), F.desc("stem")).limit(n)
