"""Retractions and corrections from a registry's notices, with the title as the last resort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X

#: Notices that take a record back, and notices that only correct it.
RETRACTING = ("retraction", "partial-retraction", "removal", "withdrawal")
SOFT = ("erratum", "corrigendum", "expression-of-concern")


def notices(updates: DataFrame) -> DataFrame:
    """doi, retraction (the first that takes the record back) and corrections (all others that count, in order)."""
    kind = F.lower(F.coalesce("type", F.lit("")))
    row = F.struct("pos", kind.alias("type"), "notice_doi", X.date_parts(F.col("date_parts")).alias("date"), "source")
    held = updates.where(kind.isin(*RETRACTING, *SOFT)).groupBy("doi").agg(F.array_sort(F.collect_list(row)).alias("n"))
    plain = lambda s: F.struct(s["type"].alias("type"), s["notice_doi"].alias("notice_doi"), s["date"].alias("date"), s["source"].alias("source"))
    pick = lambda kinds: F.transform(F.filter("n", lambda s: s["type"].isin(*kinds)), plain)
    return held.select("doi", F.get(pick(RETRACTING), F.lit(0)).alias("retraction"), pick(SOFT).alias("corrections"))


def correction_types(corrections) -> F.Column:
    """The kinds of corrections in order, each once."""
    return F.array_join(F.array_distinct(F.transform(corrections, lambda c: c["type"])), ", ")


def check(records: DataFrame, updates: DataFrame, force: bool = False) -> DataFrame:
    """records (bibcode, doi, title, retracted) with retraction, corrections and checked.

    A registry notice goes first; a title that says so counts where no notice does. What is already marked is not
    asked about again unless forced, but stays retracted. A missing answer is no claim.
    """
    asked = F.lit(force) | ~F.coalesce("retracted", F.lit(False))
    both = records.join(notices(updates), "doi", "left").withColumn("checked", asked)
    by_title = F.when(X.title_says_retracted(F.col("title")), F.struct(F.lit("retraction").alias("type"), F.lit(None).cast("string").alias("notice_doi"), F.lit(None).cast("string").alias("date"), F.lit("title").alias("source")))
    found = F.when(asked, F.coalesce("retraction", by_title))
    out = both.withColumn("retraction", found)
    return out.withColumn("retracted", F.coalesce("retracted", F.lit(False)) | F.col("retraction").isNotNull())


def gate(checked: DataFrame) -> int:
    """Exit code: 1 if anything is retracted."""
    return int(not checked.where("retracted").isEmpty())


def subject_keys(records: DataFrame, declared: DataFrame, curated: DataFrame, notes: DataFrame) -> DataFrame:
    """bibcode of the existing notes that a subject's records, declared sources or curated keys name, each once."""
    keys = records.where("relevant").select("bibcode").unionByName(declared.select("bibcode")).unionByName(curated.select("bibcode")).distinct()
    return keys.join(notes.select("bibcode"), "bibcode", "left_semi")
