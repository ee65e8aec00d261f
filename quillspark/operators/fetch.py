"""What to fetch and which extraction to keep; the transfers themselves are edges of the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X

#: Document kinds of the resolver by preference, and what each delivers.
KINDS = ("EPRINT_PDF", "ADS_PDF", "PUB_PDF")
DELIVERS = {"EPRINT_PDF": "eprint", "ADS_PDF": "ads", "PUB_PDF": "publisher"}
PDF_MAGIC = b"%PDF"


def candidate_urls(resolved: DataFrame) -> DataFrame:
    """bibcode, rank, kind and url: usable links, the first of each kind, by preference. resolved: bibcode, links, link.

    A lone link counts as a list of one; placeholders are dropped; a bare DOI becomes a URL.
    """
    lone = F.array(F.struct(F.col("link").alias("url"), F.lit("PUB_PDF").alias("link_type")))
    listed = F.when(F.size(F.coalesce("links", F.array().cast("array<struct<url:string,link_type:string>>"))) > 0, F.col("links")).when(F.col("link").isNotNull(), lone)
    rows = resolved.select("bibcode", F.posexplode(listed).alias("pos", "l"))
    url = X.strip(F.coalesce("l.url", F.lit("")))
    rows = rows.select("bibcode", "pos", F.element_at(F.split("l.link_type", r"\|"), -1).alias("kind"), url.alias("url"))
    rows = rows.where((F.col("url") != "") & ~F.contains("url", F.lit("$")) & F.col("kind").isin(*KINDS))
    full = F.when(F.startswith("url", F.lit("http")), F.col("url")).otherwise(F.concat(F.lit("https://doi.org/"), F.col("url")))
    first = rows.groupBy("bibcode", "kind").agg(F.min_by(full, "pos").alias("url"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    return first.select("bibcode", rank.alias("rank"), "kind", "url").orderBy("bibcode", "rank")


def missing_documents(records: DataFrame, disk: DataFrame, everything: bool = False, limit: int = 0) -> DataFrame:
    """Core records (all with `everything`) whose document isn't on disk, with a hint where to look. disk: stem."""
    wanted = records if everything else records.where("relevant")
    out = wanted.withColumn("stem", X.safe_name(F.col("bibcode"))).join(disk.select("stem"), "stem", "left_anti")
    out = out.withColumn("hint", X.rescue_hint(F.col("bibstem"), F.col("year"))).orderBy("ordinal")
    return out.limit(limit) if limit else out


def residue(without_id: DataFrame, failed: DataFrame) -> DataFrame:
    """What is left after a fetch; an empty result clears the stored one."""
    return without_id.select("bibcode", F.lit("no eprint").alias("reason")).unionByName(failed.select("bibcode", F.lit("failed").alias("reason")))


def latest_source(records: DataFrame) -> DataFrame:
    """The last recorded source of each document. records: slug, stem, source, ordinal."""
    return records.groupBy("slug", "stem").agg(F.max_by("source", "ordinal").alias("source"))


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 4) == F.lit(PDF_MAGIC)


def text_choice(rows: DataFrame, can_ocr: bool, force: bool = False) -> DataFrame:
    """rows (held_text, held_is_ocr, layer_text, ocr_text) with status and text.

    Stored text stays unless it is illegible, not from OCR, and OCR can help. Else the text layer if legible, else
    OCR, else the illegible layer, marked as such; nothing at all is a failure.
    """
    legible = lambda c: X.verdict_of_text(F.coalesce(c, F.lit(""))) == "ok"
    held = F.col("held_text")
    keep = held.isNotNull() & (legible(held) | F.col("held_is_ocr") | F.lit(not can_ocr)) & F.lit(not force)
    status = F.when(keep, "kept").when(legible(F.col("layer_text")), "layer").when(F.lit(can_ocr) & F.col("ocr_text").isNotNull(), "ocr").when(F.col("layer_text").isNotNull(), "illegible").otherwise("failed")
    text = F.when(F.col("status") == "kept", held).when(F.col("status") == "ocr", F.col("ocr_text")).when(F.col("status") != "failed", F.col("layer_text"))
    return rows.withColumn("status", status).withColumn("text", text)


def step_counts(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
