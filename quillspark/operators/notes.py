"""Notes: reading their heads, merging without losing anything, and the views over them."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators.classify import by_citations
from quillspark.schemas import FRONTMATTER

#: Which extraction is better than which.
QUALITY = {"pdftotext": 2, "web": 2, "ocr": 1}
GENERATED = "> generated note"


def _yaml_as_json(heads: pd.Series) -> pd.DataFrame:
    import datetime as dt
    import json

    import yaml

    def one(head: str | None) -> tuple[str | None, str | None]:
        if head is None:
            return None, None
        try:
            value = yaml.safe_load(head) or {}
            if not isinstance(value, dict):
                return None, "not a mapping"
            return json.dumps(value, default=lambda d: d.isoformat() if isinstance(d, dt.date) else str(d)), None
        except yaml.YAMLError as e:
            return None, (str(e).splitlines() or [type(e).__name__])[0][:80]

    return pd.DataFrame([one(h) for h in heads], columns=["json", "error"])


def parse_heads(notes: DataFrame) -> DataFrame:
    """notes (text, ...) with fm, fm_status, body and tags. The only step here that leaves the JVM: YAML has no built-in reader.

    fm_status: none, ok, "unclosed", or "invalid: ..." for a head that can't be read.
    """
    from pyspark.sql import types as T

    udf = F.pandas_udf(_yaml_as_json, T.StructType([T.StructField("json", T.StringType()), T.StructField("error", T.StringType())]))
    head, body, state = X.frontmatter_parts(F.col("text"))
    out = notes.withColumn("__y", udf(head)).withColumn("body", body)
    status = F.when(state == "none", "none").when(state == "open", "unclosed").when(F.col("__y.error").isNotNull(), F.concat(F.lit("invalid: "), F.col("__y.error"))).otherwise("ok")
    out = out.withColumn("fm_status", status).withColumn("fm", F.from_json("__y.json", FRONTMATTER))
    return out.withColumn("tags", F.coalesce("fm.tags", F.array().cast("array<string>"))).drop("__y")


def note_kind(path: Column) -> Column:
    """By place: paper, star, concept, query, matrix, else other."""
    out = None
    for folder, kind in (("papers", "paper"), ("stars", "star"), ("concepts", "concept"), ("queries", "query"), ("matrices", "matrix")):
        out = F.when(X.in_dir(path, folder), kind) if out is None else out.when(X.in_dir(path, folder), kind)
    return out.otherwise("other")


def note_state(records: DataFrame, notes: DataFrame) -> DataFrame:
    """records with note_state: none, stub or extracted (the note lists methods)."""
    marks = notes.select(F.col("stem").alias("bibcode"), F.size(F.coalesce("fm.methods", F.array().cast("array<string>"))).alias("n"))
    state = F.when(F.col("n").isNull(), "none").when(F.col("n") > 0, "extracted").otherwise("stub")
    return records.join(marks, "bibcode", "left").withColumn("note_state", state).drop("n")


def missing_notes(rows: DataFrame, notes: DataFrame, key: str = "stem") -> DataFrame:
    """Rows that have no note yet; an existing note is never written again."""
    return rows.join(notes.select(key), key, "left_anti")


def merge_list(held: Column, new: Column) -> Column:
    """held with the new values that it lacks, at its end; a null list stays null."""
    return F.when(held.isNotNull(), F.concat(held, F.array_except(new, held)))


def quality(provenance: Column) -> Column:
    out = None
    for name, rank in QUALITY.items():
        out = F.when(provenance == name, rank) if out is None else out.when(provenance == name, rank)
    return out.otherwise(0)


def text_provenance(text: Column) -> Column:
    """By the first line that the extractor writes."""
    return F.when(F.startswith(text, F.lit("[ocr")), "ocr").when(F.startswith(text, F.lit("[web")), "web").otherwise("pdftotext")


def arbitrated(rows: DataFrame) -> DataFrame:
    """rows (current, current_provenance, current_exists, candidate, candidate_provenance) with pointer and replaced.

    A candidate replaces a valid pointer only if it is strictly better, and a dangling one always.
    """
    has = F.col("candidate").isNotNull()
    dangling = F.col("current").isNull() | ~F.coalesce("current_exists", F.lit(False))
    better = quality(F.col("candidate_provenance")) > quality(F.col("current_provenance"))
    replaced = has & (dangling | better)
    return rows.withColumn("replaced", replaced).withColumn("pointer", F.when(replaced, F.col("candidate")).otherwise(F.col("current")))


def best_text(candidates: DataFrame) -> DataFrame:
    """One text for each stem among several subjects': the best extraction, then the first path."""
    rank = F.struct((-quality(F.col("provenance"))).alias("q"), "path")
    return candidates.groupBy("stem").agg(F.min_by(F.struct("path", "provenance"), rank).alias("b")).select("stem", "b.path", "b.provenance")


def document_source(snapshot: Column, text: Column, recorded: Column) -> Column:
    """web, eprint (with its version), what the fetcher recorded, or null: never a guess."""
    stamp = X.eprint_stamp(text)
    return F.when(F.coalesce(snapshot, F.lit(False)), "web").when(stamp.isNotNull(), F.concat(F.lit("eprint"), stamp)).otherwise(recorded)


def unpended(pending: Column, has_pdf: Column, has_text: Column) -> Column:
    return F.when(~(F.coalesce(has_pdf, F.lit(False)) | F.coalesce(has_text, F.lit(False))), pending)


def accessed(explicit: Column, snapshot: Column, pending: Column) -> Column:
    """The date of a web source: given, of the snapshot, or today's in UTC; none while pending."""
    return F.when(~F.coalesce(pending, F.lit(False)), F.coalesce(explicit, snapshot, F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))))


def authors_line(authors: Column, most: int = 6) -> Column:
    line = F.array_join(F.slice(authors, 1, most), ", ")
    return F.when(F.size(authors) > most, F.concat(line, F.lit(" et al."))).otherwise(line)


# Text edits: each gives the new text; what is equal to the old one is not written.


def header_line(text: Column) -> Column:
    """The line before the first section that starts with a dot mark and holds code marks."""
    _, body, _ = X.frontmatter_parts(text)
    before = F.split(body, r"(?m)^## ", 2)[0]
    return F.get(F.filter(F.split(before, "\n"), lambda s: F.startswith(s, F.lit("· ")) & F.contains(s, F.lit("`"))), F.lit(0))


def stamp_link(text: Column, link: Column) -> Column:
    """The header line with its document link removed, and set again if there is a document."""
    line = header_line(text)
    bare = F.regexp_replace(line, r" · \[pdf\]\([^)]*\)", "")
    new = F.when(link.isNull(), bare).otherwise(F.concat(bare, F.lit(" · [pdf]("), link, F.lit(")")))
    return F.when(line.isNull(), text).otherwise(F.replace(text, line, new))


def replace_section(text: Column, heading: str, body: Column) -> Column:
    """The text with a `## ` section replaced, appended where there is none, or removed for a null body."""
    pattern = rf"(?s)\n## {heading}\n.*?(?=\n## |\z)"
    section = F.concat(F.lit(f"\n## {heading}\n"), body)
    has = F.regexp_like(text, F.lit(pattern))
    safe = F.regexp_replace(section, r"([\\$])", r"\\$1")
    return F.when(has & body.isNull(), F.regexp_replace(text, pattern, "")).when(has, F.regexp_replace(text, F.lit(pattern), safe)).when(body.isNull(), text).otherwise(F.concat(F.regexp_replace(text, r"\n+\z", "\n"), section))


def insert_before(text: Column, anchor: str, line: Column) -> Column:
    """The text with a line before the first line that starts with the anchor; without one, as it is."""
    place = F.locate(f"\n{anchor}", text)
    return F.when(place > 0, F.concat(F.left(text, place), line, F.lit("\n"), F.substring(text, place + 1, F.length(text)))).otherwise(text)


def insert_header(text: Column, line: str, anchor: str = GENERATED) -> Column:
    """The text with a line after its first title, unless it has the anchor already."""
    safe = line.replace("\\", "\\\\").replace("$", "\\$")
    return F.when(F.contains(text, F.lit(anchor)), text).otherwise(F.regexp_replace(text, r"(?s)\A(.*?)(^|\n)(# [^\n]*\n)", f"$1$2$3{safe}\n"))


def changed(notes: DataFrame, new: Column) -> DataFrame:
    """Only the notes that a sweep changes, with their new text."""
    return notes.withColumn("new_text", new).where("new_text <> text")


def search_line(found: Column, core: Column, dropped: Column, truncated: Column) -> Column:
    """What a subject's search found, in one line."""
    parts = [F.concat(found.cast("string"), F.lit(" found")), F.concat(core.cast("string"), F.lit(" core")), F.when(dropped > 0, F.concat(dropped.cast("string"), F.lit(" discarded"))), F.when(truncated, "truncated")]
    return F.concat_ws(" · ", *parts)


def repoint(text: Column, pattern: str, line: str) -> Column:
    """The text with the one line that matches replaced; with none or several, as it is."""
    lines = F.split(text, "\n")
    hits = F.size(F.filter(lines, lambda s: F.regexp_like(s, F.lit(pattern))))
    new = F.array_join(F.transform(lines, lambda s: F.when(F.regexp_like(s, F.lit(pattern)), F.lit(line)).otherwise(s)), "\n")
    return F.when(hits == 1, new).otherwise(text)


def quoted(text: Column) -> Column:
    """Percent-encoded, with spaces as %20."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


# Views.


def planets_of(notes: DataFrame, stem: str) -> DataFrame:
    return notes.where(F.col("stem") == stem).select("stem", F.explode("fm.planets").alias("p")).select("stem", "p.letter", "p.P_days", "p.K_ms", "p.mass_earth").orderBy("letter")


def records_of(notes: DataFrame, star: str) -> DataFrame:
    return notes.where(F.array_contains("fm.stars", star)).select("stem", "fm.title", "fm.year", F.col("fm.citations").alias("citations")).orderBy(by_citations("citations"), "stem")


def members(notes: DataFrame, star: str) -> DataFrame:
    """The methods of a star's records, one row for each record and method."""
    held = notes.where(F.array_contains("fm.stars", star) & (F.size("fm.methods") > 0))
    return held.select("stem", F.explode("fm.methods").alias("method")).orderBy("method", "stem")


def records_on(notes: DataFrame, concept: str, is_method: bool = False) -> DataFrame:
    test = F.coalesce(F.array_contains("fm.thesis_links", concept), F.lit(False))
    if is_method:
        test = test | F.coalesce(F.array_contains("fm.methods", concept), F.lit(False))
    return notes.where(test).select("stem", "fm.title", "fm.year").orderBy("year", "stem")


def star_index(notes: DataFrame) -> DataFrame:
    return notes.where(F.array_contains("tags", "star")).select("stem", F.size("fm.planets").alias("n_planets")).orderBy("stem")


def concept_index(notes: DataFrame) -> DataFrame:
    return notes.where(F.array_contains("tags", "concept")).select(F.element_at(F.split("path", "/"), -2).alias("folder"), "stem").orderBy("folder", "stem")


def record_index(notes: DataFrame, n: int = 50) -> DataFrame:
    return notes.where(F.array_contains("tags", "paper")).select("stem", "fm.title", F.col("fm.citations").alias("citations")).orderBy(by_citations("citations"), "stem").limit(n)


def matrix(rows: DataFrame, method: str, subject: str, subjects: Sequence[str], value: str) -> DataFrame:
    """One row a method, one column a subject, with the values that fall there; an empty cell is a gap."""
    joined = F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), ", ")
    return rows.groupBy(method).pivot(subject, list(subjects)).agg(joined).orderBy(method)
