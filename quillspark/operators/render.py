"""New notes as text: heads, sections, and stamps into heads that are there already.

A renderer gives rows of stem and text for what has no note yet; what is there is only stamped, key by key. Nothing
here writes: `files.append_new` stores rows whose key is new.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.config import Lens
from quillspark.functions import text as X
from quillspark.operators.audit import RESERVED_AREAS
from quillspark.operators.classify import UNTITLED_REASON
from quillspark.operators.notes import GENERATED, accessed, authors_line, missing_notes
from quillspark.operators.stages import top


def scalar(value: Column) -> Column:
    """A text of a head in single quotes, on one line; null for none."""
    line = F.regexp_replace(value.cast("string"), r"\s*[\r\n]\s*", " ")
    return F.when(value.isNotNull(), F.concat(F.lit("'"), F.replace(line, F.lit("'"), F.lit("''")), F.lit("'"))).otherwise(F.lit("null"))


def listed(values: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.coalesce(values, F.array().cast("array<string>")), scalar), ", "), F.lit("]"))


def head(fields: Mapping[str, Column]) -> Column:
    """A `---` block of one line a field, in order. A field whose line is null is left out."""
    lines = [F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value)) for name, value in fields.items()]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.lit(""))


def stamp(text: Column, fields: Mapping[str, Column]) -> Column:
    """The text with these fields of its head set, each on its line or else at the head's end; all other lines stay.

    A null value leaves its field as it is; a text without a closed head stays as it is.
    """
    _, _, state = X.frontmatter_parts(text)
    parts = F.split(text, "---", 3)
    inner = F.get(parts, F.lit(1))
    for name, value in fields.items():
        line = F.concat(F.lit(f"\n{name}: "), value)
        safe = F.regexp_replace(line, r"([\\$])", r"\\$1")
        has = F.regexp_like(inner, F.lit(rf"\n{name}:"))
        new = F.when(has, F.regexp_replace(inner, F.lit(rf"\n{name}:[^\n]*"), safe)).otherwise(F.concat(F.regexp_replace(inner, r"\n\z", ""), line, F.lit("\n")))
        inner = F.when(value.isNull(), inner).otherwise(new)
    return F.when(state == "closed", F.concat(F.lit("---"), inner, F.lit("---"), F.get(parts, F.lit(2)))).otherwise(text)


def retraction_stamp(text: Column, retracted: Column, retraction: Column) -> Column:
    """What a registry says, in the head: retracted, and the kind and date of the notice."""
    said = lambda c: F.when(retracted, c)
    return stamp(text, {"retracted": said(F.lit("true")), "retraction": said(F.concat(F.lit("{type: "), scalar(retraction["type"]), F.lit(", date: "), scalar(retraction["date"]), F.lit("}")))})


def _column(rows: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in rows.columns else F.lit(None).cast(kind)


def numeral(value: Column) -> Column:
    """A number of a head, in a form that is read back as a number; null and not-a-number as null."""
    text = F.regexp_replace(value.cast("string"), "E(?=[0-9])", "E+")
    return F.when(F.isnan(value.cast("double")) | value.isNull(), "null").otherwise(text)


def mapping(fields: Mapping[str, Column]) -> Column:
    """{name: value, ...} of values that are written already."""
    return F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f"{name}: "), value) for name, value in fields.items()]), F.lit("}"))


#: What a planet's record in a head says.
PLANET = ("P_days", "K_ms", "e", "mass_earth")


def excluded_sections(excluded: DataFrame, most: int = 10) -> DataFrame:
    """slug and section: a table of its most cited records (slug, bibcode, ordinal, title, citation_count, why_excluded) that aren't core."""
    best = top(excluded, ["slug"], most)
    line = F.concat(F.lit("| "), X.table_cell(F.coalesce("title", F.lit(""))), F.lit(" | `"), F.col("bibcode"), F.lit("` | "), F.coalesce("citation_count", F.lit(0)).cast("string"), F.lit(" | "), X.table_cell(F.coalesce("why_excluded", F.lit(UNTITLED_REASON))), F.lit(" |"))
    row = F.struct((-F.coalesce("citation_count", F.lit(0))).alias("c"), "ordinal", "bibcode", line.alias("line"), "num_found")
    held = best.groupBy("slug").agg(F.array_sort(F.collect_list(row)).alias("r"))
    note = F.concat(F.get("r", F.lit(0))["num_found"].cast("string"), F.lit(" records that aren't core; the most cited:"))
    text = F.concat_ws("\n", note, F.lit(""), F.lit("| title | record | citations | reason |"), F.lit("|---|---|---|---|"), F.array_join(F.transform("r", lambda x: x["line"]), "\n"), F.lit(""))
    return held.select("slug", text.alias("section"))


def entity_notes(hosts: DataFrame, planets: DataFrame, notes: DataFrame, force: bool = False, excluded: DataFrame | None = None) -> DataFrame:
    """stem and text of a note for each host that has none, with its planets by period.

    hosts: slug and name, and what there is of aliases, simbad_id, spectral_type, teff_K, dist_pc, st_rotp_days and
    data_local. planets: as the ground truth gives them (slug, letter, P_days, K_ms, e, mass, status); each becomes a
    record of the head, so a note that is read again has as many. excluded: see excluded_sections; left out if null.
    """
    measures = [_column(planets, {"mass_earth": "mass"}.get(name, name), "double").alias(name) for name in PLANET]
    row = F.struct(F.col("P_days").isNull().alias("last"), *measures, F.col("letter").cast("string").alias("letter"), _column(planets, "status", "string").alias("status"))
    held = planets.select("slug", row.alias("p")).groupBy("slug").agg(F.array_sort(F.collect_list("p")).alias("p"))
    rows = hosts.withColumn("stem", F.col("slug"))
    rows = rows if force else missing_notes(rows, notes)
    rows = rows.join(held, "slug", "left").withColumn("p", F.coalesce("p", F.array().cast(held.schema["p"].dataType)))
    if excluded is not None:
        rows = rows.join(excluded_sections(excluded).withColumnRenamed("section", "__excluded"), "slug", "left")
    of = lambda name, kind="string": _column(rows, name, kind)
    records = F.transform("p", lambda p: mapping({"letter": scalar(p["letter"])} | {name: numeral(p[name]) for name in PLANET} | {"status": scalar(p["status"])}))
    fields = {
        "title": scalar(F.col("name")), "name": scalar(F.col("name")), "slug": scalar(F.col("slug")), "aliases": listed(of("aliases", "array<string>")), "simbad_id": scalar(of("simbad_id")),
        "tags": F.lit("[star]"), "spectral_type": scalar(of("spectral_type")), "teff_K": numeral(of("teff_K", "double")), "dist_pc": numeral(of("dist_pc", "double")),
        "P_rot_days": numeral(of("st_rotp_days", "double")), "activity_indicators_expected": F.lit("[]"), "planets": F.concat(F.lit("["), F.array_join(records, ", "), F.lit("]")),
        "data_local": scalar(of("data_local")), "methods_applied": F.lit("{literature: [], ours: []}"), "confidence": F.lit("medium"),
    }
    cell = lambda c: F.coalesce(F.round(c, 3).cast("string"), F.lit(""))
    line = lambda p: F.concat(F.lit("| "), F.concat_ws(" | ", F.coalesce(p["letter"], F.lit("")), *[cell(p[name]) for name in PLANET], F.coalesce(p["status"], F.lit(""))), F.lit(" |"))
    table = F.concat_ws("\n", F.lit("| letter | P (d) | K (m/s) | e | mass (Earths) | status |"), F.lit("|---|---|---|---|---|---|"), F.array_join(F.transform("p", line), "\n"))
    section = lambda title, *lines: F.concat_ws("\n", F.lit(f"## {title}"), *lines, F.lit(""))
    view = lambda name: F.concat(F.lit(f"```view\n{name}: "), F.col("slug"), F.lit("\n```"))
    body = F.concat_ws(
        "\n", F.concat(F.lit("# "), F.col("name")), F.lit(GENERATED), F.lit(""), section("Summary"), section("Gaps"), section("Planets", F.when(F.size("p") > 0, table).otherwise(F.lit("none known"))),
        section("Records", view("records_of")), section("Methods", view("members")), section("Data", F.coalesce(of("data_local"), F.lit("none"))), *([F.concat(F.lit("## Excluded records\n"), F.col("__excluded"))] if excluded is not None else []),
    )
    return rows.select("stem", F.concat(head(fields), body).alias("text"))


def concept_notes(concepts: DataFrame, notes: DataFrame, lens: Lens, force: bool = False) -> DataFrame:
    """stem, text and unknown_area of a note for each concept (slug, name, area, status) that has none.

    An area that the lens doesn't declare is marked, and the note is made all the same; only hypotheses have a status.
    """
    rows = concepts.withColumn("stem", F.col("slug"))
    rows = rows if force else missing_notes(rows, notes)
    known = F.col("area").isin(*lens.concept_areas, *RESERVED_AREAS) if lens.concept_areas else F.lit(True)
    of = lambda name, kind="string": _column(rows, name, kind)
    fields = {"title": scalar(F.col("name")), "name": scalar(F.col("name")), "aliases": listed(of("aliases", "array<string>")), "tags": F.lit("[concept]"), "area": scalar(F.col("area")), "status": F.when(F.col("area") == "hypotheses", scalar(F.coalesce("status", F.lit("open")))), "confidence": F.lit("medium")}
    pages = F.concat(F.lit("```view\nrecords_on: "), F.col("slug"), F.when(F.col("area") == "methods", F.lit(", and by method")).otherwise(F.lit("")), F.lit("\n```"))
    body = F.concat_ws("\n", F.concat(F.lit("# "), F.col("name")), F.lit(GENERATED), F.lit(""), F.lit("## Synthesis\n"), F.lit("## Gaps\n"), F.lit("## Records"), pages, F.lit(""))
    return rows.select("stem", F.concat(head(fields), body).alias("text"), (~F.coalesce(known, F.lit(False))).alias("unknown_area"))


def _record(fields: Mapping[str, Column], tags: str) -> Column:
    body = F.concat_ws("\n", F.concat(F.lit("# "), F.col("title")), F.concat(F.lit("· `"), F.col("bibcode"), F.lit("` · "), authors_line(F.col("authors"))), F.lit(""), F.lit("## Search"), F.lit(""))
    return F.concat(head({"title": scalar(F.col("title")), "tags": F.lit(tags), "year": scalar(F.col("year")), "doi": F.when(F.col("doi").isNotNull(), scalar(F.col("doi")))} | dict(fields)), body)


def record_notes(records: DataFrame, notes: DataFrame, everything: bool = False) -> DataFrame:
    """stem and text of a note for each record (bibcode, title, authors, year, doi, citation_count, relevant) that has none; core only, unless all are asked for."""
    rows = (records if everything else records.where("relevant")).withColumn("stem", X.safe_name(F.col("bibcode")))
    fields = {"citations": F.coalesce(F.col("citation_count"), F.lit(0)).cast("string"), "methods": F.lit("[]")}
    return missing_notes(rows, notes).select("stem", _record(fields, "[paper]").alias("text"))


def source_notes(sources: DataFrame, notes: DataFrame) -> DataFrame:
    """stem and text of a note for each declared source outside the catalogue (bibcode, title, authors, year, doi, url, pdf, pending, explicit, snapshot) that has none.

    A source on the web says when it was read, unless it is pending.
    """
    rows = sources.withColumn("stem", X.safe_name(F.col("bibcode")))
    web = F.col("url").isNotNull()
    date = F.when(web, accessed(F.col("explicit"), F.col("snapshot"), F.col("pending").isNotNull()).cast("string"))
    fields = {"source_url": F.when(web, scalar(F.col("url"))), "pdf": F.when(F.col("pdf").isNotNull(), scalar(F.col("pdf"))), "accessed": F.when(date.isNotNull(), scalar(date)), "pending_source": F.when(F.col("pending").isNotNull(), scalar(F.col("pending")))}
    return missing_notes(rows, notes).select("stem", F.when(web, _record(fields, "[paper, web]")).otherwise(_record(fields, "[paper, local-pdf]")).alias("text"))
