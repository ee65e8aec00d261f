"""The audit: each category is a DataFrame of findings; together they decide whether work may go on.

Tables: notes as `notes.parse_heads` gives them, with `path` and `kind`; links by `link_rows`. Every category is a
filter, an explode or an equi-join, and all are put together by union, so one notes table serves them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.config import Lens
from quillspark.functions import text as X
from quillspark.operators.ranks import before
from quillspark.operators.truth import msini_earth, outside_band

#: Categories in the order of the report, with their severity.
SEVERITY = {
    "broken_link": "block", "unreadable_head": "block", "retracted": "block", "orphan": "block", "correction": "backlog",
    "planet_count": "block", "inconsistent_mass": "block", "dangling_thesis_link": "block", "dangling_dispute": "block",
    "implementation_leak": "warn", "placeholder_objective": "warn", "undeclared_area": "warn", "editor_folder": "warn", "pdf_drift": "warn",
    "pending_source": "backlog", "illegible_text": "backlog", "unverifiable_citation": "backlog", "never_verified": "backlog",
    "stale_verification": "backlog", "no_citations": "backlog", "no_generated_header": "backlog", "pending_triage": "backlog",
    "truncated_search": "backlog", "incomplete": "backlog",
}
#: Link targets that are examples, and notes for finding one's way.
EXAMPLES = ("..", "...", "link", "links", "wikilinks", "bibcode", "related-concept", "attention-mechanism", "rag")
NAVIGATION = ("index", "log", "README")
#: Words of an implementation that the language of the notes has; a lens may name others.
LEAKS = ((r"(?i)\bperilla\b", "perilla"), (r"(?i)\bdial\b", "dial"), (r"w_\{?j", "w_j"), (r"=\s*peso\(", "peso()"))
PLACEHOLDER = "<"
RESERVED_AREAS = ("methods", "hypotheses")
VERIFICATION = "Citation check"


def found(rows: DataFrame, category: str, key: Column | str, detail: Column) -> DataFrame:
    return rows.select(F.lit(category).alias("category"), F.lit(SEVERITY[category]).alias("severity"), (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"), detail.cast("string").alias("detail"))


def link_rows(notes: DataFrame) -> DataFrame:
    """stem, path, pos and target of every link; design references' own links don't count."""
    return notes.where("kind <> 'ref'").select("stem", "path", "kind", F.posexplode(X.links(F.col("text"))).alias("pos", "target"))


def broken_links(notes: DataFrame, links: DataFrame) -> DataFrame:
    real = links.where(~F.contains("target", F.lit("/")) & ~F.col("target").isin(*EXAMPLES) & (F.col("target") != ""))
    gone = real.join(notes.select(F.col("stem").alias("target")).distinct(), "target", "left_anti")
    return found(gone, "broken_link", "stem", F.col("target"))


def unreadable_heads(notes: DataFrame) -> DataFrame:
    return found(notes.where("fm_status not in ('none', 'ok')"), "unreadable_head", "stem", F.col("fm_status"))


def retracted(notes: DataFrame) -> DataFrame:
    r = F.concat(F.coalesce("fm.retraction.type", F.lit("retraction")), F.lit(" ("), F.coalesce("fm.retraction.date", F.lit("no date")), F.lit(")"))
    return found(notes.where("fm.retracted"), "retracted", "stem", r)


def in_degree(notes: DataFrame, links: DataFrame) -> DataFrame:
    """notes with incoming: occurrences of links to them, their own included."""
    n = links.groupBy(F.col("target").alias("stem")).agg(F.count(F.lit(1)).alias("incoming"))
    return notes.join(n, "stem", "left").withColumn("incoming", F.coalesce("incoming", F.lit(0)))


def orphans(notes: DataFrame, links: DataFrame) -> DataFrame:
    free = F.arrays_overlap("tags", F.array(*map(F.lit, ("paper", "star", "matrix")))) | F.col("stem").isin(*NAVIGATION) | (F.col("kind") == "ref")
    alone = in_degree(notes, links).where((F.col("incoming") == 0) & ~F.coalesce(free, F.lit(False)))
    return found(alone, "orphan", "stem", F.lit("nothing links here"))


def corrections(notes: DataFrame) -> DataFrame:
    rows = notes.select("stem", F.explode("fm.corrections").alias("c"))
    text = F.concat(F.coalesce("c.type", F.lit("correction")), F.lit(" ("), F.coalesce("c.date", F.lit("no date")), F.lit(") "), F.coalesce("c.notice_doi", F.lit("no notice DOI")))
    return found(rows, "correction", "stem", text)


def planet_counts(notes: DataFrame, planets: DataFrame) -> DataFrame:
    truth = planets.groupBy(F.col("slug").alias("stem")).agg(F.count(F.lit(1)).alias("n"))
    held = F.greatest(F.coalesce(F.size("fm.planets"), F.lit(0)), F.lit(0))
    both = notes.join(truth, "stem").where(held != F.col("n"))
    return found(both, "planet_count", "stem", F.concat(F.lit("ground truth has "), F.col("n").cast("string")))


def inconsistent_masses(notes: DataFrame, planets: DataFrame, hosts: DataFrame) -> DataFrame:
    rows = planets.join(hosts.select("slug", "mass_msun"), "slug", "left")
    check = msini_earth(F.col("K_ms"), F.col("P_days"), F.col("e"), F.col("mass_msun"))
    bad = rows.withColumn("check", check).where(F.col("mass_flag").isNotNull() | outside_band(F.col("mass"), F.col("check")))
    return found(bad, "inconsistent_mass", "slug", F.concat_ws(": ", "letter", F.coalesce("mass_flag", F.lit("mass doesn't fit the orbit"))))


def dangling_thesis_links(notes: DataFrame) -> DataFrame:
    """One finding for each value: how many notes, and the first three."""
    rows = notes.where(F.array_contains("tags", "paper")).select("stem", F.explode("fm.thesis_links").alias("target"))
    gone = rows.join(notes.select(F.col("stem").alias("target")).distinct(), "target", "left_anti")
    held = gone.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.slice(F.array_sort(F.collect_set("stem")), 1, 3).alias("first"))
    return found(held, "dangling_thesis_link", "target", F.concat(F.col("n").cast("string"), F.lit(" notes: "), F.array_join("first", ", ")))


def dangling_disputes(notes: DataFrame) -> DataFrame:
    rows = notes.select("stem", F.explode("fm.planets").alias("p")).select("stem", "p.letter", F.explode("p.disputes.ref").alias("ref")).where(F.trim("ref") != "")
    papers = notes.where(F.array_contains("tags", "paper")).select(F.col("stem").alias("ref"))
    return found(rows.join(papers, "ref", "left_anti"), "dangling_dispute", "stem", F.concat_ws(": ", "letter", "ref"))


def implementation_leaks(notes: DataFrame, patterns: Sequence[tuple[str, str]] | None = None, lens: Lens | None = None) -> DataFrame:
    """The first pattern that a line holds; quoted lines and navigation are left out. Line numbers count line feeds only.

    Patterns are those given, else the lens's, else the usual ones.
    """
    patterns = patterns or (lens.leaks if lens else ()) or LEAKS
    lines = notes.where(~F.col("stem").isin(*NAVIGATION)).select("stem", F.posexplode(F.split("text", "\n")).alias("i", "s")).where(~F.startswith(F.ltrim("s"), F.lit(">")))
    what = F.coalesce(*[F.when(F.regexp_like("s", F.lit(p)), F.lit(name)) for p, name in patterns])
    return found(lines.withColumn("what", what).where("what is not null"), "implementation_leak", "stem", F.concat(F.lit("line "), (F.col("i") + 1).cast("string"), F.lit(": "), F.col("what")))


def undeclared_areas(notes: DataFrame, lens: Lens) -> DataFrame:
    """Concept areas that the lens doesn't declare; without any declaration nothing is undeclared."""
    if not lens.concept_areas:
        return found(notes.where("false"), "undeclared_area", "stem", F.col("stem"))
    known = [*lens.concept_areas, *RESERVED_AREAS]
    return found(notes.where("kind = 'concept' and fm.area is not null").where(~F.col("fm.area").isin(*known)), "undeclared_area", "stem", F.col("fm.area"))


def config_findings(notes: DataFrame, name: str, editor_folder: bool = False) -> DataFrame:
    """A placeholder name of the objective, and an editor's folder at the root."""
    rows = [("placeholder_objective", "warn", "objective", name)] * name.startswith(PLACEHOLDER) + [("editor_folder", "warn", "root", "an editor's folder stands at the root")] * editor_folder
    return notes.sparkSession.createDataFrame(rows, "category string, severity string, key string, detail string")


def pdf_drift(notes: DataFrame, disk: DataFrame) -> DataFrame:
    """A field that points at nothing, a file that no field names, and a header that doesn't say the same. disk: stem, path."""
    files = disk.select("stem", F.col("path").alias("file"))
    paths = disk.select(F.col("path").alias("at"), F.lit(True).alias("there"))
    rows = notes.where(F.array_contains("tags", "paper")).join(files, "stem", "left").join(paths, F.col("fm.pdf") == F.col("at"), "left")
    said = F.contains("body", F.lit("[pdf]("))
    what = F.when(F.col("fm.pdf").isNotNull() & F.col("there").isNull(), "the field points at nothing").when(F.col("fm.pdf").isNull() & F.col("file").isNotNull(), "a file that the field doesn't name").when(F.col("fm.pdf").isNotNull() & ~said, "the body doesn't link it").when(F.col("fm.pdf").isNull() & said, "the body links what the field doesn't name")
    return found(rows.withColumn("what", what).where("what is not null"), "pdf_drift", "stem", F.col("what"))


def pending_sources(notes: DataFrame) -> DataFrame:
    return found(notes.where("fm.pending_source is not null"), "pending_source", "stem", F.concat_ws(": ", "fm.pending_source", F.coalesce("fm.doi", "fm.source_url", F.lit("no pointer"))))


def illegible_texts(documents: DataFrame) -> DataFrame:
    rows = documents.withColumn("why", X.verdict_of_text(F.col("text"))).where("why <> 'ok'")
    return found(rows, "illegible_text", "stem", F.col("why"))


def citations(links: DataFrame) -> DataFrame:
    return links.where(F.col("kind").isin("query", "concept") & X.is_key(F.col("target")))


def unverifiable_citations(links: DataFrame, documents: DataFrame) -> DataFrame:
    gone = citations(links).join(documents.select(F.col("stem").alias("target")).distinct(), "target", "left_anti")
    return found(gone, "unverifiable_citation", "stem", F.col("target"))


def verified_on(text: Column, heading: str = VERIFICATION) -> tuple[Column, Column]:
    """Whether there is a verification block, under this heading (a pattern), and the latest date of all of them."""
    heads = F.regexp_extract_all(text, F.lit(rf"(?m)^##\s+(?:{heading})\b(.*)$"), F.lit(1))
    dates = F.transform(heads, lambda h: F.nullif(F.regexp_extract(h, r"[0-9]{4}-[0-9]{2}-[0-9]{2}", 0), F.lit("")))
    return F.size(heads) > 0, F.array_max(dates)


def verification(notes: DataFrame, links: DataFrame, changes: DataFrame, lens: Lens | None = None) -> DataFrame:
    """never_verified, stale_verification and no_citations of query and concept notes. changes: stem, changed_on.

    The lens names the heading of verification records.
    """
    n = citations(links).groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    has, last = verified_on(F.col("text"), lens.verification if lens else VERIFICATION)
    rows = notes.where("kind in ('query', 'concept')").join(n, "stem", "left").join(changes.select("stem", "changed_on"), "stem", "left")
    rows = rows.withColumn("n", F.coalesce("n", F.lit(0))).withColumn("has", has).withColumn("last", last)
    never = found(rows.where("n > 0 and not has"), "never_verified", "stem", F.concat(F.col("n").cast("string"), F.lit(" citations")))
    stale = found(rows.where("has and (last is null or cast(changed_on as string) > last)"), "stale_verification", "stem", F.coalesce(F.concat(F.lit("verified "), F.col("last")), F.lit("no date")))
    bare = found(rows.where("kind = 'concept' and n = 0"), "no_citations", "stem", F.lit("cites nothing"))
    return never.unionByName(stale).unionByName(bare)


def verified_since(notes: DataFrame, log: DataFrame, uncommitted: DataFrame, today: Column, heading: str = VERIFICATION) -> DataFrame:
    """stem, verified (its last verification's date), n_before and n_after (changes up to that day and after it) and
    last_before of every note that has a dated verification record.

    log: stem, changed_on, any number of changes a note; a change on the day of the verification counts as before it.
    uncommitted: stems that have changes which aren't in the log yet; they count as one change today.
    """
    _, last = verified_on(F.col("text"), heading)
    points = notes.select("stem", last.cast("date").alias("changed_on")).where("changed_on is not null")
    changes = log.select("stem", F.col("changed_on").cast("date").alias("changed_on")).unionByName(uncommitted.select("stem").distinct().withColumn("changed_on", today.cast("date")))
    return before(points, changes, "stem", "changed_on").select("stem", F.col("changed_on").alias("verified"), "n_before", "n_after", F.col("last").alias("last_before"))


def stale_since(history: DataFrame) -> DataFrame:
    """A finding for each note that changed after it was verified (see verified_since)."""
    return found(history.where("n_after > 0"), "stale_verification", "stem", F.concat(F.lit("verified "), F.col("verified").cast("string"), F.lit(", changes since: "), F.col("n_after").cast("string")))


def headless(notes: DataFrame, anchor: str) -> DataFrame:
    return found(notes.where(F.col("kind").isin("star", "concept") & ~F.contains("text", F.lit(anchor))), "no_generated_header", "stem", F.lit("no generator line"))


def triage(pending: DataFrame) -> DataFrame:
    """pending: slug, n."""
    return found(pending.where("n > 0"), "pending_triage", "slug", F.concat(F.col("n").cast("string"), F.lit(" candidates")))


def truncated(marks: DataFrame) -> DataFrame:
    """marks: slug, kind."""
    return found(marks, "truncated_search", "slug", F.col("kind"))


def discussed(body: Column, letter: Column) -> Column:
    """Whether prose speaks of a planet: in bold, in a table cell, as a subscript, or before a bracket."""
    safe = F.concat(F.lit(r"\Q"), letter, F.lit(r"\E"))
    shapes = [(r"\*\*[^*]*\b", r"\b[^*]*\*\*"), (r"\|\s*", r"\s*\|"), ("_", r"\b"), (r"\b", r"\s*\(")]
    tests = [F.regexp_like(body, F.concat(F.lit(a), safe, F.lit(z))) for a, z in shapes]
    return tests[0] | tests[1] | tests[2] | tests[3]


def incomplete(notes: DataFrame) -> DataFrame:
    star, paper = F.array_contains("tags", "star"), F.array_contains("tags", "paper")
    empty = lambda c: F.coalesce(F.size(c), F.lit(0)) <= 0
    rules = [
        (star & F.col("fm.P_rot_days").isNull(), "no rotation period"),
        (star & empty("fm.activity_indicators_expected"), "no expected indicators"),
        (paper & (F.col("fm.relevance") == "high") & empty("fm.methods"), "relevant without methods"),
        (paper & ~empty("fm.thesis_links") & F.col("fm.bearing").isNull(), "thesis links without bearing"),
    ]
    out = None
    for test, what in rules:
        part = found(notes.where(F.coalesce(test, F.lit(False))), "incomplete", "stem", F.lit(what))
        out = part if out is None else out.unionByName(part)
    planets = notes.where(star).select("stem", "body", F.explode("fm.planets.letter").alias("letter")).where(F.trim("letter") != "")
    silent = planets.where(~discussed(F.col("body"), F.trim("letter")))
    return out.unionByName(found(silent, "incomplete", "stem", F.concat(F.lit("planet not discussed: "), F.col("letter"))))


def report(findings: DataFrame) -> DataFrame:
    """category, severity and n."""
    return findings.groupBy("category", "severity").agg(F.count(F.lit(1)).alias("n"))


def gate(findings: DataFrame) -> int:
    """Exit code: 1 if anything blocks."""
    return int(not findings.where("severity = 'block'").isEmpty())


def declared_sources(topics: DataFrame) -> DataFrame:
    """slug, key and status of every declared source. topics: slug, area, concept, kinds, sources (key, url, pdf, pending).

    status: ok, pending, or what is wrong, by the first rule that fails. A topic without sources is one row.
    """
    kind = F.when(F.col("s.url").isNotNull(), "web").when(F.col("s.pdf").isNotNull(), "local-pdf")
    rows = topics.select("slug", "area", "concept", "kinds", F.explode_outer("sources").alias("s"))
    bad = (
        F.when(F.coalesce("area", F.lit("")) == "", "area is missing")
        .when(F.coalesce("concept", F.lit("")) == "", "concept is missing")
        .when(F.col("s").isNull(), "no sources")
        .when(~X.is_key(F.coalesce("s.key", F.lit(""))), "key is not a citation key")
        .when(F.col("s.pending").isNotNull(), "pending")
        .when(F.col("s.url").isNotNull() & F.col("s.pdf").isNotNull(), "url and pdf together")
        .when(F.col("s.url").isNull() & F.col("s.pdf").isNull(), "neither url nor pdf")
        .when(~F.array_contains("kinds", kind), "kind not allowed here")
    )
    return rows.select("slug", F.col("s.key").alias("key"), F.coalesce(bad, F.lit("ok")).alias("status"))


def wants_retraction_check(topics: DataFrame) -> DataFrame:
    """slug of topics that have anything a registry knows: a source with a DOI, or curated keys. topics: slug, dois, extra_core."""
    some = lambda c: F.coalesce(F.size(F.filter(c, lambda x: x.isNotNull() & (x != ""))), F.lit(0)) > 0
    return topics.where(some(F.col("dois")) | some(F.col("extra_core"))).select("slug")
