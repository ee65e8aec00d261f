"""Queries over a vault of notes that is made from the documents: audit, views, text edits and scalars, with their SQL.

A document's number says what its note is: papers (0 to 4 in the last digit), stars (5, 6), concepts (7), queries (8)
and others. Notes link to notes of computed numbers, some of which don't exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.config import Lens
from quillspark.functions import text as X
from quillspark.operators import audit, claims, discover, fetch, layout, ledger, render, truth
from quillspark.operators import notes as N
from quillspark.plans.registry import query, table
from quillspark.sources import query as language

_STEM = "CASE WHEN ({0}) % 10 < 5 THEN '2001A' || lpad(CAST({0} AS STRING), 6, '0') ELSE 'n' || CAST({0} AS STRING) END"


def _stem(x: str) -> str:
    return _STEM.format(x)


_PLACE = "CASE WHEN k < 5 THEN 'papers' WHEN k < 7 THEN 'stars' WHEN k = 7 THEN 'concepts/a' || CAST(doc_id % 3 AS STRING) WHEN k = 8 THEN 'queries' ELSE 'misc' END"
_BODY = f"""'# Note ' || CAST(doc_id AS STRING) || '\n' || CASE WHEN doc_id % 3 <> 1 THEN '> generated note\n' ELSE '' END
 || '· `x` · y' || CASE WHEN doc_id % 7 = 1 OR doc_id % 7 = 5 THEN ' · [pdf](a.pdf)' ELSE '' END || '\nOn **planet b** and the |c| cell. See [[{{one}}]] and [[{{two}}|that note]] for more words on it. The dial is set.\n'
 || '- A claim of note ' || CAST(doc_id AS STRING) || ' that cites [[{{one}}]]: with care. Another sentence cites [[{{two}}]] here\n> quoted dial\n\n## Search\nold\n'
 || CASE WHEN doc_id % 4 = 0 THEN '\n## Citation check 2024-0' || CAST(doc_id % 9 + 1 AS STRING) || '-11\n' WHEN doc_id % 4 = 1 THEN '\n## Citation check\n' ELSE '' END"""
#: The vault in the words that both engines share; `||` is spelled as concat for Spark by the engine itself.
_BASE = f"""
SELECT doc_id, k, n_chars, title, {_stem("doc_id")} AS stem, 'v/' || {_PLACE} || '/' || {_stem("doc_id")} || '.md' AS path,
       CASE WHEN k < 5 THEN 'paper' WHEN k < 7 THEN 'star' WHEN k = 7 THEN 'concept' WHEN k = 8 THEN 'query' ELSE 'other' END AS kind,
       {_stem("(doc_id * 7 + 3) % 1103")} AS one, {_stem("doc_id // 2")} AS two, {_stem("doc_id + 7")} AS seven, {_stem("doc_id + 5")} AS five
FROM (SELECT doc_id, doc_id % 10 AS k, n_chars, 'T' || CAST(doc_id AS STRING) AS title FROM documents)"""
_TEXT = "(" + _BODY.replace("{one}", "' || one || '").replace("{two}", "' || two || '") + ")"


def _sql_text() -> str:
    """The body's expression for DuckDB: line feeds inside its literals are kept as they are, since both engines take them."""
    return "WITH b AS (" + _BASE.replace("STRING", "VARCHAR") + "), n AS (SELECT *, " + _TEXT.replace("STRING", "VARCHAR") + " AS text FROM b)"


VAULT = _sql_text()


def vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    k, stem = F.col("doc_id") % 10, lambda x: F.expr(_stem(x).replace("//", "div"))
    rows = d.select("doc_id", "n_chars", k.alias("k"), F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), stem("doc_id").alias("stem"), stem("(doc_id * 7 + 3) % 1103").alias("one"), stem("(doc_id // 2)").alias("two"), stem("(doc_id + 7)").alias("seven"), stem("(doc_id + 5)").alias("five"))
    rows = rows.withColumn("path", F.expr(f"'v/' || {_PLACE} || '/' || stem || '.md'")).withColumn("text", F.expr(_TEXT))
    i, is_ = F.col("doc_id"), lambda kind: {"paper": k < 5, "star": k.isin(5, 6), "concept": k == 7}[kind]
    letters = F.slice(F.array(F.lit("b"), F.lit("c"), F.lit("d")), F.lit(1), (i % 4).cast("int"))
    planets = F.when(is_("star"), F.transform(letters, lambda x: F.struct(x.alias("letter"), (i % 13 + 1).cast("double").alias("K_ms"), (i % 50 + 2).cast("double").alias("P_days"), F.lit(0.1).alias("e"), F.lit(3.0).alias("mass_earth"), F.array(F.struct(F.col("five").alias("ref")), F.struct(F.lit(" ").alias("ref"))).alias("disputes"))))
    fm = F.struct(
        F.col("title"), (2000 + i % 20).cast("string").alias("year"), F.col("n_chars").alias("citations"), F.lit("10.1/x").alias("doi"), F.lit(None).cast("string").alias("source_url"),
        (i % 97 == 1).alias("retracted"), F.struct(F.when(i % 2 == 0, "removal").alias("type"), F.when(i % 5 == 0, "2020-01-02").alias("date")).alias("retraction"),
        F.when(i % 31 == 2, F.array(F.struct(F.when(i % 2 == 0, "erratum").alias("type"), F.lit(None).cast("string").alias("date"), F.when(i % 3 == 0, "10.2/y").alias("notice_doi")))).alias("corrections"),
        planets.alias("planets"), F.when(is_("paper") & (i % 3 == 0), F.array(F.col("seven"), F.concat(F.lit("ghost"), (i % 5).cast("string")))).alias("thesis_links"), F.when(i % 6 != 0, "yes").alias("bearing"),
        F.when(i % 4 == 0, "high").otherwise("low").alias("relevance"), F.when(i % 5 < 3, F.array(F.concat(F.lit("m"), (i % 3).cast("string")), F.lit("rv"))).otherwise(F.array().cast("array<string>")).alias("methods"),
        F.array(F.concat(F.lit("n"), (i - i % 10 + 5).cast("string"))).alias("stars"), F.when(is_("concept"), F.concat(F.lit("a"), (i % 3).cast("string"))).alias("area"),
        F.when(i % 7 < 3, F.concat(F.lit("pdf/"), F.col("stem"), F.lit(".pdf"))).alias("pdf"), F.when(i % 41 == 3, "publisher").alias("pending_source"), F.when(i % 2 == 0, 12.0).alias("P_rot_days"),
        F.when(i % 3 == 0, F.array(F.lit("S"))).alias("activity_indicators_expected"),
    )
    tags = F.when(is_("paper"), F.array(F.lit("paper"))).when(is_("star"), F.array(F.lit("star"))).when(is_("concept"), F.array(F.lit("concept"))).otherwise(F.array().cast("array<string>"))
    status = F.when(i % 53 == 4, "unclosed").when(i % 59 == 4, "invalid: x").otherwise("ok")
    return rows.select("doc_id", "k", "stem", "path", N.note_kind(F.col("path")).alias("kind"), tags.alias("tags"), "text", F.col("text").alias("body"), status.alias("fm_status"), fm.alias("fm"))


def _links(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    notes = vault(spark, sf_dir)
    return notes, audit.link_rows(notes)


def _out(findings: DataFrame) -> DataFrame:
    return findings.select("category", "severity", "key", "detail")


def _all(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return _out(out)


@query(VAULT + " SELECT stem, kind, regexp_matches(stem, '^[0-9]{4}[A-Za-z]') AS is_key, contains(path, '/stars/') AS in_stars, replace(one, '/', '_') AS safe FROM n")
def note_kinds(spark, sf_dir):
    n = vault(spark, sf_dir)
    return n.select("stem", "kind", X.is_key(F.col("stem")).alias("is_key"), X.in_dir(F.col("path"), "stars").alias("in_stars"), X.safe_name(F.get(X.links(F.col("text")), F.lit(0))).alias("safe"))


_LINKS = ", l AS (SELECT stem, kind, unnest([one, two, one, two]) AS target, unnest([0, 1, 2, 3]) AS pos FROM n)"


@query(VAULT + _LINKS + " SELECT stem, CAST(pos AS INTEGER) AS pos, target FROM l")
def link_extract(spark, sf_dir):
    return _links(spark, sf_dir)[1].select("stem", "pos", "target")


@query(VAULT + _LINKS + " SELECT n.stem, count(l.stem) AS incoming FROM n LEFT JOIN l ON l.target = n.stem GROUP BY n.stem")
def link_indegree(spark, sf_dir):
    return audit.in_degree(*_links(spark, sf_dir)).select("stem", F.col("incoming").cast("long").alias("incoming"))


@query(VAULT + _LINKS + """
SELECT 'broken_link' AS category, 'block' AS severity, stem AS key, target AS detail FROM l WHERE target NOT IN (SELECT stem FROM n)
UNION ALL SELECT 'orphan', 'block', stem, 'nothing links here' FROM n WHERE kind IN ('concept', 'query', 'other') AND stem NOT IN (SELECT target FROM l)
UNION ALL SELECT 'unverifiable_citation', 'backlog', stem, target FROM l WHERE kind IN ('query', 'concept') AND regexp_matches(target, '^[0-9]{4}[A-Za-z]')
  AND target NOT IN (SELECT stem FROM n WHERE doc_id % 2 = 0)""")
def audit_links(spark, sf_dir):
    notes, links = _links(spark, sf_dir)
    return _all(audit.broken_links(notes, links), audit.orphans(notes, links), audit.unverifiable_citations(links, notes.where("doc_id % 2 = 0")))


@query(VAULT + """
SELECT 'unreadable_head' AS category, 'block' AS severity, stem AS key, CASE WHEN doc_id % 53 = 4 THEN 'unclosed' ELSE 'invalid: x' END AS detail FROM n WHERE doc_id % 53 = 4 OR doc_id % 59 = 4
UNION ALL SELECT 'retracted', 'block', stem, CASE WHEN doc_id % 2 = 0 THEN 'removal' ELSE 'retraction' END || CASE WHEN doc_id % 5 = 0 THEN ' (2020-01-02)' ELSE ' (no date)' END FROM n WHERE doc_id % 97 = 1
UNION ALL SELECT 'correction', 'backlog', stem, CASE WHEN doc_id % 2 = 0 THEN 'erratum' ELSE 'correction' END || ' (no date) ' || CASE WHEN doc_id % 3 = 0 THEN '10.2/y' ELSE 'no notice DOI' END FROM n WHERE doc_id % 31 = 2
UNION ALL SELECT 'pending_source', 'backlog', stem, 'publisher: 10.1/x' FROM n WHERE doc_id % 41 = 3
UNION ALL SELECT 'no_generated_header', 'backlog', stem, 'no generator line' FROM n WHERE kind IN ('star', 'concept') AND doc_id % 3 = 1""")
def audit_heads(spark, sf_dir):
    n = vault(spark, sf_dir)
    return _all(audit.unreadable_heads(n), audit.retracted(n), audit.corrections(n), audit.pending_sources(n), audit.headless(n, N.GENERATED))


def _planets(spark, sf_dir) -> DataFrame:
    """Ground truth: two planets of each star, the second without an agreeing mass for every third."""
    i = F.col("doc_id")
    stars = vault(spark, sf_dir).where("k in (5, 6)").select(i, F.col("stem").alias("slug"))
    rows = stars.withColumn("letter", F.explode(F.array(F.lit("b"), F.lit("c"))))
    odd = (F.col("letter") == "c") & (i % 3 == 0)
    return rows.select("slug", "letter", (i % 13 + 1).cast("double").alias("K_ms"), (i % 50 + 2).cast("double").alias("P_days"), F.lit(0.0).alias("e"), F.when(odd, 1e9).alias("mass"), F.when((i % 7 == 0) & (F.col("letter") == "b"), "flagged").alias("mass_flag"))


@query(VAULT + """
SELECT 'planet_count' AS category, 'block' AS severity, stem AS key, 'ground truth has 2' AS detail FROM n WHERE kind = 'star' AND doc_id % 4 <> 2
UNION ALL SELECT 'inconsistent_mass', 'block', stem, 'b: flagged' FROM n WHERE kind = 'star' AND doc_id % 7 = 0
UNION ALL SELECT 'inconsistent_mass', 'block', stem, 'c: mass doesn''t fit the orbit' FROM n WHERE kind = 'star' AND doc_id % 3 = 0""")
def audit_truth(spark, sf_dir):
    n, planets = vault(spark, sf_dir), _planets(spark, sf_dir)
    hosts = planets.select("slug", F.lit(1.0).alias("mass_msun")).distinct()
    return _all(audit.planet_counts(n, planets), audit.inconsistent_masses(n, planets, hosts))


@query(VAULT + """,
t AS (SELECT stem, unnest([seven, 'ghost' || CAST(doc_id % 5 AS VARCHAR)]) AS target FROM n WHERE kind = 'paper' AND doc_id % 3 = 0),
g AS (SELECT target, count(*) AS c, list_sort(list(DISTINCT stem))[1:3] AS first FROM t WHERE target NOT IN (SELECT stem FROM n) GROUP BY target),
p AS (SELECT stem, five, unnest(['b', 'c', 'd'][1:doc_id % 4]) AS letter FROM n WHERE kind = 'star')
SELECT 'dangling_thesis_link' AS category, 'block' AS severity, target AS key, CAST(c AS VARCHAR) || ' notes: ' || array_to_string(first, ', ') AS detail FROM g
UNION ALL SELECT 'dangling_dispute', 'block', stem, letter || ': ' || five FROM p WHERE five NOT IN (SELECT stem FROM n WHERE kind = 'paper')""")
def audit_references(spark, sf_dir):
    n = vault(spark, sf_dir)
    return _all(audit.dangling_thesis_links(n), audit.dangling_disputes(n))


@query(VAULT + """
SELECT 'implementation_leak' AS category, 'warn' AS severity, stem AS key,
       'line ' || CAST(3 + CASE WHEN doc_id % 3 <> 1 THEN 1 ELSE 0 END AS VARCHAR) || ': dial' AS detail FROM n
UNION ALL SELECT 'undeclared_area', 'warn', stem, 'a' || CAST(doc_id % 3 AS VARCHAR) FROM n WHERE kind = 'concept' AND doc_id % 3 <> 0
UNION ALL SELECT 'placeholder_objective', 'warn', 'objective', '<name>' UNION ALL SELECT 'editor_folder', 'warn', 'root', 'an editor''s folder stands at the root'""")
def audit_lens(spark, sf_dir):
    n = vault(spark, sf_dir)
    return _all(audit.implementation_leaks(n), audit.undeclared_areas(n, Lens({"x": "x"}, concept_areas=("a0",))), audit.config_findings(n, "<name>", editor_folder=True))


@query(VAULT + """,
f AS (SELECT *, CASE WHEN doc_id % 7 < 3 THEN 'pdf/' || stem || '.pdf' END AS pdf, doc_id % 2 = 0 AS file, doc_id % 7 IN (1, 5) AS said FROM n WHERE kind = 'paper')
SELECT 'pdf_drift' AS category, 'warn' AS severity, stem AS key, CASE WHEN pdf IS NOT NULL AND NOT file THEN 'the field points at nothing' WHEN pdf IS NULL AND file THEN 'a file that the field doesn''t name'
  WHEN pdf IS NOT NULL AND NOT said THEN 'the body doesn''t link it' ELSE 'the body links what the field doesn''t name' END AS detail
FROM f WHERE (pdf IS NOT NULL AND NOT (file AND said)) OR (pdf IS NULL AND (file OR said))""")
def audit_drift(spark, sf_dir):
    n = vault(spark, sf_dir)
    disk = n.where("doc_id % 2 = 0").select("stem", F.concat(F.lit("pdf/"), F.col("stem"), F.lit(".pdf")).alias("path"))
    return _out(audit.pdf_drift(n, disk))


@query(VAULT + _LINKS + """,
c AS (SELECT stem, count(*) AS n FROM l WHERE kind IN ('query', 'concept') AND regexp_matches(target, '^[0-9]{4}[A-Za-z]') GROUP BY stem),
r AS (SELECT n.stem, n.kind, n.doc_id, coalesce(c.n, 0) AS cites, n.doc_id % 4 < 2 AS has, CASE WHEN n.doc_id % 4 = 0 THEN '2024-0' || CAST(n.doc_id % 9 + 1 AS VARCHAR) || '-11' END AS last FROM n LEFT JOIN c USING (stem) WHERE n.kind IN ('query', 'concept'))
SELECT 'never_verified' AS category, 'backlog' AS severity, stem AS key, CAST(cites AS VARCHAR) || ' citations' AS detail FROM r WHERE cites > 0 AND NOT has
UNION ALL SELECT 'stale_verification', 'backlog', stem, coalesce('verified ' || last, 'no date') FROM r WHERE has AND (last IS NULL OR '2024-05-01' > last)
UNION ALL SELECT 'no_citations', 'backlog', stem, 'cites nothing' FROM r WHERE kind = 'concept' AND cites = 0""")
def audit_verification(spark, sf_dir):
    notes, links = _links(spark, sf_dir)
    return _out(audit.verification(notes, links, notes.select("stem", F.lit("2024-05-01").cast("date").alias("changed_on"))))


@query(VAULT + """,
p AS (SELECT stem, unnest(['b', 'c', 'd'][1:doc_id % 4]) AS letter FROM n WHERE kind = 'star')
SELECT 'incomplete' AS category, 'backlog' AS severity, stem AS key, 'no rotation period' AS detail FROM n WHERE kind = 'star' AND doc_id % 2 = 1
UNION ALL SELECT 'incomplete', 'backlog', stem, 'no expected indicators' FROM n WHERE kind = 'star' AND doc_id % 3 <> 0
UNION ALL SELECT 'incomplete', 'backlog', stem, 'relevant without methods' FROM n WHERE kind = 'paper' AND doc_id % 4 = 0 AND doc_id % 5 >= 3
UNION ALL SELECT 'incomplete', 'backlog', stem, 'thesis links without bearing' FROM n WHERE kind = 'paper' AND doc_id % 6 = 0
UNION ALL SELECT 'incomplete', 'backlog', stem, 'planet not discussed: d' FROM p WHERE letter = 'd'
UNION ALL SELECT 'truncated_search', 'backlog', CAST(doc_id AS VARCHAR), 'direct search' FROM n WHERE doc_id % 9 = 0
UNION ALL SELECT 'truncated_search', 'backlog', CAST(doc_id AS VARCHAR), 'glyph superset: ' || g FROM (SELECT doc_id, unnest(['beta', 'eta'][1:doc_id % 3]) AS g FROM n)
UNION ALL SELECT 'pending_triage', 'backlog', CAST(doc_id AS VARCHAR), CAST(doc_id % 11 AS VARCHAR) || ' candidates' FROM n WHERE doc_id % 11 > 0""")
def audit_backlog(spark, sf_dir):
    n = vault(spark, sf_dir)
    slug, i = F.col("doc_id").cast("string").alias("slug"), F.col("doc_id")
    runs = n.select(slug, (i % 9 == 0).alias("truncated"), F.slice(F.array(F.lit("beta"), F.lit("eta")), F.lit(1), (i % 3).cast("int")).alias("cut_letters"))
    return _all(audit.incomplete(n), audit.truncated(ledger.truncations(runs)), audit.triage(n.select(slug, (i % 11).alias("n"))))


@query(VAULT + """
SELECT stem AS slug, CASE WHEN doc_id % 8 = 0 THEN NULL WHEN doc_id % 9 = 0 THEN 'bad' ELSE '2001A' END AS key,
       CASE WHEN doc_id % 13 = 0 THEN 'area is missing' WHEN doc_id % 17 = 0 THEN 'concept is missing' WHEN doc_id % 8 = 0 THEN 'no sources' WHEN doc_id % 9 = 0 THEN 'key is not a citation key'
            WHEN doc_id % 10 = 0 THEN 'pending' WHEN doc_id % 6 = 1 THEN 'url and pdf together' WHEN doc_id % 6 = 2 THEN 'neither url nor pdf' WHEN doc_id % 6 IN (3, 4) THEN 'kind not allowed here' ELSE 'ok' END AS status FROM n""")
def declared_sources(spark, sf_dir):
    i = F.col("doc_id")
    source = F.struct(F.when(i % 9 == 0, "bad").otherwise("2001A").alias("key"), F.when(i % 6 != 2, F.when(i % 6 < 5, "http://x")).alias("url"), F.when(i % 6 == 1, "a.pdf").when(i % 6 == 5, "b.pdf").when(i % 6 == 0, F.lit(None)).alias("pdf"), F.when(i % 10 == 0, "publisher").alias("pending"))
    kinds = F.when(i % 6 == 0, F.array(F.lit("web"))).otherwise(F.array(F.lit("local-pdf")))
    topics = vault(spark, sf_dir).select(F.col("stem").alias("slug"), F.when(i % 13 != 0, "a").alias("area"), F.when(i % 17 != 0, "c").alias("concept"), kinds.alias("kinds"), F.when(i % 8 != 0, F.array(source)).alias("sources"))
    return audit.declared_sources(topics)


@query(VAULT + " SELECT stem AS slug FROM n WHERE doc_id % 3 = 0 OR doc_id % 7 = 2")
def retraction_trigger(spark, sf_dir):
    i = F.col("doc_id")
    topics = vault(spark, sf_dir).select(F.col("stem").alias("slug"), F.when(i % 3 == 0, F.array(F.lit("10.1/x"))).when(i % 3 == 1, F.array(F.lit(""))).alias("dois"), F.when(i % 7 == 2, F.array(F.lit("2001A"))).alias("extra_core"))
    return audit.wants_retraction_check(topics)


@query(VAULT + """
SELECT stem, letter, CAST(doc_id % 50 + 2 AS DOUBLE) AS P_days, CAST(doc_id % 13 + 1 AS DOUBLE) AS K_ms, 3.0::DOUBLE AS mass_earth FROM (SELECT *, unnest(['b', 'c', 'd'][1:doc_id % 4]) AS letter FROM n WHERE stem = 'n15')""")
def planet_table(spark, sf_dir):
    return N.planets_of(vault(spark, sf_dir), "n15")


@query(VAULT + " SELECT stem, title, CAST(2000 + doc_id % 20 AS VARCHAR) AS year, n_chars AS citations FROM n WHERE doc_id - doc_id % 10 = 10")
def star_records(spark, sf_dir):
    return N.records_of(vault(spark, sf_dir), "n15")


@query(VAULT + " SELECT stem, unnest(['m' || CAST(doc_id % 3 AS VARCHAR), 'rv']) AS method FROM n WHERE doc_id - doc_id % 10 = 10 AND doc_id % 5 < 3")
def flatten_members(spark, sf_dir):
    return N.members(vault(spark, sf_dir), "n15")


@query(VAULT + " SELECT stem, title, CAST(2000 + doc_id % 20 AS VARCHAR) AS year FROM n WHERE (kind = 'paper' AND doc_id % 3 = 0 AND doc_id % 5 = 2) OR doc_id % 15 IN (2, 5, 11)")
def concept_records(spark, sf_dir):
    return N.records_on(vault(spark, sf_dir), "ghost2", False).unionByName(N.records_on(vault(spark, sf_dir), "m2", True)).distinct()


@query(VAULT + """
SELECT stem, CAST(doc_id % 4 AS INTEGER) AS n_planets, 'star' AS folder FROM n WHERE kind = 'star' UNION ALL SELECT stem, NULL, 'a' || CAST(doc_id % 3 AS VARCHAR) FROM n WHERE kind = 'concept'""")
def star_and_concept_index(spark, sf_dir):
    n = vault(spark, sf_dir)
    stars = N.star_index(n).select("stem", "n_planets", F.lit("star").alias("folder"))
    return stars.unionByName(N.concept_index(n).select("stem", F.lit(None).cast("int").alias("n_planets"), "folder"))


@query(VAULT + " SELECT stem, title, n_chars AS citations FROM n WHERE kind = 'paper' ORDER BY n_chars DESC, stem LIMIT 50")
def top50_index(spark, sf_dir):
    return N.record_index(vault(spark, sf_dir))


@query("""
SELECT source, coalesce(array_to_string(list_sort(list(DISTINCT CAST(n_chars % 7 AS VARCHAR)) FILTER (WHERE lang = 'de')), ', '), NULL) AS de, array_to_string(list_sort(list(DISTINCT CAST(n_chars % 7 AS VARCHAR)) FILTER (WHERE lang = 'en')), ', ') AS en FROM documents GROUP BY source""")
def method_matrix(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", "lang", (F.col("n_chars") % 7).alias("v"))
    return N.matrix(rows, "source", "lang", ["de", "en"], "v").select("source", F.nullif("de", F.lit("")).alias("de"), F.nullif("en", F.lit("")).alias("en"))


@query(VAULT + r"""
SELECT stem, '· `x` · y' || CASE WHEN doc_id % 7 IN (1, 5) THEN ' · [pdf](a.pdf)' ELSE '' END AS header,
       md5(replace(replace(text, ' · [pdf](a.pdf)', ''), '· `x` · y', '· `x` · y' || CASE WHEN doc_id % 2 = 0 THEN ' · [pdf](b.pdf)' ELSE '' END)) AS stamped,
       md5(CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10) || '## Search' || chr(10) || 'old' || chr(10), chr(10) || '## Search' || chr(10) || 'new $1') ELSE replace(text, chr(10) || '## Search' || chr(10) || 'old' || chr(10), '') END) AS section,
       md5(CASE WHEN doc_id % 3 = 1 THEN regexp_replace(text, chr(10), chr(10) || '> generated note 2' || chr(10)) ELSE text END) AS headed,
       md5(replace(text, '> quoted dial', '> new $ line')) AS repointed, replace(one || ' é/', ' é/', '%20%C3%A9%2F') AS quoted,
       CAST(doc_id AS VARCHAR) || ' found · 3 core' || CASE WHEN doc_id % 2 > 0 THEN ' · 1 discarded' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN ' · truncated' ELSE '' END AS line,
       left(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s|\s$', '', 'g'), 70) AS cell FROM n""")
def note_edits(spark, sf_dir):
    t, i = F.col("text"), F.col("doc_id")
    section = N.replace_section(t, "Search", F.when(i % 2 == 0, "new $1"))
    return vault(spark, sf_dir).select(
        "stem", N.header_line(t).alias("header"), F.md5(N.stamp_link(t, F.when(i % 2 == 0, "b.pdf"))).alias("stamped"), F.md5(section).alias("section"), F.md5(N.insert_header(t, "> generated note 2")).alias("headed"),
        F.md5(N.repoint(t, "^> quoted", "> new $ line")).alias("repointed"), N.quoted(F.concat(F.get(X.links(t), F.lit(0)), F.lit(" é/"))).alias("quoted"),
        N.search_line(i, F.lit(3), i % 2, i % 5 == 0).alias("line"), F.replace(X.table_cell(t), F.lit("\\|"), F.lit("|")).alias("cell"),
    )


@query(r"""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '2101.' || lpad(CAST(doc_id % 100000 AS VARCHAR), 5, '0') END AS eprint,
       'HD ' || CAST(doc_id AS VARCHAR) || ',HD' || CAST(doc_id AS VARCHAR) || ',tau Ceti' AS names, 'Claim, with marks' AS blind, TRY_CAST(CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) END AS INTEGER) AS number,
       CASE WHEN doc_id % 5 < 2 THEN 'v' || CAST(doc_id % 5 + 1 AS VARCHAR) WHEN doc_id % 5 = 2 THEN '' END AS stamp, CASE WHEN doc_id % 4 = 0 THEN '2020-02-03' END AS retrieved,
       CASE doc_id % 3 WHEN 0 THEN '2021' WHEN 1 THEN '2021-05' ELSE '2021-05-03' END AS parts, CASE WHEN doc_id % 4 = 1 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS unmasked, CAST(CASE WHEN doc_id % 4 = 1 THEN NULL ELSE doc_id END AS DOUBLE) AS value,
       CASE doc_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'web' ELSE 'pdftotext' END AS provenance, CASE doc_id % 3 WHEN 0 THEN 'open archive of the journal' WHEN 1 THEN 'no preprint and a closed site: ask for institutional access' ELSE 'academic mirror, the publisher''s table server, or ask for the document' END AS hint,
       'a et al.' AS authors, 'x,y,z' AS merged, doc_id % 2 = 0 AS gutter, doc_id % 3 = 0 AS hyphen, CAST(doc_id % 2 + 1 AS INTEGER) AS grep FROM documents""")
def scalar_functions(spark, sf_dir):
    i, text = F.col("doc_id"), F.col("doc_id").cast("string")
    ids = F.array(F.lit("10.1/x"), F.when(i % 2 == 0, F.concat(F.lit("arXiv:2101."), F.lpad((i % 100000).cast("string"), 5, "0"))).otherwise(F.lit("other")))
    stamp = F.when(i % 5 < 2, F.concat(F.lit("ArXiv: 2101.00001v"), (i % 5 + 1).cast("string"))).when(i % 5 == 2, "arXiv:astro-ph/0101001 x").otherwise("none")
    snap = F.when(i % 4 == 0, "# t\nretrieved : 2020-02-03 10:00").otherwise("a\n" * 9 + "retrieved: 2020-02-03")
    parts = F.slice(F.array(F.lit(2021), F.lit(5), F.lit(3)), F.lit(1), (i % 3 + 1).cast("int"))
    masked = F.when(i % 4 == 1, " -- ").otherwise(F.concat(F.lit(" "), text))
    stem = F.when(i % 3 == 0, "Msngr").when(i % 3 == 1, "A&A").otherwise("ApJ")
    line = F.concat(F.when(i % 2 == 0, "left" + " " * 9 + "right").otherwise("left right"), F.when(i % 3 == 0, " bro-  ").otherwise(" end"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif(X.arxiv_id(ids), F.lit("")).alias("eprint"), F.array_join(X.expand_variants(F.array(F.concat(F.lit("HD"), text), F.lit(" tau Ceti "), F.concat(F.lit("HD "), text))), ",").alias("names"),
        X.blind(F.lit(" - : Claim,\n with  [[2001A|x]]marks ; ").substr(4, 60)).alias("blind"), X.parse_int(F.when(i % 3 == 0, F.concat(F.lit(" "), text)).otherwise("x")).alias("number"), X.eprint_stamp(stamp).alias("stamp"), X.snapshot_date(snap).alias("retrieved"),
        X.date_parts(parts).alias("parts"), X.unmasked(masked).alias("unmasked"), X.number(masked).alias("value"), N.text_provenance(F.when(i % 3 == 0, "[ocr] a").when(i % 3 == 1, "[web] a").otherwise("a")).alias("provenance"),
        X.rescue_hint(stem, F.lit("2001")).alias("hint"), N.authors_line(F.array(F.lit("a"), F.lit("b")), 1).alias("authors"), F.array_join(N.merge_list(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("y"), F.lit("z"))), ",").alias("merged"),
        X.has_gutter(line).alias("gutter"), X.ends_hyphenated(line).alias("hyphen"), X.grep_line(F.when(i % 2 == 0, F.array(F.lit("A  Quote"), F.lit("b"))).otherwise(F.array(F.lit("b"), F.lit("a quote here"))), F.lit("a quote")).cast("int").alias("grep"),
    )


@query(r"""
WITH w AS (SELECT doc_id, ' ' || lower(trim(regexp_replace(regexp_replace(split_part(text, chr(10), 1), '[^\w.+\-]+', ' ', 'g'), '\s+', ' ', 'g'))) || ' ' AS t, lang, n_chars FROM documents)
SELECT doc_id FROM w WHERE (contains(t, ' the ') AND contains(t, ' of ')) OR contains(t, ' in ') OR doc_id IN (SELECT doc_id // 2 FROM documents WHERE doc_id % 100 = 42)""")
def query_language(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    rows = d.select(F.col("doc_id").cast("string").alias("bibcode"), F.substring_index("text", "\n", 1).alias("title"), F.when(F.col("doc_id") % 100 == 42, "1942").alias("year"), "doc_id")
    edges = d.select(F.col("doc_id").cast("string").alias("src"), F.expr("cast(doc_id div 2 as string)").alias("dst"))
    return language.select(rows, edges, '(title:"the" title:of) OR title:"in" OR references(year:1942)').select("doc_id")


@query(r"""
WITH g AS (SELECT doc_id, n_chars, CASE WHEN doc_id % 3 = 0 THEN 'the ϵ Eri' WHEN doc_id % 3 = 1 THEN 'the eps Eri' ELSE 'Eridanus and εEri' END AS title FROM documents)
SELECT doc_id, 'glyph' AS via, contains(lower(title), 'eps eri') OR doc_id % 3 <> 1 AS named FROM g WHERE doc_id % 3 <> 1""")
def glyph_rescue(spark, sf_dir):
    i = F.col("doc_id")
    title = F.when(i % 3 == 0, "the ϵ Eri").when(i % 3 == 1, "the eps Eri").otherwise("Eridanus and εEri")
    rows = table(spark, sf_dir, "documents").select(i.alias("ordinal"), title.alias("title"), F.lit(None).cast("string").alias("abstract"), F.col("n_chars").alias("citation_count"))
    found, _ = discover.glyph_rescue(rows, ["eps Eri", "tau Cet", "ε  Eridani"], rows=None)
    return found.select(F.col("ordinal").alias("doc_id"), "via", discover.subject_in_title(F.col("title"), ["eps Eri"]).alias("named"))


@query("""
WITH u AS (SELECT page_id, url, page_id % 4 AS k FROM pages)
SELECT page_id, 1 AS rank, 'EPRINT_PDF' AS kind, url FROM u WHERE k IN (0, 1) UNION ALL SELECT page_id, 3, 'PUB_PDF', CASE WHEN k = 2 THEN 'https://doi.org/10.1/x' ELSE url END FROM u WHERE k IN (1, 2)""")
def candidate_urls(spark, sf_dir):
    k, url = F.col("page_id") % 4, F.col("url")
    link = lambda u, t: F.struct(u.alias("url"), F.lit(t).alias("link_type"))
    links = F.when(k == 0, F.array(link(F.lit("http://$x"), "ESOURCE|PUB_PDF"), link(url, "ESOURCE|EPRINT_PDF"), link(F.lit("http://later"), "x|EPRINT_PDF"))).when(k == 1, F.array(link(url, "PUB_PDF"), link(url, "EPRINT_PDF"), link(url, "HTML")))
    rows = table(spark, sf_dir, "pages").select(F.col("page_id").alias("bibcode"), links.alias("links"), F.when(k == 2, " 10.1/x ").alias("link"))
    return fetch.candidate_urls(rows).select(F.col("bibcode").alias("page_id"), "rank", "kind", "url")


@query("""
WITH l AS (SELECT *, doc_id % 4 AS k, length(regexp_replace(text, '\\s', '', 'g')) >= 200 AND length(regexp_replace(text, '[^!-~]', '', 'g')) / CAST(length(regexp_replace(text, '\\s', '', 'g')) AS DOUBLE) >= 0.85 AS ok FROM documents)
SELECT doc_id, CASE WHEN k = 0 AND ok THEN 'kept' WHEN k = 1 THEN 'kept' WHEN k IN (0, 3) AND ok THEN 'layer' WHEN k IN (0, 2) THEN 'ocr' WHEN k = 3 THEN 'illegible' ELSE 'failed' END AS status FROM l""")
def text_choice(spark, sf_dir):
    k, t = F.col("doc_id") % 4, F.col("text")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(k <= 1, t).alias("held_text"), (k == 1).alias("held_is_ocr"), F.when(k.isin(0, 3), t).alias("layer_text"), F.when(k.isin(0, 2), F.lit("ocr")).alias("ocr_text"))
    return fetch.text_choice(rows, can_ocr=True).select("doc_id", "status")


@query("""
WITH u AS (SELECT doc_id, text FROM documents), e AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM u),
m AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE contains(s, ';         ')) AS g FROM (SELECT doc_id, replace(s, ', ', ';         ') AS s FROM e) WHERE length(regexp_replace(s, '^\\s+|\\s+$', '', 'g')) >= 40 GROUP BY doc_id)
SELECT doc_id, n AS n_useful, g AS n_gutter, g / CAST(n AS DOUBLE) > 0.3 AS multi_column FROM m ORDER BY g / CAST(n AS DOUBLE) DESC, doc_id DESC LIMIT 40""")
def widest_texts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.lit("all").alias("slug"), F.col("doc_id").alias("stem"), F.replace("text", F.lit(", "), F.lit(";" + " " * 9)).alias("text"))
    return layout.widest(d, 40).select(F.col("stem").alias("doc_id"), "n_useful", "n_gutter", "multi_column")


@query(VAULT + """,
c AS (SELECT stem, 2 + CASE WHEN doc_id % 3 <> 1 THEN 1 ELSE 0 END AS line, one, two FROM n),
x AS (SELECT stem, unnest([line, line, line + 2, line + 2]) AS line, unnest([one, two, one, two]) AS key FROM c)
SELECT DISTINCT stem AS note, CAST(line AS INTEGER) AS line, key AS bibcode FROM x WHERE regexp_matches(key, '^[0-9]{4}[A-Za-z]') AND key IN (SELECT stem FROM n WHERE doc_id % 2 = 0)""")
def claim_pairs(spark, sf_dir):
    n = vault(spark, sf_dir)
    out = claims.pairs(n.select("stem", "text"), n.where("doc_id % 2 = 0").select("stem"), most=None)
    return out.select("note", "line", "bibcode").distinct()


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS slug, CAST(l_linenumber AS VARCHAR) AS letter, CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) END AS P_days,
       CAST(l_quantity AS DOUBLE) AS msini, CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS DOUBLE) * 9 END AS bmass, CAST(l_quantity AS DOUBLE) AS mass, 'msini' AS mass_source,
       CASE WHEN l_linenumber <> 2 THEN 'reported masses disagree and no orbit decides' END AS mass_flag, CAST(2000 + l_linenumber AS INTEGER) AS disc_year FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_extendedprice, l_quantity FROM lineitem) WHERE l_quantity > 0""")
def ground_truth(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").where("l_quantity > 0").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity").distinct()
    none = lambda c, test: F.when(test, "--").otherwise(c.cast("string"))
    one = F.col("l_linenumber")
    archive = rows.select(
        F.col("l_orderkey").cast("string").alias("slug"), F.concat(F.lit("HD 1 "), one.cast("string")).alias("pl_name"), none(F.col("l_extendedprice"), one == 1).alias("pl_orbper"), F.lit("nan").alias("pl_rvamp"), F.lit("0.1").alias("pl_orbeccen"),
        F.col("l_quantity").cast("string").alias("pl_msinie"), none(F.col("l_quantity") * 9, one == 2).alias("pl_bmasse"), F.lit("").alias("pl_bmassprov"), F.lit("1").alias("st_mass"), F.lit("RV").alias("discoverymethod"), (2000 + one).cast("string").alias("disc_year"), F.lit("x").alias("disc_refname"),
    )
    return truth.ground_truth(archive).select("slug", "letter", "P_days", "msini", "bmass", "mass", "mass_source", "mass_flag", "disc_year")


@query("""
WITH r AS (SELECT doc_id, lang, source, count(*) OVER () AS n FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS bibcode, 'no eprint' AS reason FROM r WHERE doc_id % 10 = 3 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'failed' FROM r WHERE doc_id % 10 = 7""")
def fetch_residue(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("bibcode"), "doc_id")
    return fetch.residue(rows.where("doc_id % 10 = 3"), rows.where("doc_id % 10 = 7"))


@query("""
SELECT status, count(*) AS n FROM (SELECT CASE doc_id % 3 WHEN 0 THEN 'stored' WHEN 1 THEN 'kept' ELSE 'failed' END AS status FROM documents) GROUP BY status""")
def ingest_steps(spark, sf_dir):
    status = F.when(F.col("doc_id") % 3 == 0, "stored").when(F.col("doc_id") % 3 == 1, "kept").otherwise("failed")
    return fetch.step_counts(table(spark, sf_dir, "documents").select(status.alias("status")))


@query("""
WITH h AS (SELECT doc_id FROM documents WHERE lang = 'en'), k AS (SELECT doc_id FROM documents WHERE doc_id % 3 = 0)
SELECT doc_id FROM h WHERE doc_id NOT IN (SELECT doc_id FROM k)""")
def full_text_sweep(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ordinal"), F.col("doc_id").cast("string").alias("bibcode"), F.col("n_chars").alias("citation_count"), (F.col("lang") == "en").alias("relevant"))
    return discover.sweep(rows.where("ordinal % 3 = 0"), rows).select(F.col("ordinal").alias("doc_id"))


@query("""
WITH c AS (SELECT source AS entity, lang AS parameter, count(DISTINCT CAST(doc_id AS VARCHAR)) AS n_records, md5(array_to_string(list_sort(list(DISTINCT CAST(doc_id AS VARCHAR))), ',')) AS records FROM documents GROUP BY ALL)
SELECT * FROM c WHERE n_records > 1""")
def contradiction_axes(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("entity"), F.col("lang").alias("parameter"), F.col("doc_id").cast("string").alias("bibcode"))
    return claims.contradictions(rows).select("entity", "parameter", "n_records", F.md5(F.array_join("records", ",")).alias("records"))


@query("""
SELECT doc_id, n_found, truncated FROM (SELECT doc_id, n_chars, count(*) OVER () AS n_found, count(*) OVER () > 100 AS truncated FROM documents WHERE lang = 'en') ORDER BY n_chars DESC, doc_id LIMIT 100""")
def catalogue_search(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ordinal"), F.col("n_chars").alias("citation_count"), "lang")
    found: Column = F.col("lang") == "en"
    return discover.search(rows, found, rows=100).select(F.col("ordinal").alias("doc_id"), F.col("num_found").alias("n_found"), "truncated")


@query(VAULT + """,
r AS (SELECT n.*, d.source, d.lang FROM n JOIN documents d USING (doc_id))
SELECT stem, '---' || chr(10) || 'title: ''' || title || ' it''''s''' || chr(10) || 'tags: [paper]' || chr(10) || 'year: ''2001''' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'doi: ''10.1/x''' || chr(10) ELSE '' END
  || 'citations: ' || CAST(n_chars AS VARCHAR) || chr(10) || 'methods: []' || chr(10) || '---' || chr(10) || '# ' || title || ' it''s' || chr(10) || '· `' || stem || '` · A, B' || chr(10) || chr(10) || '## Search' || chr(10) AS text, NULL AS unknown_area
FROM r WHERE k < 5 AND doc_id % 3 <> 0
UNION ALL SELECT stem, array_to_string(list_filter(['---', 'title: ''' || title || '''', 'name: ''' || title || '''', 'aliases: []', 'tags: [concept]', 'area: ''' || CASE WHEN doc_id % 4 = 1 THEN 'hypotheses' ELSE lang END || '''',
  CASE WHEN doc_id % 4 = 1 THEN 'status: ''open''' END, 'confidence: medium', '---', '# ' || title, '> generated note', '', '## Synthesis', '', '## Gaps', '', '## Records', '```view', 'records_on: ' || stem, '```', ''], lambda x: x IS NOT NULL), chr(10)), doc_id % 4 <> 1 AND lang <> 'en' FROM r WHERE k = 7 AND doc_id % 3 <> 0
UNION ALL SELECT stem, array_to_string(['---', 'title: ''' || title || '''', 'name: ''' || title || '''', 'slug: ''' || stem || '''', 'aliases: []', 'simbad_id: null', 'tags: [star]', 'spectral_type: null', 'teff_K: 5000.0', 'dist_pc: ' || CASE WHEN n_chars = 0 THEN 'null' ELSE CAST(n_chars AS VARCHAR) || '.0' END, 'P_rot_days: null', 'activity_indicators_expected: []',
  'planets: [{letter: ''c'', P_days: 1.5, K_ms: null, e: null, mass_earth: null, status: null}, {letter: ''b'', P_days: null, K_ms: null, e: null, mass_earth: 2.0, status: ''known''}]', 'data_local: null', 'methods_applied: {literature: [], ours: []}', 'confidence: medium', '---',
  '# ' || title, '> generated note', '', '## Summary', '', '## Gaps', '', '## Planets', '| letter | P (d) | K (m/s) | e | mass (Earths) | status |', '|---|---|---|---|---|---|', '| c | 1.5 |  |  |  |  |', '| b |  |  |  | 2.0 | known |', '',
  '## Records', '```view', 'records_of: ' || stem, '```', '', '## Methods', '```view', 'members: ' || stem, '```', '', '## Data', 'none', ''], chr(10)), NULL FROM r WHERE k IN (5, 6) AND doc_id % 3 <> 0
UNION ALL SELECT stem, '---' || chr(10) || 'title: ''' || title || '''' || chr(10) || 'tags: [paper, ' || CASE WHEN doc_id % 2 = 0 THEN 'web' ELSE 'local-pdf' END || ']' || chr(10) || 'year: null' || chr(10)
  || CASE WHEN doc_id % 2 = 0 THEN 'source_url: ''http://x''' || chr(10) ELSE 'pdf: ''a.pdf''' || chr(10) END || CASE WHEN doc_id % 2 = 0 AND doc_id % 5 <> 0 THEN 'accessed: ''2020-01-02''' || chr(10) ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN 'pending_source: ''publisher''' || chr(10) ELSE '' END
  || '---' || chr(10) || '# ' || title || chr(10) || '· `' || stem || '` · A, B' || chr(10) || chr(10) || '## Search' || chr(10), NULL FROM r WHERE k IN (8, 9) AND doc_id % 3 <> 0""")
def rendered_notes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    n = vault(spark, sf_dir).join(d, "doc_id").withColumn("slug", F.col("stem")).withColumn("name", F.col("fm.title"))
    held = n.where("doc_id % 3 = 0").select("stem")
    authors = F.array(F.lit("A"), F.lit("B"))
    records = n.where("k < 5").select(F.col("stem").alias("bibcode"), F.concat("name", F.lit(" it's")).alias("title"), authors.alias("authors"), F.lit("2001").alias("year"), F.when(F.col("doc_id") % 2 == 0, "10.1/x").alias("doi"), F.col("fm.citations").alias("citation_count"), F.lit(True).alias("relevant"))
    concepts = n.where("k = 7").select("slug", "name", F.when(F.col("doc_id") % 4 == 1, "hypotheses").otherwise(F.col("lang")).alias("area"), F.lit(None).cast("string").alias("status"))
    hosts = n.where("k in (5, 6)").select("slug", "name", F.lit(None).cast("string").alias("spectral_type"), F.lit(5000.0).alias("teff_K"), F.nullif(F.col("fm.citations").cast("double"), F.lit(0.0)).alias("dist_pc"))
    planets = hosts.select("slug", F.explode(F.array(F.struct(F.lit("b").alias("letter"), F.lit(None).cast("double").alias("P_days"), F.lit(2.0).alias("mass"), F.lit("known").alias("status")), F.struct(F.lit("c").alias("letter"), F.lit(1.5).alias("P_days"), F.lit(None).cast("double").alias("mass"), F.lit(None).cast("string").alias("status")))).alias("p")).select("slug", "p.*")
    even, i = F.col("doc_id") % 2 == 0, F.col("doc_id")
    sources = n.where("k in (8, 9)").select(F.col("stem").alias("bibcode"), F.col("name").alias("title"), authors.alias("authors"), F.lit(None).cast("string").alias("year"), F.lit(None).cast("string").alias("doi"), F.when(even, "http://x").alias("url"), F.when(~even, "a.pdf").alias("pdf"), F.when(i % 5 == 0, "publisher").alias("pending"), F.lit(None).cast("date").alias("explicit"), F.lit("2020-01-02").cast("date").alias("snapshot"))
    none = F.lit(None).cast("boolean").alias("unknown_area")
    parts = [render.record_notes(records, held).select("stem", "text", none), render.concept_notes(concepts, held, Lens({"x": "x"}, concept_areas=("en",))), render.entity_notes(hosts, planets, held).select("stem", "text", none), render.source_notes(sources, held).select("stem", "text", none)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN 'plain' WHEN doc_id % 2 = 0 THEN '---' || chr(10) || 'title: a' || chr(10) || 'retracted: true' || chr(10) || 'other: 1' || chr(10) || 'retraction: {type: ''removal'', date: null}' || chr(10) || 'fulltext: web' || chr(10) || '---' || chr(10) || 'body --- x'
  ELSE '---' || chr(10) || 'title: a' || chr(10) || 'retracted: false' || chr(10) || 'other: 1' || chr(10) || 'fulltext: web' || chr(10) || '---' || chr(10) || 'body --- x' END AS text FROM documents""")
def stamped_heads(spark, sf_dir):
    i = F.col("doc_id")
    text = F.when(i % 3 == 2, "plain").otherwise("---\ntitle: a\nretracted: false\nother: 1\n---\nbody --- x")
    notice = F.struct(F.lit("removal").alias("type"), F.lit(None).cast("string").alias("date"))
    return table(spark, sf_dir, "documents").select("doc_id", render.stamp(render.retraction_stamp(text, i % 2 == 0, notice), {"fulltext": F.lit("web")}).alias("text"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS title, CASE WHEN doc_id % 3 = 0 THEN '10.1/x' END AS doi, '' AS bibstem, CASE WHEN doc_id % 5 = 0 THEN '2101.00001' END AS arxiv_id, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE n_chars END AS citation_count,
       contains(lower(regexp_replace(text, '\\s+', ' ', 'g')), 'the of') OR contains(lower(regexp_replace(text, '\\s+', ' ', 'g')), 'licensed under') AS said, 'a whole word, and-\nMore' AS whole FROM documents""")
def record_projection(spark, sf_dir):
    i, none = F.col("doc_id"), F.array().cast("array<string>")
    raw = table(spark, sf_dir, "documents").select("doc_id", "text", F.when(i % 2 == 0, F.array("source", F.lit("later"))).otherwise(none).alias("title"), F.when(i % 3 == 0, F.array(F.lit("10.1/x"))).alias("doi"), none.alias("bibstem"), F.when(i % 5 == 0, F.array(F.lit("x"), F.lit("arXiv:2101.00001"))).otherwise(none).alias("identifier"), F.when(i % 4 != 0, F.col("n_chars")).alias("citation_count"))
    said = discover.in_full_text(["the  of", "Licensed under"])
    return discover.projected(raw).select("doc_id", "title", "doi", "bibstem", "arxiv_id", "citation_count", said.alias("said"), X.joined_lines(F.lit("a who-\n  le word, and-\nMore")).alias("whole"))
