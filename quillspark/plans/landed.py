"""Queries over what is landed, stored and stamped: host rows, runs, decisions, note states, sources of texts, clauses, sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators import fetch, ledger, retract, truth
from quillspark.operators import notes as N
from quillspark.plans.registry import _FACETS, classified, query, table
from quillspark.plans.vault import VAULT, vault
from quillspark.sources import files
from quillspark.sources.store import new_path


@query("""
WITH c AS (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '--' ELSE c_mktsegment END AS kind, c_acctbal FROM customer),
h AS (SELECT c_nationkey, arg_min(c_custkey, c_custkey) AS k FROM c GROUP BY c_nationkey)
SELECT CAST(h.c_nationkey AS VARCHAR) AS slug, CASE WHEN c.kind IS NULL OR c.kind = '--' THEN CASE WHEN h.c_nationkey % 2 = 0 THEN n_name END ELSE c.kind END AS spectral_type, CAST(c_acctbal AS DOUBLE) AS "teff_K", CAST(c.c_custkey AS DOUBLE) AS "Vmag"
FROM h JOIN c ON c.c_custkey = h.k LEFT JOIN nation ON n_nationkey = h.c_nationkey""")
def host_rows(spark, sf_dir):
    """The first archive row of each host, with a second catalogue where the first says nothing."""
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    archive = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("slug"), k.alias("ordinal"), F.when(k % 3 == 1, "--").when(k % 3 == 2, F.col("c_mktsegment")).alias("st_spectype"), F.col("c_acctbal").cast("string").alias("st_teff"), k.cast("string").alias("sy_vmag"), *[none.alias(c) for c in ("st_mass", "st_rotp", "sy_dist", "ra", "dec")])
    second = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("slug"), F.col("n_name").alias("spectral_type"))
    return truth.hosts(archive, second).select("slug", "spectral_type", "teff_K", "Vmag")


@query(_FACETS + "SELECT lang AS slug, doc_id % 2 = 0 AS even, count(*) AS n, count(*) FILTER (WHERE why IS NULL) AS n_core, CAST(sum(n_chars) AS BIGINT) AS citations FROM c GROUP BY ALL")
def stored_runs(spark, sf_dir):
    """Runs written as JSON, one document a file, beside a broken one, and read back."""
    path = new_path(spark, "runs")
    rows = classified(spark, sf_dir).select("slug", (F.col("ordinal") % 2 == 0).alias("truncated"), F.pmod(F.xxhash64("bibcode"), F.lit(8)).alias("part"), F.struct("bibcode", "citation_count", "relevant").alias("r"))
    held = rows.groupBy("slug", "truncated", "part").agg(F.collect_list("r").alias("records")).drop("part")  # a run is one document, here in eight parts
    held.write.option("maxRecordsPerFile", 1).json(path)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(f"{path}/bad.json")
    each = files.runs(spark, path).select("slug", F.col("truncated").alias("even"), F.explode("records").alias("r"))
    return each.groupBy("slug", "even").agg(F.count(F.lit(1)).alias("n"), F.count_if("r.relevant").alias("n_core"), F.sum("r.citation_count").alias("citations"))


@query("""
WITH h AS (SELECT doc_id, max(CASE WHEN toxic = 1 THEN 'discarded' ELSE 'accepted' END) AS decision FROM labels GROUP BY doc_id)
SELECT CAST(doc_id AS VARCHAR) AS bibcode, decision, 'label' AS reason FROM h WHERE NOT (doc_id % 7 = 0 AND doc_id < 2000)
UNION ALL SELECT CAST(i AS VARCHAR), 'accepted', 'judged again' FROM range(0, 2000, 7) AS t(i)""")
def decision_upserts(spark, sf_dir):
    """The labels as decisions, with some decided anew."""
    held = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 1, "discarded").otherwise("accepted")).alias("decision"))
    held = held.select(F.lit("s").alias("slug"), F.col("doc_id").cast("string").alias("bibcode"), "decision", F.lit("label").alias("reason"), F.lit("2024-01-01").cast("date").alias("decided_on"))
    return ledger.upsert_decisions(held, "s", [str(i) for i in range(0, 2000, 7)], "accepted", "judged again").select("bibcode", "decision", "reason")


@query(VAULT + """
SELECT n.doc_id, CASE WHEN n.doc_id % 3 = 0 THEN 'none' WHEN n.doc_id % 5 < 3 THEN 'extracted' ELSE 'stub' END AS note_state, n.doc_id % 3 <> 0 AND (lang = 'en' OR n.doc_id % 7 = 1 OR n.doc_id % 11 = 1) AS named FROM n JOIN documents d USING (doc_id)""")
def note_states(spark, sf_dir):
    """What note each record has, and which of the existing notes a subject's records, declared sources or curated keys name."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    n = vault(spark, sf_dir).join(d, "doc_id")
    i = F.col("doc_id")
    held = n.where("doc_id % 3 <> 0").withColumn("fm", F.struct(F.when(i % 5 < 3, F.array(F.lit("m"))).alias("methods")))
    records = n.select("doc_id", F.col("stem").alias("bibcode"), (F.col("lang") == "en").alias("relevant"))
    named = retract.subject_keys(records, records.where("doc_id % 7 = 1"), records.where("doc_id % 11 = 1"), held.select(F.col("stem").alias("bibcode"))).withColumn("named", F.lit(True))
    out = N.note_state(records, held).join(named, "bibcode", "left")
    return out.select("doc_id", "note_state", F.coalesce("named", F.lit(False)).alias("named"))


@query(r"""
SELECT doc_id, CASE WHEN lang = 'de' THEN 'web' WHEN doc_id % 4 = 0 THEN 'eprintv2' WHEN doc_id % 4 = 1 THEN 'eprint' ELSE source END AS source,
       CASE WHEN doc_id % 5 <> 0 AND text IS NULL THEN 'publisher' WHEN doc_id % 5 <> 0 AND length(trim(text)) = 0 THEN 'publisher' END AS pending FROM documents""")
def document_sources(spark, sf_dir):
    """Where each text comes from, by snapshot, stamp or record, and what is still pending once it is there."""
    i = F.col("doc_id")
    stamp = F.when(i % 4 == 0, "arXiv:2101.01234v2 ").when(i % 4 == 1, "arxiv: astro-ph/0101234\n").otherwise("")
    d = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    source = N.document_source(F.col("lang") == "de", F.concat(stamp, F.regexp_replace(text, "(?i)arxiv", "")), F.col("source"))
    return d.select("doc_id", source.alias("source"), N.unpended(F.lit("publisher"), i % 5 == 0, F.length(F.trim(text)) > 0).alias("pending"))


@query(VAULT + """
SELECT stem, concat_ws(', ', 'erratum', CASE WHEN doc_id % 2 = 0 THEN 'removal' END) AS kinds FROM n WHERE doc_id % 31 = 2""")
def correction_kinds(spark, sf_dir):
    """The kinds of corrections that notes record, each once."""
    i = F.col("doc_id")
    kind = lambda name: F.struct(F.lit(name).alias("type"))
    more = F.when(i % 2 == 0, F.array(kind("erratum"), kind("removal"), kind("erratum"))).otherwise(F.array(kind("erratum"), kind("erratum")))
    return vault(spark, sf_dir).where("fm.corrections is not null").select("stem", retract.correction_types(more).alias("kinds"))


@query(_FACETS + "SELECT doc_id FROM c WHERE why IS NULL AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 25")
def first_missing(spark, sf_dir):
    """The first 25 core records without a document: the limit of one fetch."""
    records = classified(spark, sf_dir).select("bibcode", "ordinal", "relevant", F.lit(None).cast("string").alias("bibstem"), F.lit(None).cast("string").alias("year"))
    disk = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("stem")).distinct()
    return fetch.missing_documents(records, disk, limit=25).select(F.col("ordinal").alias("doc_id"))


@query(r"""
WITH b AS (SELECT doc_id, replace(regexp_replace(substr(text, 1, 2000), '\n', ' ', 'g'), ' the ', ' [[2001A]] the ') AS block FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, string_split(regexp_replace(block, '\.[\s\x0b]+([A-ZÁÉÍÓÚÑ¿¡(\[*])', '.' || chr(1) || '\1', 'g'), chr(1)) AS parts FROM b),
o AS (SELECT *, list_filter(parts, lambda p: contains(p, '[[2001A')) AS own FROM s)
SELECT doc_id, md5(CASE WHEN len(parts) < 2 OR len(own) = 0 THEN block ELSE trim(array_to_string(own, ' '), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END) AS clause FROM o""")
def cited_clauses(spark, sf_dir):
    """The sentences that cite a key, of the first 2,000 characters of each text as one block."""
    block = F.replace(F.regexp_replace(F.substring("text", 1, 2000), "\n", " "), F.lit(" the "), F.lit(" [[2001A]] the "))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.md5(X.clause_for(block, F.lit("2001A"))).alias("clause"))


@query(VAULT + """
SELECT stem, md5(replace(text, '# Note ' || doc_id || chr(10), '# Note ' || doc_id || chr(10) || '> generated note' || chr(10))) AS new_text FROM n WHERE doc_id % 3 = 1""")
def header_sweep(spark, sf_dir):
    """Only the notes that a sweep changes: those without the header line, with it after their title."""
    out = N.changed(vault(spark, sf_dir), N.insert_header(F.col("text"), N.GENERATED))
    return out.select("stem", F.md5("new_text").alias("new_text"))
