"""Queries over many subjects at once: names in texts, phrase search by postings, staged discovery.

The first three words of a document's text, as far as they are letters, name a subject: the first document that starts so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import names, stages
from quillspark.plans.registry import _FACETS, classified, part_edges, query, table
from quillspark.sources.index import Index
from quillspark.sources.store import new_path, staged

_FIRST = r"^\s*([A-Za-z]+ [A-Za-z]+ [A-Za-z]+)"


def subject_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """subject (the least number of the documents that start so) and name, lower-cased."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lower(F.regexp_extract("text", _FIRST, 1)).alias("name")).where("name <> ''")
    return rows.groupBy("name").agg(F.min("doc_id").alias("subject"))


_NAMES = r"""
WITH RECURSIVE s AS (SELECT min(doc_id) AS subject, lower(regexp_extract(text, '^\s*([A-Za-z]+ [A-Za-z]+ [A-Za-z]+)', 1)) AS phrase FROM documents WHERE regexp_extract(text, '^\s*([A-Za-z]+ [A-Za-z]+ [A-Za-z]+)', 1) <> '' GROUP BY 2),
x AS (SELECT *, lower(trim(regexp_replace(text, '[\s\x{a0}\x0b\x1c-\x1f\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) AS whole FROM documents),
u AS (SELECT DISTINCT phrase FROM s), m AS (SELECT x.doc_id, u.phrase FROM x JOIN u ON contains(x.whole, u.phrase))
"""


@query(_NAMES + "SELECT s.subject, count(*) AS n_docs, min(m.doc_id) AS first_doc, CAST(sum(m.doc_id) AS BIGINT) AS ids FROM m JOIN s USING (phrase) GROUP BY s.subject")
def subject_mentions(spark, sf_dir):
    """For every subject the documents whose text says its name."""
    hits = names.mentioned(table(spark, sf_dir, "documents"), [F.col("text")], subject_names(spark, sf_dir), ["doc_id"])
    return hits.groupBy("subject").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"), F.sum("doc_id").alias("ids"))


_TERMS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, list_slice(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+'), 1, 6) AS w FROM benchmark),
r AS (SELECT doc_id, i - 1 AS place, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key FROM d, (SELECT DISTINCT len(w) AS n FROM b WHERE len(w) > 0) AS z, unnest(range(1, len(w) - n + 2)) AS u(i))
"""


@query(_TERMS + "SELECT item_id, doc_id, count(*) AS n, min(place) AS first_at FROM r JOIN b ON key = array_to_string(w, ' ') GROUP BY item_id, doc_id")
def phrase_search(spark, sf_dir):
    """Where documents say the first six words of benchmark items, from an index that is written in two batches."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    index = Index(spark, new_path(spark, "index"), buckets=16)
    index.append(docs.where("doc % 2 = 0"))
    index.append(docs.where("doc % 2 <> 0"))
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), 1, 6), " ")
    found = index.search(table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), head.alias("phrase")))
    return found.select(F.col("query_id").alias("item_id"), F.col("doc").alias("doc_id"), F.size("starts").cast("long").alias("n"), F.get("starts", F.lit(0)).cast("long").alias("first_at"))


def _discovered(spark: SparkSession, sf_dir: str) -> stages.Discovery:
    """Subjects are the documents by name, and each source as a topic of all its documents; parts in one order cite each other."""
    docs = table(spark, sf_dir, "documents")
    named = subject_names(spark, sf_dir).select(F.concat(F.lit("d"), F.col("subject").cast("string")).alias("subject"), "name")
    named = staged(named, "names")  # several stages ask for names and citations
    topics = docs.select(F.concat(F.lit("t"), F.col("source")).alias("subject"), F.col("doc_id").cast("string").alias("bibcode")).where("subject is not null")
    subjects = named.select("subject", F.lit(False).alias("is_topic")).unionByName(topics.select("subject", F.lit(True).alias("is_topic")).distinct())
    records = classified(spark, sf_dir).select("bibcode", "ordinal", "title", F.lit(None).cast("string").alias("abstract"), F.col("abstract").alias("text"), "citation_count", "relevant")
    edges = part_edges(spark, sf_dir).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    edges = staged(edges, "citations")
    labels = table(spark, sf_dir, "labels")
    extra = labels.where("quality = 1").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("subject"), (F.col("doc_id") + 1).cast("string").alias("bibcode"))
    toxic = labels.where("toxic = 1").select(F.col("doc_id").cast("string").alias("dst"))
    decisions = edges.join(toxic, "dst", "left_semi").select(F.concat(F.lit("d"), F.col("src")).alias("subject"), F.col("dst").alias("bibcode"), F.lit("discarded").alias("decision"))
    return stages.discover(subjects, named, records, edges, extra, decisions, topics, rows=30)


_STAGES = _NAMES + _FACETS.replace("WITH r AS", ", r AS", 1).lstrip("\n") + r""",
rec AS (SELECT CAST(doc_id AS VARCHAR) AS bibcode, doc_id AS ordinal, n_chars AS cites, why IS NULL AS relevant, lower(trim(regexp_replace(split_part(text, chr(10), 1), '[\s\x{a0}\x0b\x1c-\x1f\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) AS title, source FROM c),
said AS (SELECT 'd' || s.subject AS subject, CAST(m.doc_id AS VARCHAR) AS bibcode, contains(rec.title, s.phrase) AS in_title FROM m JOIN s USING (phrase) JOIN rec ON rec.ordinal = m.doc_id),
topic AS (SELECT 't' || source AS subject, bibcode FROM rec WHERE source IS NOT NULL),
anchor AS (SELECT subject, bibcode FROM said UNION SELECT subject, bibcode FROM topic),
direct AS (SELECT subject, bibcode FROM said WHERE in_title UNION ALL SELECT subject, bibcode FROM topic),
one AS (SELECT subject, rec.* FROM direct JOIN rec USING (bibcode) QUALIFY row_number() OVER (PARTITION BY subject ORDER BY cites DESC, ordinal) <= 30),
want AS (SELECT DISTINCT 'd' || doc_id AS subject, CAST(doc_id + 1 AS VARCHAR) AS bibcode FROM labels WHERE quality = 1 AND 'd' || doc_id IN (SELECT subject FROM one)),
found AS (
  SELECT one.subject, 0 AS stage, CASE WHEN want.bibcode IS NOT NULL AND NOT relevant THEN 'manual' ELSE 'query' END AS via, one.bibcode, relevant OR want.bibcode IS NOT NULL AS relevant
  FROM one LEFT JOIN want ON one.subject = want.subject AND one.bibcode = want.bibcode
  UNION ALL
  SELECT want.subject, 1, 'manual', want.bibcode, true FROM want JOIN rec USING (bibcode) WHERE (want.subject, want.bibcode) NOT IN (SELECT (subject, bibcode) FROM one)
),
p AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
e AS (SELECT DISTINCT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM (SELECT lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS src, l_partkey AS dst FROM p) WHERE src IS NOT NULL),
core AS (SELECT DISTINCT subject, bibcode FROM found WHERE relevant),
hop AS (SELECT subject, dst AS bibcode, 0 AS r FROM e JOIN core ON src = bibcode UNION ALL SELECT subject, src, 1 FROM e JOIN core ON dst = bibcode),
fresh AS (SELECT subject, bibcode, min(r) AS r FROM hop GROUP BY ALL HAVING (subject, bibcode) NOT IN (SELECT (subject, bibcode) FROM found) AND (subject, bibcode) IN (SELECT (subject, bibcode) FROM anchor)),
gone AS (SELECT DISTINCT 'd' || src AS subject, dst AS bibcode FROM e WHERE dst IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1))
SELECT subject, stage, via, bibcode, relevant, 'accepted' AS gate FROM found
UNION ALL
SELECT f.subject, 3, CASE r WHEN 0 THEN 'chain:references' ELSE 'chain:citations' END, f.bibcode, true,
       CASE WHEN f.subject LIKE 't%' OR coalesce(a.in_title, false) THEN 'accepted' WHEN gone.bibcode IS NOT NULL THEN 'suppressed' ELSE 'pending' END
FROM fresh f JOIN rec ON rec.bibcode = f.bibcode LEFT JOIN said a ON a.subject = f.subject AND a.bibcode = f.bibcode LEFT JOIN gone ON gone.subject = f.subject AND gone.bibcode = f.bibcode
WHERE rec.relevant"""


@query(_STAGES)
def staged_discovery(spark, sf_dir):
    """Every row that the stages find for every subject, with the gate's verdict."""
    return _discovered(spark, sf_dir).rows.select("subject", "stage", "via", "bibcode", "relevant", "gate")
