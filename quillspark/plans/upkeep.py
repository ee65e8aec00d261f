"""Queries over what keeps a vault in order: renames, verification against history, contradicting values, benchmark pairs, and notes as files."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import audit, claims, ledger, ranks, render, renames, steps
from quillspark.operators import notes as N
from quillspark.plans.registry import _FACETS, classified, query, table
from quillspark.plans.vault import VAULT, vault
from quillspark.sources import files
from quillspark.sources.keyed import KeyedStore
from quillspark.sources.store import new_path
from quillspark.sources.vaultfs import read_vault, write_vault

_MOVES = VAULT + """,
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS t FROM labels GROUP BY doc_id),
gone AS (SELECT stem FROM n JOIN l USING (doc_id) WHERE t = 1),
named AS (SELECT stem, CASE WHEN q = 1 THEN 'last' || doc_id ELSE 'next' || doc_id END AS new FROM n JOIN l USING (doc_id)),
good AS (SELECT * FROM named WHERE stem NOT IN (SELECT stem FROM gone))
"""


@query(_MOVES + """
SELECT coalesce(g.new, n.stem) AS stem, n.stem AS old_stem, md5(replace(replace(replace(replace(n.text, '[[' || n.one || ']', '[[' || coalesce(a.new, n.one) || ']'), '[[' || n.one || '|', '[[' || coalesce(a.new, n.one) || '|'),
       '[[' || n.two || ']', '[[' || coalesce(b.new, n.two) || ']'), '[[' || n.two || '|', '[[' || coalesce(b.new, n.two) || '|')) AS text, NULL AS what, NULL AS target
FROM n LEFT JOIN good g ON g.stem = n.stem LEFT JOIN good a ON a.stem = n.one LEFT JOIN good b ON b.stem = n.two WHERE n.stem NOT IN (SELECT stem FROM gone)
UNION ALL SELECT DISTINCT stem, NULL, NULL, 'dangling', t FROM (SELECT stem, unnest([one, two]) AS t FROM n) WHERE t IN (SELECT stem FROM gone) AND stem NOT IN (SELECT stem FROM gone)""")
def rename_notes(spark, sf_dir):
    """The vault after labelled notes are renamed, good ones twice, and toxic ones deleted; and what is left dangling."""
    n = vault(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("q"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("t"))
    held = n.select("doc_id", "stem").join(labels, "doc_id")
    name = lambda word: F.concat(F.lit(word), F.col("doc_id").cast("string"))
    moves = held.select(F.col("stem").alias("old"), name("next").alias("new")).unionByName(held.where("q = 1").select(name("next").alias("old"), name("last").alias("new")))
    out = renames.applied(n.select("stem", "text"), moves, held.where("t = 1").select("stem"))
    none = F.lit(None).cast("string")
    return out.notes.select("stem", "old_stem", F.md5("text").alias("text"), none.alias("what"), none.alias("target")).unionByName(out.report.select("stem", none.alias("old_stem"), none.alias("text"), "what", "target"))


@query(VAULT + """,
v AS (SELECT stem, doc_id, CAST('2024-0' || CAST(doc_id % 9 + 1 AS VARCHAR) || '-11' AS DATE) AS verified FROM n WHERE doc_id % 4 = 0),
c AS (SELECT client_id AS doc_id, CAST(valid_at AS DATE) AS d FROM client_changes WHERE valid_at IS NOT NULL UNION ALL SELECT DISTINCT client_id, DATE '2024-06-01' FROM client_changes WHERE op = 'D' AND client_id IN (SELECT doc_id FROM n))
SELECT stem, CAST(verified AS VARCHAR) AS verified, count(d) FILTER (WHERE d <= verified) AS n_before, count(d) FILTER (WHERE d > verified) AS n_after, CAST(max(d) FILTER (WHERE d <= verified) AS VARCHAR) AS last_before
FROM v LEFT JOIN c USING (doc_id) GROUP BY stem, verified""")
def verification_history(spark, sf_dir):
    """Every dated verification against a log of changes of the notes; notes of clients that were deleted have uncommitted changes."""
    n = vault(spark, sf_dir)
    stems = n.select(F.col("doc_id").alias("client_id"), "stem")
    changes = table(spark, sf_dir, "client_changes").select("client_id", F.col("valid_at").alias("changed_on"), "op").join(stems, "client_id")
    out = audit.verified_since(n, changes.select("stem", "changed_on"), changes.where("op = 'D'").select("stem"), F.lit("2024-06-01"))
    return out.select("stem", F.col("verified").cast("string").alias("verified"), "n_before", "n_after", F.col("last_before").cast("string").alias("last_before"))


@query("""
WITH c AS (SELECT doc_id, source AS entity, lang AS parameter, doc_id // 3 AS record, n_chars - doc_id % 50 AS low, n_chars + doc_id % 70 AS high FROM documents)
SELECT a.doc_id, count(b.doc_id) AS n_apart FROM c a LEFT JOIN c b ON a.entity = b.entity AND a.parameter = b.parameter AND a.record <> b.record AND (b.high < a.low OR b.low > a.high) GROUP BY a.doc_id""")
def contradicting_values(spark, sf_dir):
    """For every document's length, taken as a value, how many other records' values can't be true with it."""
    i = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("entity"), F.col("lang").alias("parameter"), F.floor(i / 3).alias("bibcode"), (F.col("n_chars") - i % 50).alias("low"), (F.col("n_chars") + i % 70).alias("high"))
    return claims.contradicting(rows).select("doc_id", "n_apart")


@query("SELECT doc_id, row_number() OVER (ORDER BY source NULLS FIRST, n_chars DESC, doc_id) - 1 AS n FROM documents")
def numbered_rows(spark, sf_dir):
    """Every document's number by source and falling length."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return ranks.numbered(rows, "source", F.col("n_chars").desc(), "doc_id").select("doc_id", "n")


@query("""
WITH r AS (SELECT item_id, CAST(item_id AS VARCHAR) AS k, item_id // 7 AS note, item_id // 3 AS line, text FROM benchmark),
ring AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT k FROM r)),
m AS (SELECT r.*, x.k AS other, (x.i - o.i + o.n) % o.n AS dist, CASE WHEN EXISTS (SELECT 1 FROM r z WHERE z.note = r.note AND z.k = x.k) THEN 1 ELSE 0 END AS tier
  FROM r JOIN ring o ON o.k = r.k JOIN ring x ON x.k <> r.k WHERE NOT EXISTS (SELECT 1 FROM r z WHERE z.note = r.note AND z.line = r.line AND z.k = x.k)),
b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY tier, dist) AS q FROM m),
p AS (SELECT printf('r%03d', item_id) AS id, 'real' AS label, k AS bibcode, text FROM r UNION ALL SELECT printf('s%03d', item_id), 'seeded', other, text FROM b WHERE q = 1)
SELECT id, label, bibcode, md5(text) AS claim, row_number() OVER (ORDER BY sha1(id || '|' || text), id) - 1 AS place FROM p""")
def claim_benchmark(spark, sf_dir):
    """Real and seeded pairs of all benchmark items with their ids, and each one's place in the shuffled order."""
    item = F.col("item_id")
    real = table(spark, sf_dir, "benchmark").select(item.alias("ordinal"), F.floor(item / 7).cast("string").alias("note"), F.floor(item / 3).alias("line"), F.col("text").alias("claim"), item.cast("string").alias("bibcode"))
    rows = claims.benchmark(real, claims.seed(real)).withColumn("key", claims.shuffle_key(F.col("id"), F.col("claim")))
    return ranks.numbered(rows, "key", "id", name="place").select("id", "label", "bibcode", F.md5("claim").alias("claim"), "place")


@query(VAULT + """
SELECT path, kind, CASE WHEN doc_id % 5 = 0 THEN 'T' || doc_id || ' it''s' ELSE 'T' || doc_id END AS title, CASE WHEN doc_id % 11 = 3 THEN 'invalid' ELSE 'ok' END AS status, doc_id % 7 = 2 AS retracted, CASE WHEN doc_id % 11 = 3 THEN NULL ELSE n_chars END AS citations
FROM (SELECT *, substr(path, 3) AS p FROM n)""".replace("doc_id % 7 = 2 AS retracted", "CASE WHEN doc_id % 11 = 3 THEN NULL ELSE doc_id % 7 = 2 END AS retracted").replace("CASE WHEN doc_id % 5 = 0 THEN", "CASE WHEN doc_id % 11 = 3 THEN NULL WHEN doc_id % 5 = 0 THEN"))
def vault_round_trip(spark, sf_dir):
    """Notes with rendered heads, some broken, written as files, read back by the vault source and parsed."""
    n = vault(spark, sf_dir)
    i = F.col("doc_id")
    title = F.when(i % 5 == 0, F.concat("fm.title", F.lit(" it's"))).otherwise(F.col("fm.title"))
    fields = {"title": render.scalar(title), "tags": F.lit("[x]"), "citations": F.when(i % 11 == 3, "{broken: [").otherwise(F.col("fm.citations").cast("string")), "retracted": (i % 7 == 2).cast("string")}
    path = new_path(spark, "notes")
    write_vault(n.select(F.substr("path", F.lit(3)).alias("path"), F.concat(render.head(fields), "text").alias("text")), path)
    held = N.parse_heads(read_vault(spark, path).withColumn("path", F.concat(F.lit("v/"), "path")))
    return held.select("path", N.note_kind(F.col("path")).alias("kind"), "fm.title", F.substring_index("fm_status", ":", 1).alias("status"), "fm.retracted", "fm.citations")


@query("SELECT DISTINCT click_id, client_id FROM clicks WHERE click_id IS NOT NULL")
def keyed_stream(spark, sf_dir):
    """Clicks as a stream into a store by click_id: copies count once, and a restart or a repeat adds nothing."""
    where = f"{sf_dir}/clicks.parquet"
    schema = spark.read.parquet(where).schema
    store = KeyedStore(spark, new_path(spark, "clicks"), "click_id", buckets=8)
    arriving = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(f"{sf_dir}/click[s].parquet").select("click_id", "client_id")
    state = new_path(spark, "clicks-state")
    store.ingest(arriving(), "clicks", state)
    store.ingest(arriving(), "clicks", state)  # nothing has arrived since
    store.append(spark.read.parquet(where).select("click_id", "client_id"), "by-hand")
    return store.rows()


@query(_FACETS + """, k AS (SELECT lang AS slug, count(*) AS n_total, count(*) FILTER (WHERE why IS NULL) AS n_core FROM c GROUP BY lang),
z AS (SELECT * FROM (VALUES (0, 'discover', 'done', 0), (1, 'guard', 'failed', 3), (2, 'discover', 'skipped', 0), (3, 'guard', 'done', 0), (4, 'log', 'done', 0), (5, 'discover', 'skipped', 0), (6, 'guard', 'skipped', 0), (7, 'log', 'skipped', 0)) AS t(place, step, status, code))
SELECT slug, n_total, n_core, place, step, status, code FROM k, z""")
def resumable_steps(spark, sf_dir):
    """A chain that writes a run and its log, stopped by its guard, resumed, and run again without a change; all langs' counts beside it."""
    out, path = new_path(spark, "steps"), f"{sf_dir}/documents.parquet"
    book = steps.Ledger(spark, f"{out}/ledger")

    def discover(_: str) -> None:
        files.write_run(classified(spark, sf_dir).select("slug", "bibcode", "relevant", "via"), f"{out}/run")

    def log(_: str) -> None:
        rows = spark.read.parquet(f"{out}/run")
        counts = ledger.run_counts(rows, rows.where("false"), rows.where("false"))
        files.write_search_log(counts, f"{out}/log")

    def chain(yes: bool) -> list[steps.Step]:
        return [steps.Step("discover", discover, (path,)), steps.Step("guard", lambda _: steps.OK if yes else steps.STOPPED, (path,)), steps.Step("log", log, (path,))]

    for yes in (False, True, True):
        book.run("all", chain(yes))
    counts = spark.read.parquet(f"{out}/log").select("slug", "n_total", "n_core")
    done = ranks.numbered(book.rows(), "at", "place", name="n").select(F.col("n").cast("int").alias("place"), "step", "status", "code")
    return counts.crossJoin(F.broadcast(done))  # eight rows
