"""Named queries over the supplied tables, and the SQL that says the same.

The tables stand in for the engine's own: a document is a record (title: its first line, kind: its source, keyword:
its language, citations: its length), labels are curated keys and decisions, parts that follow each other in an
order are citations, and columns of lineitem are orbits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillspark.config import Lens
from quillspark.functions import text as X
from quillspark.operators import audit, claims, classify, discover, fetch, layout, ledger, notes, retract, truth

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LENS = Lens({"article": "the", "license": "licen[sc]e", "german": "d(er|ie|as) "}, noise_doctypes=("src3", "src7"))
STRICT = Lens({"article": "the", "license": "licen[sc]e", "german": "d(er|ie|as) "}, require=("article",), min_topics=2, noise_doctypes=("src3", "src7"))


def query(sql: str | None = None):
    """Register a function under its name, with its SQL twin."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("lang").alias("slug"), F.col("doc_id").alias("ordinal"), F.col("doc_id").cast("string").alias("bibcode"), F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"), F.col("source").alias("doctype"), F.col("n_chars").alias("citation_count"), F.array("lang").alias("keyword"), F.lit("query").alias("via"),
    )


def classified(spark: SparkSession, sf_dir: str, lens: Lens = LENS) -> DataFrame:
    return classify.classify(records(spark, sf_dir), lens)


#: Common heads of the SQL twins.
_FACETS = """
WITH r AS (
  SELECT *, lower(concat_ws(' ', nullif(split_part(text, chr(10), 1), ''), nullif(text, ''), nullif(lang, ''))) AS h FROM documents
), f AS (
  SELECT *, regexp_matches(h, 'the') AS a, regexp_matches(h, 'licen[sc]e') AS l, regexp_matches(h, 'd(er|ie|as) ') AS g FROM r
), t AS (
  SELECT *, concat_ws(',', CASE WHEN a THEN 'article' END, CASE WHEN l THEN 'license' END, CASE WHEN g THEN 'german' END) AS topics,
         CAST(a AS INT) + CAST(l AS INT) + CAST(g AS INT) AS n FROM f
), c AS (
  SELECT *, CASE WHEN n = 0 THEN 'no topic matches' WHEN source IN ('src3', 'src7') THEN 'noise doctype: ' || source END AS why,
         CASE WHEN n = 0 THEN 'no topic matches' WHEN source IN ('src3', 'src7') THEN 'noise doctype: ' || source
              WHEN NOT a THEN 'missing required: article' WHEN n < 2 THEN 'fewer than 2 topics' END AS strict
  FROM t
)"""


@query(_FACETS + " SELECT doc_id, topics, CAST(n AS INTEGER) AS n_topics, why IS NULL AS relevant FROM c")
def facet_classify(spark, sf_dir):
    return classified(spark, sf_dir).select(F.col("ordinal").alias("doc_id"), F.array_join("topics", ",").alias("topics"), F.size("topics").alias("n_topics"), "relevant")


@query(_FACETS + " SELECT doc_id, strict AS why_excluded FROM c")
def exclusion_reason(spark, sf_dir):
    return classified(spark, sf_dir, STRICT).select(F.col("ordinal").alias("doc_id"), "why_excluded")


@query(_FACETS + """, k AS (
  SELECT count(*) FILTER (WHERE ok) AS base, count(*) FILTER (WHERE ok AND a) AS a, count(*) FILTER (WHERE ok AND l) AS l, count(*) FILTER (WHERE ok AND g) AS g
  FROM (SELECT *, why IS NULL AS ok FROM c)
)
SELECT rule, n_core, round(100 * (base - n_core) / CAST(greatest(base, 1) AS DOUBLE), 4) AS drop_pct FROM (
  SELECT 'any facet' AS rule, base AS n_core, base FROM k UNION ALL SELECT 'require article', a, base FROM k
  UNION ALL SELECT 'require license', l, base FROM k UNION ALL SELECT 'require german', g, base FROM k)""")
def combination_contrast(spark, sf_dir):
    return classify.combination_contrast(classified(spark, sf_dir), LENS)


@query(_FACETS + " SELECT doc_id, n_chars AS citations, why AS why_excluded FROM c WHERE why IS NOT NULL ORDER BY n_chars DESC, doc_id LIMIT 10")
def excluded_top10(spark, sf_dir):
    return classify.excluded_top(classified(spark, sf_dir)).select(F.col("ordinal").alias("doc_id"), F.col("citation_count").alias("citations"), "why_excluded")


@query(_FACETS + """, o AS (SELECT * FROM c WHERE why IS NOT NULL ORDER BY n_chars DESC, doc_id LIMIT 25)
SELECT doc_id, why IS NULL AS relevant FROM c WHERE why IS NULL UNION ALL SELECT doc_id, false FROM o""")
def probe(spark, sf_dir):
    return classify.probe(classified(spark, sf_dir)).select(F.col("ordinal").alias("doc_id"), "relevant")


@query(_FACETS + """, x AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS m FROM labels GROUP BY doc_id)
SELECT lang AS slug, CASE WHEN why IS NULL AND strict IS NOT NULL THEN 'leaves' WHEN why IS NOT NULL AND strict IS NULL THEN 'enters'
       WHEN strict IS NULL THEN 'stays' ELSE 'out' END AS transition,
       CASE WHEN m IS NULL THEN 'none' WHEN m > 0 THEN 'extracted' ELSE 'stub' END AS note_state, 'query' AS via, count(*) AS n
FROM c LEFT JOIN x USING (doc_id) GROUP BY ALL""")
def reclass_diff(spark, sf_dir):
    note = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("n_methods")).select(F.col("doc_id").cast("string").alias("bibcode"), "n_methods")
    return classify.reclass_diff(classified(spark, sf_dir), classify.reclassify(records(spark, sf_dir), STRICT), note)


@query(r"""
WITH n AS (SELECT doc_id, text, len(regexp_replace(text, '[\s\x{a0}\x{85}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x1c-\x1f]', '', 'g')) AS n,
                  len(regexp_replace(text, '[^!-~]', '', 'g')) AS a, len(text) - len(replace(text, chr(12), '')) AS f FROM documents)
SELECT doc_id, CASE WHEN n < 200 THEN 'almost empty' WHEN f >= 2 AND n / CAST(f AS DOUBLE) < 200 THEN 'watermark'
                    WHEN a / CAST(n AS DOUBLE) < 0.85 THEN 'mojibake' ELSE 'ok' END AS verdict FROM n""")
def legibility(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.verdict_of_text(F.col("text")).alias("verdict"))


@query(r"""
WITH l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS s FROM documents),
u AS (SELECT lang, doc_id, count(*) AS n FROM l WHERE len(regexp_replace(s, '^\s+|\s+$', '', 'g')) >= 40 GROUP BY ALL)
SELECT lang AS slug, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_useful FROM u GROUP BY ROLLUP (lang)""")
def useful_lines(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("slug"), F.col("doc_id").alias("stem"), "text")
    return layout.metrics(d).select("slug", "n_files", "n_useful")


@query("SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text")
def first_wins_dedup(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("key", F.sha2("text", 256))
    first = discover.first_wins(d.select("key", "doc_id"), ["key"], "doc_id")
    return first.join(d.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key").select("doc_id", "n")


@query("SELECT doc_id, sha1(CAST(doc_id AS VARCHAR) || '|' || split_part(text, chr(10), 1)) AS place FROM documents")
def deterministic_shuffle(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    key = claims.shuffle_key(F.col("doc_id").cast("string"), F.substring_index("text", "\n", 1))
    return d.select("doc_id", key.alias("place")).orderBy("place")


@query(_FACETS + """, x AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1)
SELECT doc_id, why IS NULL OR x.doc_id IS NOT NULL AS relevant, CASE WHEN x.doc_id IS NOT NULL AND why IS NOT NULL THEN 'manual' ELSE 'query' END AS via
FROM c LEFT JOIN x USING (doc_id) WHERE lang <> 'fr' OR x.doc_id IS NOT NULL""".replace("'manual' ELSE", "'manual' WHEN lang = 'fr' THEN 'manual' ELSE"))
def curated_override(spark, sf_dir):
    every = classified(spark, sf_dir)
    stored = every.where("slug <> 'fr'")  # the run of three subjects; curated keys of the fourth have to be fetched
    extra = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").cast("string").alias("bibcode"))
    out, _ = discover.override(stored, extra, every)
    return out.select(F.col("ordinal").alias("doc_id"), "relevant", "via")


@query("""
WITH d AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id)
SELECT doc_id, coalesce(toxic = 1, false) AS suppressed FROM documents LEFT JOIN d USING (doc_id)""")
def decision_antijoin(spark, sf_dir):
    decided = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).select(F.col("doc_id").alias("bibcode"), F.when(F.col("toxic") == 1, "discarded").otherwise("kept").alias("decision"))
    out = ledger.suppressed(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("bibcode")), decided)
    return out.select(F.col("bibcode").alias("doc_id"), "suppressed")


def part_edges(spark, sf_dir) -> DataFrame:
    """Parts that follow each other in an order, as src cites dst."""
    parts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()
    before = F.lag("l_partkey").over(Window.partitionBy("l_orderkey").orderBy("l_partkey"))
    return parts.select(before.alias("src"), F.col("l_partkey").alias("dst")).where("src is not null").distinct()


_CHAIN = """
WITH p AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
e AS (SELECT DISTINCT src, dst FROM (SELECT lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS src, l_partkey AS dst FROM p) WHERE src IS NOT NULL),
core AS (SELECT p_partkey AS k FROM part WHERE p_size <= 1),
hop AS (SELECT dst AS bibcode, 0 AS r FROM e JOIN core ON src = k UNION ALL SELECT src, 1 FROM e JOIN core ON dst = k),
best AS (SELECT bibcode, min(r) AS r FROM hop WHERE bibcode NOT IN (SELECT k FROM core) GROUP BY bibcode)"""


@query(_CHAIN + " SELECT bibcode, CASE r WHEN 0 THEN 'chain:references' ELSE 'chain:citations' END AS via FROM best")
def chain_expand(spark, sf_dir):
    core = table(spark, sf_dir, "part").where("p_size <= 1").select(F.col("p_partkey").alias("bibcode"))
    return discover.chain(core, part_edges(spark, sf_dir)).select("bibcode", "via")


@query(_CHAIN + """
SELECT bibcode, CASE r WHEN 0 THEN 'chain:references' ELSE 'chain:citations' END AS via,
       CASE WHEN contains(lower(p_name), 'part 1') THEN 'accepted' WHEN p_size > 40 THEN 'suppressed' ELSE 'pending' END AS gate
FROM best JOIN part ON bibcode = p_partkey""")
def chain_gate(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    found = chain_expand(spark, sf_dir).join(part.select(F.col("p_partkey").alias("bibcode"), F.col("p_name").alias("title")), "bibcode")
    dropped = part.where("p_size > 40").select(F.col("p_partkey").alias("bibcode"), F.lit("discarded").alias("decision"))
    return discover.gate(found, ["part 1"], dropped).select("bibcode", "via", "gate")


@query(_FACETS + """, l AS (SELECT DISTINCT doc_id FROM labels), k AS (
  SELECT lang AS slug, count(*) AS n_core, count(l.doc_id) AS n_known FROM c LEFT JOIN l USING (doc_id) WHERE why IS NULL GROUP BY lang)
SELECT slug, n_core, n_known, n_core - n_known AS n_new, n_known > 0 AND n_core - n_known >= 50 AND n_core >= 1.5 * n_known AS stop FROM k""")
def expansion_guard(spark, sf_dir):
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("bibcode"))
    return ledger.guard(classified(spark, sf_dir), known).select("slug", "n_core", "n_known", "n_new", "stop")


@query(_FACETS + """, l AS (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id)
SELECT lang AS slug, count(*) AS n_total, count(*) FILTER (WHERE why IS NULL) AS n_core, count(*) FILTER (WHERE why IS NOT NULL) AS n_candidates,
       count(*) FILTER (WHERE toxic = 1) AS n_dropped FROM c LEFT JOIN l USING (doc_id) GROUP BY lang""")
def run_counters(spark, sf_dir):
    rows = classified(spark, sf_dir)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("ordinal")).distinct()
    return ledger.run_counts(rows, rows.where("not relevant"), rows.join(toxic, "ordinal", "left_semi"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def dangling_refs(spark, sf_dir):
    found = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("bibcode"), "o_orderkey")
    return ledger.unknown_keys(found, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("bibcode"))).select("o_orderkey")


@query("""
WITH live AS (SELECT lang AS slug, count(*) AS n FROM documents WHERE lang <> 'fr' GROUP BY lang),
old AS (SELECT lang AS slug, count(*) AS n FROM documents JOIN (SELECT DISTINCT doc_id FROM labels) USING (doc_id) GROUP BY lang)
SELECT slug, n FROM live UNION ALL SELECT slug, n FROM old WHERE slug NOT IN (SELECT slug FROM live)""")
def ledger_fallback(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    count = lambda rows: rows.groupBy(F.col("lang").alias("slug")).agg(F.count(F.lit(1)).alias("n"))
    live = count(d.where("lang <> 'fr'"))  # one subject has no live run, only its ledger
    return ledger.fallback(live, count(d.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id")))


@query("""
WITH l AS (SELECT doc_id, 'old' AS decision, 0 AS p FROM labels WHERE quality = 1 UNION SELECT doc_id, 'new', 1 FROM labels WHERE toxic = 1)
SELECT CAST(doc_id AS VARCHAR) AS bibcode, arg_max(decision, p) AS decision FROM l GROUP BY doc_id""")
def ledger_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "labels")
    side = lambda test, name: rows.where(test).select(F.lit("all").alias("slug"), F.col("doc_id").cast("string").alias("bibcode"), F.lit(name).alias("decision")).distinct()
    return ledger.merged_decisions(side("quality = 1", "old"), side("toxic = 1", "new")).select("bibcode", "decision")


_ORBIT = """
WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS k, l_extendedprice / 100 AS p, l_discount AS e, 1 + l_tax AS star,
                  l_quantity * 40.0::DOUBLE AS msini, l_extendedprice / 50.0::DOUBLE AS best FROM lineitem),
c AS (SELECT *, CASE WHEN k > 0 AND p > 0 AND star > 0 THEN
        k * pow(star * 1.989e30, 2.0 / 3.0) * pow(p * 86400.0 / (2 * pi() * 6.674e-11), 1.0 / 3.0) * sqrt(1 - pow(CASE WHEN e >= 0 AND e < 1 THEN e ELSE 0 END, 2)) / 5.972e24 END AS chk FROM o)"""


def orbits(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("k"), (F.col("l_extendedprice") / 100).alias("p"), F.col("l_discount").alias("e"), (1 + F.col("l_tax")).alias("star"), (F.col("l_quantity") * 40.0).alias("msini"), (F.col("l_extendedprice") / 50.0).alias("best"))
    return rows.withColumn("chk", truth.msini_earth(F.col("k"), F.col("p"), F.col("e"), F.col("star")))


@query(_ORBIT + " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(chk, 4) AS msini, NOT (msini / chk > 1.0 / 3.0 AND msini / chk < 3) AS odd FROM c")
def mass_check(spark, sf_dir):
    return orbits(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round("chk", 4).alias("msini"), truth.outside_band(F.col("msini"), F.col("chk")).alias("odd"))


@query(_ORBIT + """, s AS (SELECT *, CASE WHEN abs(ln(msini / chk)) <= abs(ln(best / chk)) THEN 'msini' ELSE 'bmass' END AS source FROM c), m AS (
  SELECT *, CASE source WHEN 'msini' THEN msini ELSE best END AS mass FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, source, round(mass, 4) AS mass,
       CASE WHEN NOT (mass / chk > 1.0 / 3.0 AND mass / chk < 3) THEN 'no reported mass fits the orbit' END AS flag FROM m""")
def mass_choice(spark, sf_dir):
    rows = orbits(spark, sf_dir).withColumn("c", truth.mass_choice(F.col("msini"), F.col("best"), F.col("chk")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c.source", F.round("c.mass", 4).alias("mass"), "c.flag")


@query(r"""
WITH d AS (SELECT doc_id, replace(replace(replace(replace(text, chr(10) || 'Licensed', chr(10) || '```' || chr(10) || 'Licensed'), chr(10) || 'Of.', chr(10) || '- Of.'), chr(10) || 'And ornd.', chr(10) || '> And ornd.'), chr(10) || 'Released', chr(10) || '| Released') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM d),
t AS (SELECT doc_id, line, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS s FROM l),
s AS (SELECT *, sum(CASE WHEN s LIKE '```%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS fences FROM t),
f AS (SELECT *, s LIKE '```%' OR fences % 2 = 1 OR s = '' OR s LIKE '>%' OR s LIKE '#%' AS out, s LIKE '|%' AS tbl, regexp_matches(s, '^([-*] |[0-9]+\.\s)') AS bul FROM s),
b AS (SELECT *, lag(NOT out AND NOT tbl, 1, false) OVER (PARTITION BY doc_id ORDER BY line) AS open FROM f),
g AS (SELECT *, sum(CASE WHEN NOT out AND (tbl OR bul OR NOT open) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line) AS n FROM b)
SELECT doc_id, CAST(min(line) AS INTEGER) AS line, count(*) AS n_lines, md5(string_agg(s, ' ' ORDER BY line)) AS block FROM g WHERE NOT out GROUP BY doc_id, n""")
def claim_blocks(spark, sf_dir):
    marked = F.col("text")
    for line, mark in (("Licensed", "```\n"), ("Of.", "- "), ("And ornd.", "> "), ("Released", "| ")):  # some lines open or close a fence, or are bullets, quotes and table rows
        marked = F.replace(marked, F.lit(f"\n{line}"), F.lit(f"\n{mark}{line}"))
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("stem"), marked.alias("text"))
    return claims.blocks(d).select(F.col("stem").alias("doc_id"), "line", "n_lines", F.md5("block").alias("block"))


@query("""
WITH r AS (SELECT item_id, CAST(item_id AS VARCHAR) AS k, item_id // 7 AS note, item_id // 3 AS line FROM benchmark),
ring AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT k FROM r)),
m AS (
  SELECT r.item_id, r.k AS own, x.k AS other, (x.i - o.i + o.n) % o.n AS dist,
         CASE WHEN EXISTS (SELECT 1 FROM r z WHERE z.note = r.note AND z.k = x.k) THEN 1 ELSE 0 END AS tier
  FROM r JOIN ring o ON o.k = r.k JOIN ring x ON x.k <> r.k
  WHERE NOT EXISTS (SELECT 1 FROM r z WHERE z.note = r.note AND z.line = r.line AND z.k = x.k)),
b AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY tier, dist) AS q FROM m)
SELECT item_id, other AS bibcode, tier FROM b WHERE q = 1""")
def ring_rotation(spark, sf_dir):
    item = F.col("item_id")
    real = table(spark, sf_dir, "benchmark").select(item.alias("ordinal"), F.floor(item / 7).cast("string").alias("note"), F.floor(item / 3).alias("line"), F.col("text").alias("claim"), item.cast("string").alias("bibcode"))
    return claims.seed(real).select(F.col("ordinal").alias("item_id"), "bibcode", "tier")


@query("""
WITH j AS (SELECT CASE WHEN quality = 1 THEN 'real' ELSE 'seeded' END AS label, CASE WHEN toxic = 1 THEN 'unsupported' WHEN doc_id % 5 = 0 THEN 'unverifiable' ELSE 'supported' END AS v FROM labels),
k AS (SELECT count(*) FILTER (WHERE label = 'seeded') AS seeded, count(*) FILTER (WHERE label = 'seeded' AND v = 'unsupported') AS caught,
             count(*) FILTER (WHERE label = 'seeded' AND v = 'supported') AS slipped, count(*) FILTER (WHERE label = 'real') AS "real",
             count(*) FILTER (WHERE label = 'real' AND v = 'unsupported') AS real_caught FROM j)
SELECT seeded, caught, slipped, "real", "real" - real_caught AS consistent, round(CAST(caught AS DOUBLE) / seeded, 6) AS recall, round(CAST("real" - real_caught AS DOUBLE) / "real", 6) AS control FROM k""")
def score_verdicts(spark, sf_dir):
    verdict = F.when(F.col("toxic") == 1, "unsupported").when(F.col("doc_id") % 5 == 0, "unverifiable").otherwise("supported")
    rows = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "real").otherwise("seeded").alias("label"), verdict.alias("verdict"))
    return claims.score(rows).select("seeded", "caught", "slipped", "real", "consistent", "recall", "control")


@query(r"""
WITH a AS (SELECT page_id, html, regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', '', 'g') AS x FROM pages),
b AS (SELECT *, regexp_replace(x, '(?is)<style\b[^>]*>.*?</style>', '', 'g') AS y FROM a)
SELECT page_id, md5(regexp_replace(regexp_replace(y, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') || chr(10)) AS text,
       CAST(len(regexp_extract_all(html, '(?is)<script\b[^>]*>.*?</script>')) + len(regexp_extract_all(x, '(?is)<style\b[^>]*>.*?</style>')) AS INTEGER) AS removed FROM b""")
def markup_clean(spark, sf_dir):
    text, removed = X.clean_markup(F.col("html"), ("script", "style"), ())
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text).alias("text"), removed.alias("removed"))


@query("""
WITH d AS (SELECT text, doc_id, CASE doc_id % 3 WHEN 0 THEN 'ocr' WHEN 1 THEN 'web' ELSE 'pdftotext' END AS p FROM documents)
SELECT min(doc_id) AS any_id, arg_min(doc_id, (CASE p WHEN 'ocr' THEN 1 ELSE 0 END, lpad(CAST(doc_id AS VARCHAR), 12, '0'))) AS chosen FROM d GROUP BY text""")
def quality_arbitration(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("stem"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.when(F.col("doc_id") % 3 == 0, "ocr").when(F.col("doc_id") % 3 == 1, "web").otherwise("pdftotext").alias("provenance"))
    low = d.groupBy("stem").agg(F.min("path").cast("bigint").alias("any_id"))
    return notes.best_text(d).join(low, "stem").select("any_id", F.col("path").cast("bigint").alias("chosen"))


@query(r"""
WITH v AS (SELECT len(regexp_replace(text, '\s', '', 'g')) AS n, len(regexp_replace(text, '[^!-~]', '', 'g')) AS a FROM documents),
i AS (SELECT 'illegible_text' AS category, 'backlog' AS severity, count(*) AS n FROM v WHERE n < 200 OR a / CAST(n AS DOUBLE) < 0.85),
r AS (SELECT 'retracted' AS category, 'block' AS severity, count(*) AS n FROM documents WHERE regexp_matches(lower(split_part(text, chr(10), 1)), '^\s*(retracted|retraction:|withdrawn)')),
k AS (SELECT 'implementation_leak' AS category, 'warn' AS severity, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS s FROM documents) WHERE contains(s, 'AKIA') OR contains(s, 'password=')),
t AS (SELECT 'pending_triage' AS category, 'backlog' AS severity, count(DISTINCT source) AS n FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT * FROM i WHERE n > 0 UNION ALL SELECT * FROM r WHERE n > 0 UNION ALL SELECT * FROM k WHERE n > 0 UNION ALL SELECT * FROM t WHERE n > 0""")
def audit_findings(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    illegible = audit.illegible_texts(d.select(F.col("doc_id").alias("stem"), "text"))
    title = X.title_says_retracted(F.substring_index("text", "\n", 1))
    taken_back = audit.found(d.where(title), "retracted", "doc_id", F.lit("by title"))
    leaks = audit.implementation_leaks(d.select(F.col("doc_id").cast("string").alias("stem"), "text"), ((r"AKIA|password=", "a secret"),))
    toxic = d.join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id")
    waiting = audit.triage(toxic.groupBy(F.col("source").alias("slug")).agg(F.count(F.lit(1)).alias("n")))
    return audit.report(illegible.unionByName(taken_back).unionByName(leaks).unionByName(waiting))


@query("""
WITH u AS (SELECT doc_id, toxic, quality FROM labels)
SELECT CAST(d.doc_id AS VARCHAR) AS doi, coalesce(bool_or(toxic = 1), false) OR regexp_matches(lower(any_value(d.text)), '^(retracted|withdrawn)') AS retracted,
       CAST(count(u.doc_id) FILTER (WHERE quality = 0) AS INTEGER) AS n_corrections
FROM documents d LEFT JOIN u USING (doc_id) GROUP BY d.doc_id""")
def retraction_check(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doi"), "toxic", "quality")
    both = rows.where("toxic = 1").select("doi", F.lit(0).alias("pos"), F.lit("Retraction").alias("type")).unionByName(rows.where("quality = 0").select("doi", F.lit(1).alias("pos"), F.lit("erratum").alias("type")))
    updates = both.select("doi", "pos", "type", F.lit(None).cast("string").alias("notice_doi"), F.array(F.lit(2021), F.lit(5)).alias("date_parts"), F.lit("registry").alias("source"))
    held = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doi"), F.col("doc_id").cast("string").alias("bibcode"), F.substring_index("text", "\n", 1).alias("title"), F.lit(None).cast("boolean").alias("retracted"))
    out = retract.check(held, updates)
    return out.select("doi", "retracted", F.coalesce(F.size("corrections"), F.lit(0)).alias("n_corrections"))


@query("""
SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, ends_with(regexp_extract(url, '://([^/?#]*)', 1), 'example.org') AS allowed FROM pages""")
def host_allow_list(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.try_parse_url("url", F.lit("HOST")).alias("host"), X.host_allowed(F.col("url"), "example.org").alias("allowed"))


@query("""
SELECT doc_id, coalesce(TRY_CAST(nullif(regexp_extract(' ' || text || ' ', '[^0-9]([0-9]{4})[^0-9]', 1), '') AS INTEGER), 0) AS year FROM documents""")
def year_parse(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(X.parse_year(F.col("text")), F.lit(0)).alias("year"))


@query("""
SELECT d.doc_id, d.source || ' (' || coalesce(l.n, 0) || ')' AS line FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY doc_id) l USING (doc_id)
WHERE l.n IS NULL""")
def missing_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("bibcode"), F.lit(True).alias("relevant"), F.col("source").alias("bibstem"), F.lit(None).cast("string").alias("year"), F.col("doc_id").alias("ordinal"))
    out = fetch.missing_documents(rows, table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("stem")))
    return out.select(F.col("ordinal").alias("doc_id"), F.concat("bibstem", F.lit(" (0)")).alias("line"))


@query(r"""
WITH q AS (SELECT item_id, list_filter(string_split(lower(regexp_replace(trim(text), '\s+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM benchmark),
d AS (SELECT doc_id, replace(text, '. ', '.          ') AS text FROM documents),
seg AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
cut AS (SELECT doc_id, i, unnest(string_split_regex(raw, ' {8,}')) AS raw, generate_subscripts(string_split_regex(raw, ' {8,}'), 1) AS j FROM seg),
num AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS line, list_filter(string_split(lower(regexp_replace(trim(raw), '\s+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM cut WHERE trim(raw) <> ''),
a AS (SELECT item_id, s, array_to_string(w[s:s + 2], ' ') AS g FROM q, unnest(range(1, len(w) - 1)) AS t(s)),
b AS (SELECT doc_id, line, p, array_to_string(w[p:p + 2], ' ') AS g FROM num, unnest(range(1, len(w) - 1)) AS t(p)),
m AS (SELECT item_id, doc_id, line, s, p FROM a JOIN b USING (g)),
isl AS (SELECT *, s - row_number() OVER (PARTITION BY item_id, doc_id, line, s - p ORDER BY s) AS run FROM m),
hit AS (SELECT item_id, doc_id, line, min(s) AS s, count(*) + 2 AS n FROM isl GROUP BY item_id, doc_id, line, s - p, run),
best AS (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY n DESC, s, line) AS r FROM hit)
SELECT item_id AS quote_id, doc_id AS doc, CAST(line AS INTEGER) AS line, CAST(n AS INTEGER) AS n FROM best WHERE r = 1""")
def shortening_ladder(spark, sf_dir):
    """Runs from the whole quote down to 3 words, in texts whose sentences stand in columns of their own."""
    quotes = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("quote_id"), F.col("text").alias("quote"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.replace("text", F.lit(". "), F.lit("." + " " * 10)).alias("text"))
    return claims.ladder(quotes, docs)


@query()
def frontmatter_parse(spark, sf_dir):
    head = F.concat(F.lit("---\ntitle: '"), F.col("source"), F.lit("'\ntags: [paper, "), F.col("lang"), F.lit("]\ncitations: "), F.col("n_chars").cast("string"), F.lit("\n---\n"), F.col("text"))
    rows = notes.parse_heads(table(spark, sf_dir, "documents").select("doc_id", head.alias("text")))
    return rows.select("doc_id", "fm_status", "fm.title", F.array_join("tags", ",").alias("tags"), F.col("fm.citations").alias("citations"))


ORACLES["frontmatter_parse"] = "SELECT doc_id, 'ok' AS fm_status, source AS title, 'paper,' || lang AS tags, n_chars AS citations FROM documents"


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_extendedprice) AS low FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def composite_key_repeats(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    n = rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    first = discover.first_wins(rows.select("l_orderkey", "l_linenumber", "l_extendedprice"), ["l_orderkey", "l_linenumber"], "l_extendedprice")
    return first.join(n, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "n", F.col("l_extendedprice").alias("low"))
