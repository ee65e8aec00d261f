"""Thin queries over the operators of this subpackage, with production parameters, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import asof, counts, decontam, lines, lm, mixing, near, pii, rules, spelling, substring, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, base verdict and learned verdict."""
    out = rules.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those that an earlier document holds, and the digest of what stays."""
    out = lines.deduplicated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "__q_lines.n_lines", "__q_lines.n_dropped", F.sha2(F.col("__q_lines.kept_text"), 256).alias("kept_sha256"))


ORACLES["op10_line_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM split
), held AS (
  SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT d.doc_id, d.pos, d.line, (h.first_id IS NOT NULL AND d.doc_id <> h.first_id) AS gone, d.r
  FROM keyed d LEFT JOIN held h USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@_query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, those inside benchmark windows, and the items found."""
    out = decontam.marked(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", *[f"__q_hits.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256")], (F.col("__q_hits.n_hit") > 0).alias("contaminated"))


ORACLES["op4_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), items AS (
  SELECT DISTINCT item_id, len(x) AS size, array_to_string(x, ' ') AS key FROM (
    SELECT item_id, unnest([list_slice(w, i, i + least(10, len(w)) - 1) FOR i IN range(1, greatest(1, len(w) - 9) + 1)]) AS x
    FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM items),
runs AS (
  SELECT d.r, size, i AS pos, array_to_string(list_slice(w, i, i + size - 1), ' ') AS key
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS u(i)
), hits AS (
  SELECT r, pos, runs.size, item_id FROM runs JOIN items ON runs.size = items.size AND runs.key = items.key
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
  FROM hits GROUP BY r
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""


@_query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in training order with its source's target, the words that the mix takes of it, and when it does."""
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", F.element_at("positions", 1).alias("position"), F.element_at("positions", 2).alias("second_position"))


ORACLES["op3_mixing"] = r"""
WITH d AS (
  SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size) AS place FROM (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents)
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS weight, CAST([-0.5, 0, 0.5][rank % 3 + 1] AS DOUBLE) AS slope, source_size * 2.0::DOUBLE AS cap FROM s
), h AS (
  SELECT *, (1.5::DOUBLE * sum(CAST(source_size AS DOUBLE)) OVER () - coalesce(sum(cap) OVER b, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS share
  FROM w WINDOW b AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min(share, (cap / weight, rank)) AS level FROM h WHERE share * weight < cap
), t AS (
  SELECT source, source_size, slope, least(cap, coalesce(level * weight, cap)) AS target FROM h, l
), r AS (
  SELECT d.*, source_size, target, slope,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, least(1.0::DOUBLE, (CAST(c AS DOUBLE) + size / 2.0::DOUBLE) / target) AS y, least(1.0::DOUBLE, (CAST(c + source_size AS DOUBLE) + size / 2.0::DOUBLE) / target) AS z, greatest(0, least(size, floor(target) - c)) AS one,
         greatest(0, least(size, floor(target) - c - source_size)) AS two FROM r
)
SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
       CASE WHEN one > 0 THEN CASE WHEN slope = 0 THEN y
            ELSE (slope - 1 + sqrt((1 - slope) * (1 - slope) + 4 * slope * y)) / (2 * slope) END END AS position,
       CASE WHEN two > 0 THEN CASE WHEN slope = 0 THEN z
            ELSE (slope - 1 + sqrt((1 - slope) * (1 - slope) + 4 * slope * z)) / (2 * slope) END END AS second_position
FROM p
"""


@_query
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies, and whether it is the one that stays."""
    out = near.classes(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(substring.original_id("id").alias("doc_id"), substring.original_id("class_id").alias("class_id"), "stays")


@_query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability to be toxic."""
    return toxicity.scored(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


@_query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return urls.judged(_table(spark, sf_dir, "pages"))


@_query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base spans, counted and digested, and all spans."""
    return pii.digest(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every span that repeats an earlier one, with its offsets and the document that keeps it."""
    out = substring.removed_spans(_table(spark, sf_dir, "documents"))
    return out.select(substring.original_id("id").alias("doc_id"), F.col("start").alias("span_start"), F.col("end").alias("span_end"), F.col("words").alias("n_words"), substring.original_id("first_id").alias("kept_doc_id"))


@_query
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's unigram and model log10 probabilities."""
    return lm.scored(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op11_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every click with the latest order of its client in the 240 hours before it."""
    return asof.clicks_to_orders(_table(spark, sf_dir, "clicks"), _table(spark, sf_dir, "sales"))


ORACLES["op11_asof_join"] = r"""
WITH ids AS (SELECT click_id AS id FROM clicks UNION SELECT sale_id FROM sales),
crc AS (
  SELECT id, xor(4294967295, list_reduce([4294967295] || [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(id AS VARCHAR), '')],
         lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM ids WHERE id IS NOT NULL
), c AS (
  SELECT DISTINCT click_id, client_id, CASE WHEN h % 2 = 1 THEN us - us % 3600000000 ELSE us END AS ts_us
  FROM (SELECT click_id, client_id, epoch_us(ts) AS us FROM clicks) JOIN crc ON id = click_id
), s AS (
  SELECT sale_id, client_id, priority, CAST(floor(100 * total + 0.5::DOUBLE) AS BIGINT) AS cents, coalesce(h, 0) AS h,
         CASE WHEN h % 2 = 1 THEN us - us % 3600000000 ELSE us END AS t
  FROM (SELECT *, epoch_us(sold_at) AS us FROM sales) LEFT JOIN crc ON id = sale_id
), o AS (
  SELECT sale_id, client_id, priority, cents, t FROM s
  UNION ALL SELECT -1 - sale_id, client_id, 6 - priority, cents, t FROM s WHERE h % 3 <> 0
), best AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY client_id, t) AS n,
           row_number() OVER (PARTITION BY client_id, t ORDER BY priority NULLS LAST, sale_id DESC NULLS LAST) AS place
    FROM o WHERE client_id IS NOT NULL AND t IS NOT NULL) WHERE place = 1
), m AS (
  SELECT c.*, b.sale_id, b.cents, b.t, b.n FROM c ASOF LEFT JOIN best b ON c.client_id = b.client_id AND c.ts_us >= b.t
)
SELECT click_id, client_id, ts_us, CASE WHEN ok THEN sale_id END AS sale_id, CASE WHEN ok THEN ts_us - t END AS lag_us,
       CASE WHEN ok THEN cents END AS total_cents, CASE WHEN ok THEN n ELSE 0 END AS n_tied
FROM (SELECT *, coalesce(ts_us - t <= 864000000000, false) AS ok FROM m)
"""


@_query
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens."""
    return counts.counted(_table(spark, sf_dir, "documents"))


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its near words, the form that it is a variant of, and the root of its group."""
    return spelling.grouped(_table(spark, sf_dir, "documents"))


ORACLES["op13_spelling_variants"] = r"""
WITH RECURSIVE r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), d AS (SELECT id, run, count(*) AS n FROM r GROUP BY id, run
), b AS (
  SELECT *, flatten([CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [CAST(192 + (ord(c) >> 6) AS BIGINT), CAST(128 + (ord(c) & 63) AS BIGINT)] END
                     FOR c IN string_split(id || ':' || run, '')]) AS bytes FROM d
), h AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295] || bytes, lambda c, b: list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
  FROM b
), w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM h
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), k AS MATERIALIZED (
  SELECT word, n, i, substring(word, 1, CAST(i AS INT) - 1) || substring(word, CAST(i AS INT) + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS u(i)
), near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM k x JOIN k y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT x.word, s.word, s.n FROM k x JOIN words s ON x.rest = s.word
  UNION SELECT s.word, x.word, x.n FROM k x JOIN words s ON x.rest = s.word
), f AS MATERIALIZED (
  SELECT word, n, coalesce(m, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words LEFT JOIN (SELECT word, count(*) AS m, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM near GROUP BY word) USING (word)
), chain AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON chain.at = f.word WHERE f.form IS NOT NULL
), ends AS (SELECT chain.word, chain.at AS root FROM chain JOIN f ON chain.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, ends.root FROM f JOIN ends ON f.word = ends.word
"""
