"""Discovery for many subjects at once: direct search, curated keys, glyph rescue, citation chaining and its gate.

The stages follow each other in this order, and each starts from what the ones before have found. Every stage is one
table of narrow rows (subject, bibcode, via ...), written to the run's folder before the next one begins; a stage that
is there already is read, so a run that was cut off goes on where it stopped. What is written is the seen-set: a later
stage brings only keys that its subject hasn't met, and chained keys are written before the gate judges them.

The number of jobs depends on the stages, not on the subjects: names of all subjects are found in one pass over the
titles and abstracts (`names.mentioned`), supersets of glyph names are ranked together, and joins go by subject and key.
Whole texts are only asked about keys that the chaining has reached and that nothing else anchors: pairs of all names
and all texts that say them grow faster than both, and most of them answer nothing. Records are judged once; what the
stages need of them, all but the texts, is written first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators.discover import glyph_target
from quillspark.operators.names import folded, mentioned, phrases
from quillspark.sources.store import kept, new_path

TITLE, ABSTRACT = 1, 2
#: Parts over which the rows of one subject are ranked before the best of each part meet.
PARTS = 64
_ROW = ("bibcode", "ordinal", "citation_count", "relevant")


def top(rows: DataFrame, by: list[str], n: int, parts: int = PARTS) -> DataFrame:
    """The n most cited rows of each group, with num_found and truncated. A group's rows are ranked part by part first,
    so at most parts * n of them meet in one task, however many there are."""
    order = [F.coalesce("citation_count", F.lit(0)).desc(), F.col("ordinal"), F.col("bibcode")]
    salted = rows.withColumn("__part", F.pmod(F.xxhash64("bibcode"), F.lit(parts)).cast("int"))
    ranked = salted.withColumn("__r", F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))).where(F.col("__r") <= n)
    best = ranked.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= n).drop("__r", "__part")
    found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("num_found"))
    return best.join(found, by).withColumn("truncated", F.col("num_found") > n)


@dataclass
class Discovery:
    """What a run has found, as tables.

    rows: subject, stage (0 to 3), via, bibcode, relevant, citation_count, ordinal and gate (accepted, suppressed or
    pending; only accepted rows belong to the subject). cut: subject, stage, letter (glyph only) and num_found of what
    a limit has cut. missing: subject and bibcode of curated keys that the catalogue lacks. empty: subjects whose
    direct search found nothing; nothing is kept of them.
    """

    rows: DataFrame
    cut: DataFrame
    missing: DataFrame
    empty: DataFrame


def _said(records: DataFrame, aliases: DataFrame) -> DataFrame:
    return mentioned(records, [F.col("title"), F.col("abstract")], aliases, _ROW)


def _told(records: DataFrame, pairs: DataFrame, aliases: DataFrame) -> DataFrame:
    """Those of the pairs (subject, bibcode) where the record's text says a name of the subject. Names go to the texts by key."""
    asked = pairs.distinct().join(phrases(aliases), "subject").withColumnRenamed("bibcode", "__asked")
    texts = records.where("text is not null").select("bibcode", folded(F.col("text")).alias("__text"))
    return texts.join(asked, (F.col("bibcode") == F.col("__asked")) & F.contains("__text", "phrase")).select("subject", "bibcode").distinct()


def glyph_names(aliases: DataFrame) -> DataFrame:
    """subject, letter, constellations and pattern of the names that a look-alike may hide, one row a subject and letter."""
    named = aliases.select("subject", glyph_target(F.col("name")).alias("t")).where("t is not null")
    one = named.groupBy("subject", "t.letter").agg(F.array_sort(F.collect_set("t.constellation")).alias("constellations"), F.array_sort(F.collect_set("t.pattern")).alias("patterns"))
    return one.select("subject", "letter", "constellations", F.array_join("patterns", "|").alias("pattern"))


def _both(title: Column, abstract: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))


def discover(subjects: DataFrame, aliases: DataFrame, records: DataFrame, edges: DataFrame, extra: DataFrame, decisions: DataFrame, topic_hits: DataFrame | None = None, rows: int = 2000, path: str | None = None, triage: bool = True) -> Discovery:
    """All stages for all subjects.

    subjects: subject, is_topic. aliases: subject, name (of subjects that are no topics). records: bibcode, ordinal,
    title, abstract, text, citation_count, relevant. edges: src cites dst. extra: subject, bibcode (curated).
    decisions: subject, bibcode, decision; a discard suppresses. topic_hits: subject, bibcode of what a topic's own
    query finds. path: the run's folder; a new one if none is given.

    Rows of the direct search are not made distinct among themselves; nulls match nothing.
    """
    spark = records.sparkSession
    path = path or new_path(spark, "discovery")
    stars = subjects.where("not is_topic").select("subject")
    names = aliases.join(stars, "subject", "left_semi")
    heads = kept(records.select(*_ROW, "title", "abstract"), f"{path}/records")
    narrow = heads.select(*_ROW)
    said = kept(_said(heads, names), f"{path}/said")
    anchored = said.select("subject", "bibcode")
    direct = said.where(F.col("columns").bitwiseAND(TITLE | ABSTRACT) > 0).drop("columns").select("subject", *_ROW)
    if topic_hits is not None:
        own = topic_hits.join(subjects.where("is_topic").select("subject"), "subject", "left_semi").select("subject", "bibcode")
        anchored = anchored.unionByName(own.distinct())
        direct = direct.unionByName(own.join(narrow, "bibcode").select("subject", *_ROW))

    # 0: direct search, cut at the limit
    first = kept(top(direct, ["subject"], rows), f"{path}/stage=0")
    live = kept(first.select("subject").distinct(), f"{path}/live")
    empty = subjects.select("subject").join(live, "subject", "left_anti")

    # 1: curated keys, in place or fetched
    wanted = extra.join(live, "subject", "left_semi").where("bibcode is not null").select("subject", "bibcode").distinct()
    met = first.select("subject", "bibcode", "relevant").groupBy("subject", "bibcode").agg(F.bool_or("relevant").alias("was_core"))
    judged = wanted.join(met, ["subject", "bibcode"], "left").join(narrow.select("bibcode", "ordinal", "citation_count"), "bibcode", "left")
    curated = kept(judged.select("subject", "bibcode", "ordinal", "citation_count", "was_core"), f"{path}/stage=1")
    missing = curated.where("ordinal is null and was_core is null").select("subject", "bibcode")
    rescued = curated.where("was_core = false").select("subject", "bibcode", F.lit(True).alias("rescued"))
    fetched = curated.where("was_core is null and ordinal is not null").select("subject", "bibcode", "ordinal", "citation_count", F.lit(True).alias("relevant"))
    found = first.join(rescued, ["subject", "bibcode"], "left")
    found = found.select("subject", F.lit(0).alias("stage"), F.when(F.col("rescued"), "manual").otherwise("query").alias("via"), "bibcode", (F.col("relevant") | F.coalesce("rescued", F.lit(False))).alias("relevant"), "citation_count", "ordinal")
    found = found.unionByName(fetched.withColumn("stage", F.lit(1)).withColumn("via", F.lit("manual")))

    # 2: glyph rescue; the limit stands between the superset and the glyph filter
    targets = kept(glyph_names(names.join(live, "subject", "left_semi")), f"{path}/targets")
    places = targets.select(F.concat("letter", F.lit("\n"), F.col("subject").cast("string")).alias("subject"), F.explode("constellations").alias("name"))
    held = mentioned(heads, [F.col("title"), F.col("abstract")], places, _ROW)
    held = held.select(F.regexp_replace("subject", r"\A[a-z]+\n", "").cast(subjects.schema["subject"].dataType).alias("subject"), F.substring_index("subject", "\n", 1).alias("letter"), *_ROW)
    superset = top(held, ["subject", "letter"], rows)
    superset = kept(superset, f"{path}/superset")
    looked = superset.where("relevant").join(targets.select("subject", "letter", "pattern"), ["subject", "letter"]).join(heads.select("bibcode", _both(F.col("title"), F.col("abstract")).alias("__both")), "bibcode")
    seen = found.select("subject", "bibcode")
    by_glyph = looked.where(F.regexp_like("__both", F.col("pattern"))).groupBy("subject", "bibcode").agg(F.first("ordinal").alias("ordinal"), F.first("citation_count").alias("citation_count"))
    by_glyph = kept(by_glyph.join(seen, ["subject", "bibcode"], "left_anti"), f"{path}/stage=2")
    found = found.unionByName(by_glyph.select("subject", F.lit(2).alias("stage"), F.lit("glyph").alias("via"), "bibcode", F.lit(True).alias("relevant"), "citation_count", "ordinal"))

    # 3: one hop over the citation graph, anchored, new keys only; written before they are judged
    core = found.where("relevant").select("subject", F.col("bibcode").alias("seed")).distinct()
    hop = lambda here, there, via, rank: edges.join(core, edges[here] == core["seed"]).select("subject", F.col(there).alias("bibcode"), F.struct(F.lit(rank).alias("rank"), F.lit(via).alias("via")).alias("how"))
    reached = hop("src", "dst", "chain:references", 0).unionByName(hop("dst", "src", "chain:citations", 1)).groupBy("subject", "bibcode").agg(F.min("how").alias("how"))
    reached = reached.join(found.select("subject", "bibcode"), ["subject", "bibcode"], "left_anti").join(narrow.where("relevant"), "bibcode")
    reached = reached.join(anchored.distinct().withColumn("anchored", F.lit(True)), ["subject", "bibcode"], "left")
    reached = kept(reached.select("subject", "bibcode", "how.via", "ordinal", "citation_count", "anchored"), f"{path}/reached")
    open_ = reached.where("anchored is null")
    told = kept(_told(records, open_.select("subject", "bibcode"), names), f"{path}/told")
    chained = reached.where("anchored").unionByName(open_.join(told, ["subject", "bibcode"], "left_semi"))
    chained = kept(chained.select("subject", "bibcode", "via", "ordinal", "citation_count"), f"{path}/stage=3")

    gate = F.lit("accepted")
    judged = chained
    if triage:
        in_title = said.where(F.col("columns").bitwiseAND(TITLE) > 0).select("subject", "bibcode").distinct().withColumn("named", F.lit(True))
        patterns = targets.groupBy("subject").agg(F.array_join(F.array_sort(F.collect_set("pattern")), "|").alias("pattern"))
        dropped = decisions.where("decision = 'discarded'").select("subject", "bibcode").distinct().withColumn("dropped", F.lit(True))
        judged = chained.join(subjects.select("subject", "is_topic"), "subject").join(in_title, ["subject", "bibcode"], "left").join(dropped, ["subject", "bibcode"], "left").join(patterns, "subject", "left")
        judged = judged.join(heads.select("bibcode", X.collapse(F.coalesce("title", F.lit(""))).alias("__title")), "bibcode", "left")
        glyph = F.coalesce(F.regexp_like("__title", F.col("pattern")), F.lit(False))
        gate = F.when(F.col("is_topic") | F.coalesce("named", F.lit(False)) | glyph, "accepted").when(F.col("dropped"), "suppressed").otherwise("pending")
    last = judged.select("subject", F.lit(3).alias("stage"), "via", "bibcode", F.lit(True).alias("relevant"), "citation_count", "ordinal", gate.alias("gate"))
    cut = first.where("truncated").select("subject", F.lit(0).alias("stage"), F.lit(None).cast("string").alias("letter"), "num_found")
    cut = cut.unionByName(superset.where("truncated").select("subject", F.lit(2).alias("stage"), "letter", "num_found")).distinct()
    return Discovery(found.withColumn("gate", F.lit("accepted")).unionByName(last), cut, missing, empty)
