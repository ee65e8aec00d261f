"""Facet classification: which records are core, why the others aren't, and what other rules would do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.config import Lens
from quillspark.sources.store import staged

UNTITLED_REASON = "reason not recorded"


def haystack(title: Column, abstract: Column, keywords: Column) -> Column:
    """Title, abstract and keywords in one lower-cased line; empty parts are left out."""
    words = F.array_join(F.filter(keywords, lambda k: k != ""), " ")
    parts = F.filter(F.array(title, abstract, words), lambda p: p.isNotNull() & (p != ""))
    return F.lower(F.array_join(parts, " "))


def topics(text: Column, lens: Lens) -> Column:
    """Names of the facets that match, in declaration order."""
    hits = [F.when(F.regexp_like(text, F.lit(f"(?i){pattern}")), F.lit(name)) for name, pattern in lens.facets.items()]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def exclusion_reason(found: Column, doctype: Column, lens: Lens) -> Column:
    """Null for core; else the first reason: no topic, noise kind, missing required facets, too few facets."""
    missing = F.array_except(F.array(*map(F.lit, lens.require)).cast("array<string>"), found)
    noise = doctype.isin(*lens.noise_doctypes) if lens.noise_doctypes else F.lit(False)
    return (
        F.when(F.size(found) == 0, "no topic matches")
        .when(noise, F.concat(F.lit("noise doctype: "), doctype))
        .when(F.size(missing) > 0, F.concat(F.lit("missing required: "), F.array_join(missing, ", ")))
        .when(F.size(found) < lens.min_topics, F.concat(F.lit("fewer than "), F.lit(str(lens.min_topics)), F.lit(" topics")))
    )


def classify(records: DataFrame, lens: Lens) -> DataFrame:
    """records with topics, relevant and why_excluded by this lens."""
    text = haystack(F.col("title"), F.col("abstract"), F.col("keyword"))
    out = records.withColumn("topics", topics(text, lens))
    out = out.withColumn("why_excluded", exclusion_reason(F.col("topics"), F.col("doctype"), lens))
    return out.withColumn("relevant", F.col("why_excluded").isNull())


def reclassify(records: DataFrame, lens: Lens) -> DataFrame:
    """Stored records under another lens; what a person added stays core."""
    manual = F.col("via") == "manual"
    out = classify(records, lens)
    return out.withColumn("relevant", F.when(manual, True).otherwise(F.col("relevant"))).withColumn("why_excluded", F.when(manual, None).otherwise(F.col("why_excluded")))


def would_be_core(lens: Lens, require: tuple[str, ...] = (), min_topics: int = 1) -> Column:
    """Whether a classified record (topics, doctype) were core under another combination."""
    noise = F.col("doctype").isin(*lens.noise_doctypes) if lens.noise_doctypes else F.lit(False)
    held = F.size(F.array_except(F.array(*map(F.lit, require)).cast("array<string>"), "topics")) == 0
    return F.coalesce((F.size("topics") > 0) & ~noise & held & (F.size("topics") >= min_topics), F.lit(False))


def combination_contrast(classified: DataFrame, lens: Lens) -> DataFrame:
    """rule, n_core and drop_pct: the plain rule, and each facet if it were required. One pass over the records."""
    rules = [("any facet", ())] + ([] if lens.require else [(f"require {name}", (name,)) for name in lens.facets])
    one = classified.agg(*[F.count_if(would_be_core(lens, r)).alias(f"c{i}") for i, (_, r) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("n_core"), F.col("c0").alias("base")) for i, (name, _) in enumerate(rules)])
    drop = F.round(100 * (F.col("base") - F.col("n_core")) / F.greatest(F.col("base"), F.lit(1)), 4)
    return one.select(F.explode(rows).alias("r")).select("r.rule", "r.n_core", "r.base").select("rule", "n_core", drop.alias("drop_pct"))


def by_citations(column: str = "citation_count") -> Column:
    return F.coalesce(F.col(column), F.lit(0)).desc()


def excluded_top(classified: DataFrame, n: int = 10) -> DataFrame:
    """The most cited records that aren't core, with the reason."""
    return classified.where("not relevant").orderBy(by_citations(), "ordinal").limit(n).withColumn("why_excluded", F.coalesce("why_excluded", F.lit(UNTITLED_REASON)))


def probe(classified: DataFrame, n: int = 25) -> DataFrame:
    """All core and the most cited others, core first, without their abstracts.

    Texts are classified once: what is limited, put together and sorted are the written rows without the texts.
    """
    held = staged(classified.drop("abstract"), "probe")
    rest = held.where("not relevant").orderBy(by_citations(), "ordinal").limit(n)
    return held.where("relevant").unionByName(rest).orderBy(F.col("relevant").desc(), by_citations(), "ordinal")


def reclass_diff(before: DataFrame, after: DataFrame, notes: DataFrame) -> DataFrame:
    """slug, transition, note_state, via and n: what enters and leaves the core under another lens.

    before and after: slug, bibcode, relevant, via. notes: bibcode, n_methods. A note with methods is extracted,
    any other is a stub.
    """
    old = before.select("slug", "bibcode", F.col("relevant").alias("was"), "via")
    both = old.join(after.select("slug", "bibcode", F.col("relevant").alias("now")), ["slug", "bibcode"]).join(notes.select("bibcode", "n_methods"), "bibcode", "left")
    state = F.when(F.col("n_methods").isNull(), "none").when(F.col("n_methods") > 0, "extracted").otherwise("stub")
    move = F.when(F.col("was") & ~F.col("now"), "leaves").when(~F.col("was") & F.col("now"), "enters").when(F.col("now"), "stays").otherwise("out")
    named = both.select("slug", move.alias("transition"), state.alias("note_state"), F.coalesce("via", F.lit("?")).alias("via"))
    return named.groupBy("slug", "transition", "note_state", "via").agg(F.count(F.lit(1)).alias("n"))


def core_factor(diff: DataFrame) -> DataFrame:
    """slug, before, after and factor (after / before; infinite from nothing) of a reclass_diff."""
    n = lambda *moves: F.sum(F.when(F.col("transition").isin(*moves), F.col("n")).otherwise(0))
    out = diff.groupBy("slug").agg(n("leaves", "stays").alias("before"), n("enters", "stays").alias("after"))
    return out.withColumn("factor", F.when(F.col("before") > 0, F.col("after") / F.col("before")).otherwise(F.lit(float("inf"))))
