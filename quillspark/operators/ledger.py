"""Runs, search logs and decisions: what was asked, found and decided, and what may be done next."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At least so many new core, and such a growth, stop an ingest until a person agrees.
GUARD_NEW, GUARD_FACTOR = 50, 1.5


def run_counts(records: DataFrame, candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """slug, n_total, n_core, n_candidates and n_dropped of each slug."""
    core = records.groupBy("slug").agg(F.count(F.lit(1)).alias("n_total"), F.count_if("relevant").alias("n_core"))
    waiting = candidates.groupBy("slug").agg(F.count(F.lit(1)).alias("n_candidates"))
    dropped = decisions.groupBy("slug").agg(F.count(F.lit(1)).alias("n_dropped"))
    return core.join(waiting, "slug", "left").join(dropped, "slug", "left").na.fill(0, ["n_candidates", "n_dropped"])


def merged_decisions(legacy: DataFrame, current: DataFrame) -> DataFrame:
    """Both ledgers' decisions; the current one wins on the same slug and key. Running it again changes nothing."""
    rows = legacy.withColumn("p", F.lit(0)).unionByName(current.withColumn("p", F.lit(1)))
    rest = [c for c in current.columns if c not in ("slug", "bibcode")]
    best = rows.groupBy("slug", "bibcode").agg(F.max_by(F.struct(*rest), "p").alias("b"))
    return best.select(*[F.col(f"b.{c}").alias(c) if c in rest else F.col(c) for c in legacy.columns])


def upsert_decisions(held: DataFrame, slug: str, keys: list[str], decision: str, reason: str, today: dt.date | None = None) -> DataFrame:
    """held with these decisions written over older ones. A reason is asked for."""
    if not reason.strip():
        raise ValueError("a decision needs a reason")
    day = (today or dt.datetime.now(dt.UTC).date()).isoformat()
    new = held.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(keys)], "bibcode string").select(F.lit(slug).alias("slug"), "bibcode", F.lit(decision).alias("decision"), F.lit(reason).alias("reason"), F.lit(day).cast("date").alias("decided_on"))
    return held.join(new, ["slug", "bibcode"], "left_anti").unionByName(new.select(*held.columns))


def unknown_keys(keys: DataFrame, candidates: DataFrame) -> DataFrame:
    """Keys decided on that no pending candidate has."""
    return keys.join(candidates.select("bibcode"), "bibcode", "left_anti")


def suppressed(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """candidates with decision and suppressed; only a discard suppresses."""
    out = candidates.join(decisions.select("bibcode", "decision"), "bibcode", "left")
    return out.withColumn("suppressed", F.coalesce(F.col("decision") == "discarded", F.lit(False)))


def with_note_mark(candidates: DataFrame, notes: DataFrame) -> DataFrame:
    """candidates with has_note: a label, never a filter."""
    marks = notes.select("bibcode").distinct().withColumn("has_note", F.lit(True))
    return candidates.join(marks, "bibcode", "left").withColumn("has_note", F.coalesce("has_note", F.lit(False)))


def fallback(live: DataFrame, ledger: DataFrame, key: str = "slug") -> DataFrame:
    """Live rows, and the ledger's for slugs that have none."""
    return live.unionByName(ledger.join(live.select(key).distinct(), key, "left_anti").select(*live.columns))


def guard(records: DataFrame, notes: DataFrame, least_new: int = GUARD_NEW, factor: float = GUARD_FACTOR) -> DataFrame:
    """slug, n_core, n_known, n_new, n_chained and stop. Known is core with a note; without any known nothing stops."""
    marked = with_note_mark(records.where("relevant"), notes)
    one = marked.groupBy("slug").agg(F.count(F.lit(1)).alias("n_core"), F.count_if("has_note").alias("n_known"), F.count_if(~F.col("has_note") & F.startswith(F.coalesce("via", F.lit("")), F.lit("chain:"))).alias("n_chained"))
    one = one.withColumn("n_new", F.col("n_core") - F.col("n_known"))
    stop = (F.col("n_known") > 0) & (F.col("n_new") >= least_new) & (F.col("n_core") >= factor * F.col("n_known"))
    return one.withColumn("stop", stop)


def candidate_line(title: Column, citations: Column, key: Column, width: int = 76) -> Column:
    """A candidate as one line of a report."""
    return F.concat_ws("  ", key, F.lpad(F.coalesce(citations, F.lit(0)).cast("string"), 5, " "), F.substring(title, 1, width))


def truncations(runs: DataFrame) -> DataFrame:
    """slug and kind of every cut search: the direct one, or a letter's superset. runs: slug, truncated, cut_letters."""
    direct = runs.where("truncated").select("slug", F.lit("direct search").alias("kind"))
    letters = runs.select("slug", F.explode("cut_letters").alias("letter")).select("slug", F.concat(F.lit("glyph superset: "), F.col("letter")).alias("kind"))
    return direct.unionByName(letters)
