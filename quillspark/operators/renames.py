"""Renaming and deleting notes: chains of renames are resolved at once, and all links in all texts change in one pass.

A rename says what a note was called and what it is called next; several make a chain. Chains are followed by pointer
jumping, so one of 50 renames takes six joins. Names that lead into a cycle have no last name: nothing is done about
them, and they are reported, as are new names that another note has and links to what was deleted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.sources.store import staged

#: Links to one note that look up its new name in one part; a note with more has several.
LINKS = 1 << 14
_TARGET = r"\A[^\]|#]+"


def link_targets(text: Column) -> Column:
    """Targets of all links of a text, in order: what stands between `[[` and the first bar, hash or bracket."""
    pieces = F.split(text, r"\[\[")
    return F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: X.strip(F.regexp_extract(p, _TARGET, 0)))


def retargeted(text: Column, new: Column) -> Column:
    """The text with the targets that the map `new` has replaced by its values; labels, anchors and all else stay."""

    def one(piece: Column) -> Column:
        raw = F.regexp_extract(piece, _TARGET, 0)
        to = F.try_element_at(new, X.strip(raw))
        return F.when(to.isNull(), piece).otherwise(F.concat(to, F.substr(piece, F.length(raw) + 1)))

    pieces = F.split(text, r"\[\[")
    return F.array_join(F.concat(F.slice(pieces, 1, 1), F.transform(F.slice(pieces, 2, F.size(pieces)), one)), "[[")


def resolved(renames: DataFrame) -> DataFrame:
    """old, new (the last name that renames lead to, null in or before a cycle) and state (ok, cycle) of every old name.

    renames: old, new. A name that is renamed to several takes the smallest; nulls and names renamed to themselves
    rename nothing.
    """
    one = renames.where("old is not null and new is not null and old <> new").groupBy("old").agg(F.min("new").alias("new"))
    steps = staged(one, "renames")
    names = steps.count()
    ahead = lambda d: d.select(F.col("old").alias("new"), F.col("new").alias("beyond"))
    for _ in range(max(1, names).bit_length()):  # each round doubles the steps, so a chain of all names is walked to its end
        open_ = steps.join(ahead(steps), "new", "left")
        steps = staged(open_.select("old", F.coalesce("beyond", "new").alias("new"), F.col("beyond").isNotNull().alias("moved")), "renames")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    olds = one.select(F.col("old").alias("new"), F.lit(True).alias("again"))
    out = steps.select("old", "new").join(olds, "new", "left")
    return out.select("old", F.when(F.col("again").isNull(), F.col("new")).alias("new"), F.when(F.col("again").isNull(), "ok").otherwise("cycle").alias("state"))


def _dealt(said: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """said (stem, old) and links (old, new) with part. Only names that very many notes say have more than one part, so
    links are repeated for few names."""
    often = said.groupBy("old").agg(F.floor(F.count(F.lit(1)) / LINKS).cast("int").alias("last")).where("last > 0")
    hot = F.broadcast(staged(often, "often"))  # a row for LINKS links at most
    part = F.pmod(F.xxhash64("stem"), F.coalesce(F.col("last"), F.lit(0)) + 1).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("last", F.lit(0))))
    return said.join(hot, "old", "left").select("stem", "old", part.alias("part")), links.join(hot, "old", "left").select("old", "new", parts.alias("part"))


@dataclass
class Renamed:
    """notes: stem, old_stem, text and changed of all notes that stay. report: what (cycle, taken, dangling), stem and target."""

    notes: DataFrame
    report: DataFrame


def applied(notes: DataFrame, renames: DataFrame, deletes: DataFrame) -> Renamed:
    """notes (stem, text) after renames (old, new) and deletes (stem), which go by the notes' names before.

    A new name that a staying note has, or that a smaller old name gets too, is taken: that note keeps its name and
    links to it stay. Links to a deleted note stay as they are and are reported, wherever its name had gone to.
    """
    gone = deletes.where("stem is not null").select("stem").distinct()
    named = staged(resolved(renames), "resolved")
    good = named.where("state = 'ok'").select("old", "new")
    here = notes.select("stem").distinct()
    moving = here.join(gone, "stem", "left_anti").join(good.withColumnRenamed("old", "stem"), "stem")
    staying = here.join(gone, "stem", "left_anti").join(moving.select("stem"), "stem", "left_anti").select(F.col("stem").alias("new"), F.lit(True).alias("held"))
    heirs = moving.groupBy("new").agg(F.min("stem").alias("heir"))  # of the notes that want one name
    judged = staged(moving.join(staying, "new", "left").join(heirs, "new").select("stem", "new", (F.col("held").isNotNull() | (F.col("stem") != F.col("heir"))).alias("taken")), "moves")
    taken = judged.where("taken").select(F.col("stem").alias("old"))
    links = good.join(taken, "old", "left_anti").join(gone.withColumnRenamed("stem", "old"), "old", "left_anti")
    said = staged(notes.select("stem", F.explode(F.array_distinct(link_targets(F.col("text")))).alias("old")), "links")
    asking, named_by = _dealt(said, links)
    met = asking.join(named_by.hint("merge"), ["old", "part"])  # all new names would grow in every task if they were broadcast
    maps = met.groupBy("stem").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct("old", "new")))).alias("map"))
    rows = notes.join(gone, "stem", "left_anti").join(maps, "stem", "left").join(judged.where("not taken").select("stem", "new"), "stem", "left")
    text = F.when(F.col("map").isNull(), F.col("text")).otherwise(retargeted(F.col("text"), F.col("map")))
    out = rows.select(F.coalesce("new", "stem").alias("stem"), F.col("stem").alias("old_stem"), text.alias("text"), (F.col("map").isNotNull() | F.col("new").isNotNull()).alias("changed"))
    none = F.lit(None).cast("string")
    lost = said.join(gone.withColumnRenamed("stem", "old"), "old", "left_semi").join(gone, "stem", "left_anti")
    report = named.where("state = 'cycle'").select(F.lit("cycle").alias("what"), F.col("old").alias("stem"), none.alias("target"))
    report = report.unionByName(judged.where("taken").select(F.lit("taken").alias("what"), "stem", F.col("new").alias("target"))).unionByName(lost.select(F.lit("dangling").alias("what"), "stem", F.col("old").alias("target")))
    return Renamed(out, report)
