"""Discovery over landed tables: search, curated override, glyph rescue, citation chaining and its gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators.classify import by_citations

#: Letters whose look-alike glyphs catalogues don't unify; ASCII forms, the letter, look-alikes.
LETTERS = {
    "alpha": (("alpha", "alf", "alp"), "α", "ⲁ"), "beta": (("beta", "bet"), "β", "ϐ"), "gamma": (("gamma", "gam"), "γ", "ɣ"),
    "delta": (("delta", "del"), "δ", "ẟ"), "epsilon": (("epsilon", "eps"), "ε", "ϵ∊ɛ"), "zeta": (("zeta", "zet"), "ζ", ""),
    "eta": (("eta",), "η", ""), "theta": (("theta", "tet", "the"), "θ", "ϑ"), "iota": (("iota", "iot"), "ι", ""),
    "kappa": (("kappa", "kap"), "κ", "ϰ"), "lambda": (("lambda", "lam"), "λ", ""), "mu": (("mu",), "μ", "µ"), "nu": (("nu",), "ν", ""),
    "xi": (("xi", "ksi"), "ξ", ""), "omicron": (("omicron", "omi"), "ο", ""), "pi": (("pi",), "π", "ϖ"), "rho": (("rho",), "ρ", "ϱ"),
    "sigma": (("sigma", "sig"), "σ", "ςϲ"), "tau": (("tau",), "τ", ""), "upsilon": (("upsilon", "ups"), "υ", "ϒ"), "phi": (("phi",), "φ", "ϕ"),
    "chi": (("chi",), "χ", ""), "psi": (("psi",), "ψ", ""), "omega": (("omega", "ome"), "ω", ""),
}


class EmptyResult(RuntimeError):
    """A direct search of a subject found nothing, which is never stored."""


def search(records: DataFrame, where: Column, rows: int | None = 2000, also: Column | None = None) -> DataFrame:
    """The `rows` most cited records that match, or all for None, with num_found (all matches) and truncated on each row."""
    hits = records.where(where if also is None else where & also)
    found = hits.agg(F.count(F.lit(1)).alias("num_found"))
    top = hits if rows is None else hits.orderBy(by_citations(), "ordinal").limit(rows)
    return top.crossJoin(F.broadcast(found)).withColumn("truncated", F.lit(False) if rows is None else F.col("num_found") > rows)  # one row beside the limit


def projected(raw: DataFrame) -> DataFrame:
    """Records from a catalogue's rows, where title, doi and bibstem are lists: the first of each, or a default."""
    first = lambda c, default=None: F.coalesce(F.get(F.col(c), F.lit(0)), F.lit(default).cast("string"))
    other = [c for c in raw.columns if c not in ("title", "doi", "bibstem", "identifier", "citation_count")]
    return raw.select(*other, first("title", "").alias("title"), first("doi").alias("doi"), first("bibstem", "").alias("bibstem"), F.nullif(X.arxiv_id(F.col("identifier")), F.lit("")).alias("arxiv_id"), F.coalesce("citation_count", F.lit(0)).cast("bigint").alias("citation_count"))


def in_full_text(names: Sequence[str]) -> Column:
    """Whether the whole text says any variant of any name."""
    return mentions([F.col("text")], names)


def require_hits(found: DataFrame) -> DataFrame:
    if found.isEmpty():
        raise EmptyResult("the direct search found nothing; nothing is stored")
    return found


def fetch_keys(records: DataFrame, keys: DataFrame) -> DataFrame:
    """The records of a key list (bibcode), core whatever the lens says."""
    found = records.join(keys.select("bibcode").distinct(), "bibcode", "left_semi")
    return found.withColumn("relevant", F.lit(True)).withColumn("why_excluded", F.lit(None).cast("string")).withColumn("via", F.lit("manual"))


def mentions(columns: Sequence[Column], names: Sequence[str]) -> Column:
    """Whether any column holds a variant of any name as a phrase, case aside."""
    phrases = F.transform(X.expand_variants(F.array(*map(F.lit, names))), lambda p: F.lower(X.collapse(p)))
    texts = F.array(*[F.lower(X.collapse(F.coalesce(c, F.lit("")))) for c in columns])
    return F.exists(phrases, lambda p: F.exists(texts, lambda t: F.contains(t, p)))


def _letters() -> Column:
    """A map from each form of a letter that has look-alikes, and from each of its glyphs, to the letter and all its glyphs."""
    rows = [(form, letter, own + alike) for letter, (forms, own, alike) in LETTERS.items() if alike for form in (*forms, *own, *alike)]
    return F.map_from_entries(F.array(*[F.struct(F.lit(form), F.struct(F.lit(letter).alias("letter"), F.lit(glyphs).alias("glyphs"))) for form, letter, glyphs in rows]))


def glyph_target(name: Column) -> Column:
    """letter, glyphs, constellation and pattern of a name of a letter and a constellation; null for any other name.

    The pattern finds the letter or a look-alike of it beside the constellation, in the constellation's own case.
    """
    words = F.split(X.collapse(name), " ")
    known = F.try_element_at(_letters(), F.lower(F.rtrim(F.get(words, F.lit(0)), F.lit("."))))
    place = F.get(words, F.lit(1))
    ok = (F.size(words) == 2) & F.regexp_like(place, F.lit(r"\A[A-Za-z]{2,}\z")) & known.isNotNull()
    pattern = F.concat(F.lit("["), known["glyphs"], F.lit(f"]{X.SPACE}*"), place, F.lit(r"(?!\w)"))
    return F.when(ok, F.struct(known["letter"].alias("letter"), known["glyphs"].alias("glyphs"), place.alias("constellation"), pattern.alias("pattern")))


def glyph_targets(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """letter, constellations and pattern of the names that a look-alike may hide, one row a letter."""
    named = spark.createDataFrame([(n,) for n in names], "name string").select(glyph_target(F.col("name")).alias("t")).where("t is not null")
    one = named.groupBy("t.letter", "t.glyphs").agg(F.array_sort(F.collect_set("t.constellation")).alias("constellations"), F.array_join(F.array_sort(F.collect_set("t.pattern")), "|").alias("pattern"))
    return one.select("letter", "constellations", "pattern").orderBy("letter")


def glyph_rescue(records: DataFrame, names: Sequence[str], rows: int | None = 2000) -> tuple[DataFrame | None, DataFrame | None]:
    """Records that name the subject with a look-alike, via glyph; and a row for each letter whose superset was cut.

    The limit stands between the superset and the glyph filter, as a remote search would cut; that is why a cut
    letter is reported.
    """
    found = cut = None
    for t in glyph_targets(records.sparkSession, names).collect():  # no more rows than there are names
        superset = search(records, mentions([F.col("title"), F.col("abstract")], t.constellations), rows)
        both = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("abstract", F.lit("")))
        kept = superset.where(F.regexp_like(both, F.lit(t.pattern))).drop("num_found", "truncated").withColumn("via", F.lit("glyph"))
        mark = superset.where("truncated").select(F.lit(t.letter).alias("letter"), F.lit(", ".join(t.constellations)).alias("constellations"), "num_found", F.lit(rows).alias("rows")).distinct()
        found, cut = (kept, mark) if found is None else (found.unionByName(kept), cut.unionByName(mark))
    return found, cut


def subject_in_title(title: Column, names: Sequence[str]) -> Column:
    """Whether the title holds a variant of a name (part of a word counts) or one of its glyph forms."""
    line = X.collapse(F.coalesce(title, F.lit("")))
    test = mentions([title], names)
    for name in names:
        test = test | F.coalesce(F.regexp_like(line, glyph_target(F.lit(name))["pattern"]), F.lit(False))
    return test


def first_wins(rows: DataFrame, key: Sequence[str], *order: str) -> DataFrame:
    """The first row of each key in a total order; rows of a hot key are compared where they are, before the shuffle."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*[F.col(f"__row.{c}").alias(c) if c in rest else F.col(c) for c in rows.columns])


def override(records: DataFrame, extra: DataFrame, catalogue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records with curated keys made core (in place or fetched), and the keys that can't be found.

    Present and not core: rescued, via manual. Present and core: untouched. Absent: fetched from the catalogue.
    """
    keys = extra.select("bibcode").distinct().withColumn("__extra", F.lit(True))
    rescue = F.coalesce(F.col("__extra"), F.lit(False)) & ~F.col("relevant")
    held = records.join(keys, "bibcode", "left")
    held = held.withColumn("via", F.when(rescue, "manual").otherwise(F.col("via"))).withColumn("why_excluded", F.when(rescue, None).otherwise(F.col("why_excluded"))).withColumn("relevant", F.col("relevant") | rescue).drop("__extra")
    absent = keys.join(records.select("bibcode"), "bibcode", "left_anti").select("bibcode")
    fetched = fetch_keys(catalogue, absent)
    missing = absent.join(catalogue.select("bibcode"), "bibcode", "left_anti")
    return held.unionByName(fetched.select(*records.columns)), missing


def chain(core: DataFrame, edges: DataFrame) -> DataFrame:
    """bibcode, via and op_rank: one hop from the core in both directions, references before citations, each key once.

    core: bibcode. edges: src cites dst. Core itself is left out.
    """
    seeds = core.select(F.col("bibcode").alias("seed")).distinct()
    cited = edges.join(seeds, edges["src"] == seeds["seed"], "left_semi").select(F.col("dst").alias("bibcode"), F.lit("chain:references").alias("via"), F.lit(0).alias("op_rank"))
    citing = edges.join(seeds, edges["dst"] == seeds["seed"], "left_semi").select(F.col("src").alias("bibcode"), F.lit("chain:citations").alias("via"), F.lit(1).alias("op_rank"))
    # references win: the least rank of a key, by a partial aggregation rather than a window over a hot key
    best = cited.unionByName(citing).groupBy("bibcode").agg(F.min(F.struct("op_rank", "via")).alias("b")).select("bibcode", "b.via", "b.op_rank")
    return best.join(seeds.withColumnRenamed("seed", "bibcode"), "bibcode", "left_anti")


def gate(candidates: DataFrame, names: Sequence[str] | None, decisions: DataFrame) -> DataFrame:
    """candidates with gate: accepted (the title names the subject, or the subject is a topic), suppressed, pending.

    decisions: bibcode, decision. Only a discard suppresses.
    """
    dropped = decisions.where("decision = 'discarded'").select("bibcode").distinct().withColumn("__dropped", F.lit(True))
    named = F.lit(True) if names is None else subject_in_title(F.col("title"), names)
    state = F.when(named, "accepted").when(F.col("__dropped"), "suppressed").otherwise("pending")
    return candidates.join(dropped, "bibcode", "left").withColumn("gate", state).drop("__dropped")


def sweep(stored: DataFrame, hits: DataFrame) -> DataFrame:
    """Core hits of a full-text search that the stored run lacks, most cited first."""
    return hits.where("relevant").join(stored.select("bibcode"), "bibcode", "left_anti").orderBy(by_citations(), "ordinal")


def staged_union(*stages: DataFrame) -> DataFrame:
    """Rows of all stages in their order, with stage as a column."""
    out = None
    for i, rows in enumerate(stages):
        rows = rows.withColumn("stage", F.lit(i))
        out = rows if out is None else out.unionByName(rows)
    return out
