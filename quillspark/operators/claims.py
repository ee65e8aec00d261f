"""Claims of notes: blocks, cited pairs, false pairs for a benchmark, its score, and where a quote stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators.ranks import before, numbered
from quillspark.sources.store import staged

#: The heading of verification records, and the least characters of a claim.
VERIFIED = "## Citation check"
MIN_CLAIM, MAX_PAIRS = 15, 20
CAUGHT, SLIPPED = ("unsupported", "contradicts"), ("supported", "partial")
VERDICTS = (*CAUGHT, *SLIPPED, "unverifiable")


def numbered_lines(notes: DataFrame, heading: str = VERIFIED) -> DataFrame:
    """stem, line and s: trimmed lines of each note's body before its verification records, by their number in the file."""
    cut = F.substring_index("text", heading, 1)
    parts = F.split(cut, "---", 3)
    closed = F.startswith(cut, F.lit("---")) & (F.size(parts) == 3)
    body = F.when(closed, F.get(parts, F.lit(2))).otherwise(cut)
    offset = F.when(closed, F.regexp_count(F.concat(F.lit("------"), F.get(parts, F.lit(1))), F.lit("\n"))).otherwise(0)
    rows = notes.select("stem", offset.alias("offset"), F.posexplode(F.split(body, "\n")).alias("i", "raw"))
    return rows.select("stem", (F.col("i") + 1 + F.col("offset")).alias("line"), X.strip(F.col("raw")).alias("s"))


def blocks(notes: DataFrame, heading: str = VERIFIED) -> DataFrame:
    """stem, line, n_lines and block: bullets with their continuation lines, paragraphs, and table rows one by one.

    A running count of fence lines tells what is fenced; a running count of starts numbers the blocks. One note is
    one group, however many notes there are.
    """
    by_line = Window.partitionBy("stem").orderBy("line")
    up_to = by_line.rowsBetween(Window.unboundedPreceding, 0)
    s = F.col("s")
    fence = F.startswith(s, F.lit("```"))
    rows = numbered_lines(notes, heading).withColumn("fences", F.sum(fence.cast("int")).over(up_to))
    breaks = fence | (F.col("fences") % 2 == 1) | F.startswith(s, F.lit(">")) | F.startswith(s, F.lit("#")) | (s == "")
    table = F.startswith(s, F.lit("|"))
    bullet = F.regexp_like(s, F.lit(r"^(?:[-*] |[0-9]+\.\s)"))
    rows = rows.withColumn("out", breaks).withColumn("alone", table & ~breaks)
    before_open = ~F.coalesce(F.lag(F.col("out") | F.col("alone")).over(by_line), F.lit(True))
    starts = ~F.col("out") & (F.col("alone") | bullet | ~before_open)
    rows = rows.withColumn("n", F.sum(starts.cast("int")).over(up_to)).where("not out")
    held = rows.groupBy("stem", "n").agg(F.min("line").alias("line"), F.array_sort(F.collect_list(F.struct("line", "s"))).alias("l"))
    return held.select("stem", "line", F.size("l").cast("long").alias("n_lines"), F.array_join(F.transform("l", lambda x: x["s"]), " ").alias("block"))


def pairs(notes: DataFrame, documents: DataFrame, most: int | None = MAX_PAIRS, heading: str = VERIFIED) -> DataFrame:
    """ordinal, note, line, claim and bibcode: the first claims, or all, that cite a key whose text there is."""
    cited = blocks(notes, heading).withColumn("keys", F.filter(X.links(F.col("block")), X.is_key))
    raw = X.strip(F.regexp_replace("block", r"^(?:[-*+]|[0-9]+\.)\s+", ""))
    bare = F.replace(F.regexp_replace(raw, X.LINK, ""), F.lit("]]"), F.lit(""))
    said = cited.withColumn("raw", raw).where(F.length(bare) >= MIN_CLAIM)
    each = said.select("stem", "line", "raw", F.posexplode("keys").alias("k", "bibcode"))
    short = X.blind(X.clause_for(F.col("raw"), F.col("bibcode")))
    each = each.withColumn("claim", F.when(F.length(short) < MIN_CLAIM, X.blind(F.col("raw"))).otherwise(short))
    each = each.join(documents.select(F.col("stem").alias("bibcode")).distinct(), "bibcode", "left_semi")
    once = Window.partitionBy("stem", "claim", "bibcode").orderBy("line", "k")
    each = each.withColumn("r", F.row_number().over(once)).where("r = 1")
    each = each if most is None else each.orderBy("stem", "line", "k").limit(most)
    return numbered(each, "stem", "line", "k", name="ordinal").select("ordinal", F.col("stem").alias("note"), "line", "claim", "bibcode")


def _next_free(cited: DataFrame, by: list[str], keys: DataFrame) -> DataFrame:
    """`by`, i and free: for each ring place i that a group cites, the next place around the ring that it doesn't (null: none)."""
    of = Window.partitionBy(*by)
    rows = cited.select(*by, "i").distinct().withColumn("run", F.col("i") - F.row_number().over(of.orderBy("i")) + 1)
    rows = rows.withColumn("stop", F.max("i").over(Window.partitionBy(*by, "run")) + 1)
    first = F.coalesce(F.max(F.when(F.col("run") == 0, F.col("stop"))).over(of), F.lit(0))  # run 0 begins at place 0
    rows = rows.withColumn("first", first).withColumn("held", F.count(F.lit(1)).over(of)).join(F.broadcast(keys))
    free = F.when(F.col("held") < F.col("n"), F.when(F.col("stop") < F.col("n"), F.col("stop")).otherwise(F.col("first")))
    return rows.select(*by, "i", free.alias("free"))


def seed(real: DataFrame) -> DataFrame:
    """ordinal, note, line, claim, bibcode (another one, never cited with the claim) and tier.

    All keys of the selection stand in a ring; from a pair's own key on, the first that its note never cites is
    taken (tier 0), else the first that its line doesn't cite (tier 1). A pair without either is left out. Runs of
    cited places are skipped at once, so no pair meets the whole ring, and keys are numbered range by range.
    """
    keys = real.select("bibcode").where("bibcode is not null").distinct()
    ring = numbered(keys, "bibcode", name="i")
    size = keys.agg(F.count(F.lit(1)).alias("n"))
    own = real.join(ring, "bibcode")
    by_note = _next_free(own, ["note"], size).withColumnRenamed("free", "in_ring")
    by_line = _next_free(own, ["note", "line"], size).withColumnRenamed("free", "in_note")
    met = own.join(by_note, ["note", "i"]).join(by_line, ["note", "line", "i"])
    met = met.select("ordinal", "note", "line", "claim", F.coalesce("in_ring", "in_note").alias("i"), F.when(F.col("in_ring").isNull(), 1).otherwise(0).alias("tier"))
    return met.join(ring, "i").select("ordinal", "note", "line", "claim", "bibcode", "tier")


def shuffle_key(id_: Column, claim: Column) -> Column:
    """An order that looks random and is the same everywhere."""
    return F.sha1(F.concat_ws("|", id_, claim).cast("binary"))


def benchmark(real: DataFrame, false_: DataFrame) -> DataFrame:
    """Real and seeded pairs with ids, in shuffled order and without verdicts."""
    named = lambda rows, label: rows.select(F.concat(F.lit(label[0]), F.format_string("%03d", F.col("ordinal").cast("long"))).alias("id"), F.lit(label).alias("label"), "note", "line", "claim", "bibcode", F.lit(None).cast("string").alias("verdict"))
    rows = named(real, "real").unionByName(named(false_, "seeded"))
    return rows.orderBy(shuffle_key(F.col("id"), F.col("claim")))


def score(judged: DataFrame) -> DataFrame:
    """One row: seeded, caught, slipped, recall; real, consistent, control. Unknown verdicts raise an error.

    `unverifiable` is neither caught nor slipped, but a real pair judged so is consistent.
    """
    bad = judged.agg(F.count_if(~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False))).alias("n")).first().n
    if bad:
        raise ValueError(f"{bad} pairs have no verdict or an unknown one; allowed: {', '.join(VERDICTS)}")
    of = lambda label, verdicts: F.count_if((F.col("label") == label) & F.col("verdict").isin(*verdicts))
    one = judged.agg(F.count_if(F.col("label") == "seeded").alias("seeded"), of("seeded", CAUGHT).alias("caught"), of("seeded", SLIPPED).alias("slipped"), F.count_if(F.col("label") == "real").alias("real"), of("real", CAUGHT).alias("real_caught"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.round(F.col(a) / F.col(b), 6))
    one = one.withColumn("consistent", F.col("real") - F.col("real_caught"))
    return one.withColumn("recall", ratio("caught", "seeded")).withColumn("control", ratio("consistent", "real"))


def ladder(quotes: DataFrame, documents: DataFrame, shortest: int = 3, longest: int | None = None) -> DataFrame:
    """quote_id, doc, line and n: where the longest run of a quote's words stands in one segment of a document.

    As if runs of n words were tried from the whole quote (or `longest` words of it) down to `shortest`, from left
    to right, and the first hit won. Quotes and segments meet where they share `shortest` words and the words before
    differ, so a run that repeats is met once and not at each of its words, and from there the run goes on word by
    word. quotes: quote_id, quote. documents: doc, text.
    """
    split = lambda c: F.filter(F.split(F.lower(X.collapse(c)), " "), lambda w: w != "")
    # each place with the hash of its first words and the word before it, which is null at the beginning
    head = lambda i: F.struct(F.xxhash64(F.array_join(F.slice("w", i, F.lit(shortest)), " ")).alias("head"), F.get("w", i - 2).alias("prev"))
    heads = F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - shortest + 1), head)).alias("at", "h")
    q = quotes.select("quote_id", split(F.col("quote")).alias("w")).where(F.size("w") >= shortest)
    runs = q.select("quote_id", heads).select("quote_id", (F.col("at") + 1).alias("start"), F.col("h.head").alias("q_head"), F.col("h.prev").alias("q_prev"))
    lines = documents.select("doc", F.posexplode(X.segments(F.col("text"))).alias("line", "raw")).select("doc", "line", split(F.col("raw")).alias("w")).where(F.size("w") >= shortest)
    places = lines.select("doc", "line", heads).select("doc", "line", "at", "h.head", "h.prev")
    # only where both sides' words before differ: any other match goes on from one that begins earlier and is longer
    begins = F.col("prev").isNull() | F.col("q_prev").isNull() | (F.col("prev") != F.col("q_prev"))
    met = places.join(runs, (F.col("head") == F.col("q_head")) & begins).groupBy("quote_id", "doc", "line").agg(F.collect_list(F.struct("start", "at")).alias("seeds"))
    met = staged(met, "seeds")
    # now the words, once for each quote and line
    held = documents.join(met.select("doc").distinct(), "doc", "left_semi").select("doc", X.segments(F.col("text")).alias("s"))
    there = held.join(met, "doc").select("quote_id", "doc", (F.col("line") + 1).alias("line"), "seeds", split(F.get("s", F.col("line"))).alias("l")).join(q, "quote_id")
    most = F.lit(longest if longest is not None else (1 << 31) - 1)

    def reached(seed: Column) -> Column:
        n = F.least(F.size("w") - seed["start"] + 1, F.size("l") - seed["at"], most)
        parts = F.array_position(F.zip_with(F.slice("w", seed["start"], n), F.slice("l", seed["at"] + 1, n), lambda a, b: a != b), True)
        return F.struct((-F.when(parts > 0, parts - 1).otherwise(n)).cast("int").alias("m"), seed["start"].alias("start"))

    best = there.select("quote_id", "doc", "line", F.array_min(F.transform("seeds", reached)).alias("b")).where(F.col("b.m") <= -shortest)  # heads are hashes
    best = best.groupBy("quote_id", "doc").agg(F.min(F.struct("b.m", "b.start", "line")).alias("b"))
    return best.select("quote_id", "doc", F.col("b.line").alias("line"), (-F.col("b.m")).alias("n"))


def contradictions(claims: DataFrame) -> DataFrame:
    """Claims of different records on one entity and parameter: entity, parameter, n_records and the claims' keys.

    One row for each axis rather than all pairs of its claims.
    """
    held = claims.groupBy("entity", "parameter").agg(F.countDistinct("bibcode").alias("n_records"), F.array_sort(F.collect_set("bibcode")).alias("records"))
    return held.where("n_records > 1")


def contradicting(claims: DataFrame) -> DataFrame:
    """claims with n_apart: how many claims of other records on the same entity and parameter can't be true with it.

    claims: entity, parameter, bibcode, low, high (a value's interval, ends included). Two claims can't both be true
    if their intervals don't meet: one ends before the other begins. So each claim counts the ends before its begin
    and the begins after its end, over sorted ranges of an axis, and takes off those of its own record; no two claims
    are paired. A claim without an entity, a parameter or an end contradicts nothing; an empty interval is taken as
    its two ends the other way round.
    """
    ends = claims.withColumn("__low", F.least("low", "high")).withColumn("__high", F.greatest("low", "high")).withColumn("__low", F.when(F.col("low").isNull() | F.col("high").isNull(), None).otherwise(F.col("__low")))
    ends = ends.withColumn("__high", F.when(F.col("__low").isNotNull(), F.col("__high"))).withColumn("__n", F.lit(0).cast("long"))
    axis = F.when(F.col("entity").isNotNull() & F.col("parameter").isNotNull(), F.struct("entity", "parameter"))
    own = F.when(axis.isNotNull() & F.col("bibcode").isNotNull(), F.struct(axis.alias("axis"), "bibcode"))
    for key, sign in ((axis, 1), (own, -1)):
        rows = ends.withColumn("__axis", key)
        log = rows.where("__low is not null and __axis is not null")
        for point, other, strict, count in (("__low", "__high", True, "n_before"), ("__high", "__low", False, "n_after")):
            met = before(rows.withColumn("__t", F.col(point)), log.select("__axis", F.col(other).alias("__t")), "__axis", "__t", strict)
            rows = met.withColumn("__n", F.col("__n") + sign * F.col(count)).drop("__t", "n_before", "n_after", "last")
        ends = rows.drop("__axis")
    return ends.withColumnRenamed("__n", "n_apart").drop("__low", "__high")
