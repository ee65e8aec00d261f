"""Personal data by weak supervision, with DataFrame operations only.

Base spans are fixed patterns with checks. Around them, wider patterns and failed base matches give candidates;
four labelers vote on each (its form, a gazetteer of providers and prefixes, words just before it, the kind's own
check). Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability without
any truth. The posteriors train a logistic span classifier, whose inputs beside the votes are of the text: the
span's shape and size, the character after it, and the word before it; so a candidate that no context word
vouches for can still be told by its surroundings. Candidates that it is sure of are added where they don't cross
a base span; failed base matches too, but only beside a context word. Learning reads a table of candidates; the texts are read once for it.

Positions come from pieces between matches: a match starts after all pieces and matches before it. Running sums
are taken in blocks, so a text of many matches costs little more than their number.

The patterns say the same as the plain ones but never recurse or rescan: a run that can't be left is taken
possessively, and a match starts only where a run starts.

Defined cases: a null text is empty and has no spans. Repeated rows, and rows without doc_id, are read each for
itself. Of added spans that cross, the kind listed first stays, then the earlier, then the longer. Very long texts
are read whole. An empty table gives no rows; without candidates nothing is added. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.shared import staged

KINDS = ("email", "ip", "card", "phone")
#: Leftmost, non-overlapping.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates beyond the base patterns.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\])\x20?[a-z0-9-]{1,64}+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[a-z0-9-]{1,64}+){1,4}+",
    "ip": r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}+:){4,7}+[0-9a-f]{1,4}+(?![0-9a-f:])",
    "phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
_GUARDS = {"email": r"@|(?i)[(\[]at[)\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
#: What a form labeler asks for, providers and prefixes of the gazetteer, and words before a span.
FORMS = {"email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9.-]{1,250}\.[A-Za-z]{2,24}$", "ip": r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$", "card": r"^([0-9]{4}[\x20-]?){3}[0-9]{1,7}$|^[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}$", "phone": r"^\+?[0-9]{0,3}[\x20.-]?(\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}$"}
GAZETTEER = {"email": r"(?i)(\.|dot[)\]]\x20?)(com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$", "ip": r"^(?!0\.|127\.|255\.)", "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)", "phone": r"^(\+[1-9]|\(?[2-9])"}
CONTEXT = {"email": r"(?i)(e-?mail|contact|write to|reach)\W*\w*\W*$", "ip": r"(?i)\b(ip|host|server|address|addr)\W*\w*\W*$", "card": r"(?i)\b(card|visa|mastercard|amex|credit|payment)\W*\w*\W*\w*\W*$", "phone": r"(?i)\b(phone|tel|telephone|call|fax|mobile|cell)\W*\w*\W*\w*\W*$"}
ABSTAIN, NO, YES = 0, 1, 2
#: Characters before a span that the context labeler reads, and the score from which on a candidate is added.
CONTEXT_CHARS, SURE = 40, 0.9
_BLOCK = 64

#: Patterns of inputs that are learned from as they are.
MOST_PATTERNS = 20_000
#: Values that the word before a span is hashed to, and shapes: which of these stand in a span.
WORDS, MARKS = 24, (".", "-", "(", " ")

SPAN = "struct<kind:int,start:int,end:int,base:boolean,form:int,known:int,context:int,check:int,size:int,shape:int,after:int,word:int>"


def let(value: Column, use) -> Column:
    """use(value), with value computed once: inside a lambda an expression would else be computed for each element."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def running_sum(values: Column) -> Column:
    """For each element of an integer array the sum of those before it, block by block. values is a lambda's variable."""
    add = lambda a, b: a + b
    zero = F.lit(0)
    starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), F.lit(_BLOCK))).otherwise(F.array().cast("array<int>"))

    def spread(blocks: Column) -> Column:
        def by_total(totals: Column) -> Column:
            def one(block: Column, k: Column) -> Column:
                return let(F.aggregate(F.slice(totals, F.lit(1), k), zero, add), lambda before: F.transform(block, lambda _, i: before + F.aggregate(F.slice(block, F.lit(1), i), zero, add)))

            return F.flatten(F.transform(blocks, one))

        return let(F.transform(blocks, lambda b: F.aggregate(b, zero, add)), by_total)

    return let(F.transform(starts, lambda s: F.slice(values, s, F.lit(_BLOCK))), spread)


def located(text: Column, pattern: str) -> Column:
    """An array of (match, start, before, after): each match, its first code point, the text between it and the last
    one, and the character after it."""

    def placed(held: Column) -> Column:
        starts = let(F.transform(held, lambda h: h["n"]), running_sum)
        return F.zip_with(held, starts, lambda h, s: F.struct(h["match"].alias("match"), (s + F.length(h["before"])).alias("start"), h["before"].alias("before"), h["after"].alias("after")))

    def paired(matches: Column) -> Column:
        def zipped(pieces: Column) -> Column:
            nexts = F.transform(F.slice(pieces, F.lit(2), F.size(matches)), lambda p: F.substring(p, 1, 1))
            both = F.arrays_zip(matches.alias("m"), F.slice(pieces, F.lit(1), F.size(matches)).alias("p"), nexts.alias("a"))
            return F.transform(both, lambda x: F.struct(x["m"].alias("match"), x["p"].alias("before"), x["a"].alias("after"), (F.length(x["p"]) + F.length(x["m"])).alias("n")))

        return let(F.split(text, pattern, -1), zipped)

    return let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), paired), placed)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check; every second digit from the right counts double."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    places = F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), value)
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def passes(kind: str, match: Column) -> Column:
    """The kind's own check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        value = lambda p: F.regexp_replace(p, "^0+", "")
        small = lambda p: (F.length(value(p)) < 3) | ((F.length(value(p)) == 3) & (value(p) <= "255"))
        return F.forall(F.split(match, r"\."), small)
    digits = _digits(match)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def _vote(yes: Column) -> Column:
    return F.when(yes, YES).otherwise(NO)


def _shape(match: Column) -> Column:
    """Which MARKS stand in a span, as bits."""
    total = F.lit(0)
    for k, mark in enumerate(MARKS):
        total = total + F.when(F.contains(match, F.lit(mark)), 1 << k).otherwise(0)
    return total


def _after(char: Column) -> Column:
    """0 at the text's end, 1 for blanks, 2 for letters and digits, 3 for anything else."""
    return F.when(char == "", 0).when(F.regexp_like(char, F.lit(r"\s")), 1).when(F.regexp_like(char, F.lit(r"[\p{L}\p{N}]")), 2).otherwise(3)


def _word(before: Column) -> Column:
    """The word before a span, hashed; 0 for none."""
    word = F.regexp_extract(F.lower(F.right(before, F.lit(CONTEXT_CHARS))), r"(\p{L}+)[^\p{L}]*$", 1)
    return F.when(word == "", 0).otherwise(F.crc32(word.cast("binary")) % (WORDS - 1) + 1).cast("int")


def _judged(kind: str, number: int, base: bool):
    """What turns a located match into a SPAN."""

    def span(h: Column) -> Column:
        match, start = h["match"], h["start"].cast("int")
        ok = passes(kind, match) if base else F.lit(False)
        return F.struct(
            F.lit(number).alias("kind"), start.alias("start"), (start + F.length(match)).alias("end"), ok.alias("base"),
            _vote(F.regexp_like(match, F.lit(FORMS[kind]))).alias("form"), _vote(F.regexp_like(match, F.lit(GAZETTEER[kind]))).alias("known"),
            F.when(F.regexp_like(F.right(h["before"], F.lit(CONTEXT_CHARS)), F.lit(CONTEXT[kind])), YES).otherwise(ABSTAIN).alias("context"),
            (_vote(ok) if base else F.lit(ABSTAIN)).alias("check"), F.least(F.length(match) / 4, F.lit(8)).cast("int").alias("size"),
            _shape(match).alias("shape"), _after(h["after"]).alias("after"), _word(h["before"]).alias("word"),
        )

    return span


def spans_of(text: Column) -> Column:
    """All base matches and candidates of a text, as an array of SPAN."""
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for number, kind in enumerate(KINDS):
        for base, pattern in ((True, PATTERNS[kind]), (False, WIDE.get(kind))):
            if pattern is not None:
                found = F.transform(located(text, pattern), _judged(kind, number, base)).cast(f"array<{SPAN}>")
                parts.append(F.when(F.regexp_like(text, F.lit(_GUARDS[kind])), found).otherwise(none))
    return F.concat(*parts)


_VOTES, _WORTH = ("form", "known", "context", "check"), np.array([1, 1, 1, 3])


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 30) -> dict[tuple[int, ...], float]:
    """For each vote pattern (kind, votes ...) the posterior that it is a true span.

    A labeler is told by how often it votes yes, no or not at all on true and on other spans; these rates are
    pooled over kinds, so a rare kind is judged by what the labelers are worth elsewhere.
    """
    keys = list(counts)
    n = np.array([counts[k] for k in keys], float)
    votes = np.array([k[1:] for k in keys])
    kinds = np.array([k[0] for k in keys])
    lean = ((votes == YES) * _WORTH).sum(1) - ((votes == NO) * _WORTH).sum(1)  # where the search starts: a check is worth more than a form
    post = 1 / (1 + np.exp(-lean.astype(float)))
    for _ in range(rounds):
        log = np.zeros((len(keys), 2))
        for c, p in enumerate((1 - post, post)):
            for k in np.unique(kinds):
                own = kinds == k
                log[own, c] += np.log(((n * p)[own].sum() + 1) / (n[own].sum() + 2))
            for labeler in range(votes.shape[1]):
                rate = np.array([(n * p)[votes[:, labeler] == v].sum() + 1 for v in (ABSTAIN, NO, YES)])
                log[:, c] += np.log(rate / rate.sum())[votes[:, labeler]]
        post = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
    return dict(zip(keys, post.tolist(), strict=True))


def _inputs() -> list[tuple[str, int]]:
    """The classifier's inputs: column and value, each 1 or 0."""
    return [(v, x) for v in _VOTES for x in (NO, YES)] + [("kind", k) for k in range(len(KINDS))] + [("size", s) for s in range(9)] + [("shape", s) for s in range(1 << len(MARKS))] + [("after", a) for a in range(4)] + [("word", k) for k in range(WORDS)]


def train(rows: list[dict], target: np.ndarray, weight: np.ndarray, steps: int = 25, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps on soft labels; the last coefficient is the bias."""
    x = np.array([[float(r[c] == v) for c, v in _inputs()] + [1.0] for r in rows])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + ridge * w
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w


def _score(w: np.ndarray, span: Column) -> Column:
    total = F.lit(float(w[-1]))
    for (c, v), k in zip(_inputs(), w[:-1], strict=True):
        total = total + F.when(span[c] == v, float(k)).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id and all spans of each row; written once."""
    return staged(documents.select("doc_id", spans_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("found")), "pii")


def patterns_of(found: DataFrame, most: int = MOST_PATTERNS) -> DataFrame:
    """Each pattern of inputs with its count n: the `most` most frequent, or a few less, as they are, all others with the
    word before and the shape left out, of which there are at most 4 kinds x 81 votes x 9 sizes x 4 characters after."""
    names = ("kind", *_VOTES, "size", "shape", "after", "word")
    counts = found.select(F.explode("found").alias("s")).groupBy(*[F.col(f"s.{c}").alias(c) for c in names]).agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts, "patterns")
    if counts.count() <= most:
        return counts
    least = counts.orderBy(F.desc("n")).limit(most).agg(F.min("n")).first()[0]
    fold = [F.when(F.col("n") > least, F.col(c)).otherwise(0).alias(c) if c in ("shape", "word") else F.col(c) for c in names]
    return counts.select(*fold, "n").groupBy(*names).agg(F.sum("n").alias("n"))


def classifier(found: DataFrame, most: int = MOST_PATTERNS) -> np.ndarray | None:
    """Coefficients learned from the counts of patterns of inputs, of which there is a bounded number."""
    names = ("kind", *_VOTES, "size", "shape", "after", "word")
    counts = patterns_of(found, most).orderBy(*names).collect()
    if not counts:
        return None
    patterns: dict[tuple[int, ...], int] = {}
    key = lambda r: (r["kind"], *(r[v] for v in _VOTES))
    for r in counts:
        patterns[key(r)] = patterns.get(key(r), 0) + r["n"]
    post = reliabilities(patterns)
    return train([r.asDict() for r in counts], np.array([post[key(r)] for r in counts]), np.array([float(r["n"]) for r in counts]))


def resolved(found: Column, w: np.ndarray | None, sure: float = SURE) -> Column:
    """base and added of one row's candidates: arrays of spans, by kind and start."""
    place = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    crosses = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    ahead = lambda a, b: F.struct(a["kind"], a["start"], -a["end"]) < F.struct(b["kind"], b["start"], -b["end"])

    def added(base: Column) -> Column:
        if w is None:
            return F.filter(base, lambda s: F.lit(False))
        heard = lambda s: (s["check"] != NO) | (s["context"] == YES)  # noqa: E731  what fails its check needs a word that vouches for it
        more = F.filter(found, lambda s: ~s["base"] & heard(s) & (_score(w, s) >= sure) & ~F.exists(base, lambda b: crosses(s, b)))
        first = lambda m: F.filter(m, lambda s: ~F.exists(m, lambda o: ahead(o, s) & crosses(s, o)))
        return let(F.transform(more, place), lambda m: F.array_sort(first(m)))

    return let(F.array_sort(F.transform(F.filter(found, lambda s: s["base"]), place)), lambda base: F.struct(base.alias("base"), added(base).alias("added")))


def spans(documents: DataFrame, sure: float = SURE) -> DataFrame:
    """doc_id, base and added: arrays of spans, by kind and start."""
    found = candidates(documents)
    both = resolved(F.col("found"), classifier(found), sure)
    return found.select("doc_id", both.alias("spans")).select("doc_id", "spans.base", "spans.added")


def listed(array: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(documents: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every row."""
    out = spans(documents)
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [number(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    every = F.array_sort(F.concat("base", "added"))
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(every).alias("spans"))


def masked(documents: DataFrame, sure: float = SURE) -> DataFrame:
    """doc_id and the text with every span replaced by its kind in angle brackets, of every row; null texts stay null."""
    w = classifier(candidates(documents))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = documents.select("doc_id", F.col("text").cast("string").alias("text"), resolved(spans_of(text), w, sure).alias("spans"))
    every = F.array_sort(F.concat("spans.base", "spans.added"))
    by_place = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    empty = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def cut(done: Column, s: Column) -> Column:
        name = F.element_at(F.array(*[F.lit(f"<{k}>") for k in KINDS]), s["kind"] + 1)
        clean = F.substring(F.col("text"), done["at"] + 1, s["start"] - done["at"])
        return F.when(s["start"] < done["at"], done).otherwise(F.struct(F.concat(done["text"], clean, name).alias("text"), s["end"].alias("at")))

    merged = F.aggregate(by_place, empty, cut, lambda d: F.concat(d["text"], F.substring(F.col("text"), d["at"] + 1, F.length("text"))))
    return found.select("doc_id", merged.alias("text"))
