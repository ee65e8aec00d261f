"""Scalar expressions over strings and dates. Each takes and returns Columns and stays in generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a Unicode-aware class, with the separators that counting by character also leaves out.
SPACE = r"[\s\x{a0}\x1c-\x1f\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x85]"
#: The same, one by one.
BLANKS = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Thresholds of legibility and of page layout.
MIN_ASCII_SHARE, MIN_CHARS, MIN_CHARS_PAGE = 0.85, 200, 200
USEFUL_LINE, GUTTER, MULTI_COLUMN = 40, 8, 0.30
#: What a sentence begins with after a full stop, marks at the edges of a claim, least and most characters
#: of a bold lead-in.
SENTENCE_HEADS, EDGE_MARKS, LEAD_IN = "A-ZÁÉÍÓÚÑ¿¡([*", " :;,–—", (2, 80)
#: Keys of catalogue records start with a year and a letter.
KEY = r"^[0-9]{4}[A-Za-z]"
LINK = r"\[\[([^\]|#]+)"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def collapse(text: Column) -> Column:
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def is_key(text: Column) -> Column:
    return F.regexp_like(text, F.lit(KEY))


def links(text: Column) -> Column:
    """Targets of all wiki links, in order, without label or anchor."""
    return F.transform(F.regexp_extract_all(text, F.lit(LINK), F.lit(1)), strip)


def arxiv_id(identifiers: Column) -> Column:
    """The first identifier of the form arXiv:..., without the prefix."""
    pattern = r"(?i)^arXiv:(\S+)"
    found = F.filter(identifiers, lambda x: F.regexp_like(x, F.lit(pattern)))
    return F.regexp_extract(F.get(found, F.lit(0)), pattern, 1)


def name_variants(name: Column) -> Column:
    """A catalogue designation with and without the space; any other name as it is."""
    pattern = r"^([A-Za-z]{2,4})\s*([0-9][\w.+-]*)$"
    n = strip(name)
    head, tail = F.regexp_extract(n, pattern, 1), F.regexp_extract(n, pattern, 2)
    return F.when(F.regexp_like(n, F.lit(pattern)), F.array(F.concat_ws(" ", head, tail), F.concat(head, tail))).otherwise(F.array(n))


def expand_variants(names: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(names, name_variants)))


def safe_name(key: Column) -> Column:
    return F.translate(key, "/", "_")


def blind(text: Column) -> Column:
    """A claim without its links, so that it can be judged by content only."""
    bare = F.regexp_replace(text, r"\[\[[^\]]*\]\]", "")
    return F.trim(F.regexp_replace(bare, f"{SPACE}+", " "), F.lit(EDGE_MARKS))


def sentences(text: Column) -> Column:
    """Cut after a full stop and space where a capital, a bracket or a bold mark follows."""
    heads = SENTENCE_HEADS.replace("[", r"\[")
    return F.split(text, rf"(?<=\.)\s+(?=[{heads}])")


def clause_for(block: Column, key: Column) -> Column:
    """The lead-in and those sentences of a block that cite the key; the block where it can't be cut."""
    bold = r"\*\*"
    lead = rf"\A({bold}[^*]{{{LEAD_IN[0]},{LEAD_IN[1]}}}{bold}:?)\s*"
    parts = sentences(F.regexp_replace(block, lead, ""))
    own = F.filter(parts, lambda s: F.contains(s, F.concat(F.lit("[["), key)))
    cut = strip(F.concat_ws(" ", F.nullif(F.regexp_extract(block, lead, 1), F.lit("")), F.array_join(own, " ")))
    return F.when((F.size(parts) < 2) | (F.size(own) == 0), block).otherwise(cut)


def parse_year(text: Column) -> Column:
    """The first four digits that stand alone, as an integer."""
    return F.nullif(F.regexp_extract(text, r"(?<![0-9])([0-9]{4})(?![0-9])", 1), F.lit("")).try_cast("int")


def parse_int(text: Column) -> Column:
    return strip(text).try_cast("int")


def eprint_stamp(text: Column) -> Column:
    """The eprint version that a text's first page carries, '' where it has none, null without a stamp."""
    head = F.substring(text, 1, 4000)
    pattern = r"(?i)arXiv:\s*([0-9]{4}\.[0-9]{4,5}|[a-z-]+(?:\.[A-Z]{2})?/[0-9]{7})(v[0-9]+)?"
    return F.when(F.regexp_like(head, F.lit(pattern)), F.regexp_extract(head, pattern, 2))


def snapshot_date(text: Column) -> Column:
    """The date in a `retrieved:` line among the first eight lines."""
    pattern = r"^retrieved\s*:\s*([0-9]{4}-[0-9]{2}-[0-9]{2})"
    found = F.filter(F.slice(F.split(text, "\n"), 1, 8), lambda x: F.regexp_like(x, F.lit(pattern)))
    return F.nullif(F.regexp_extract(F.get(found, F.lit(0)), pattern, 1), F.lit(""))


#: Media elements that hold no prose.
MEDIA = ("video", "audio", "picture", "iframe", "svg")


#: Stands for a piece of text that a pattern shall not look into; no text holds this code point, which is none.
_HELD = "\ufdd0"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _without_element(text: Column, tag: str) -> Column:
    """text and n: the text without `<tag ...>...</tag>`, and how many went.

    A match has to end with a closing tag, so everything after the last one is set aside first, and so is what stands
    between that one and the last `>` before it, where no opening tag can end. In what is left each opening tag has
    its closing tag, so no search for one fails, and the time is linear in the text, however many are unclosed.
    """
    pattern = rf"(?is)<{tag}\b[^>]*>.*?</{tag}>"
    same = lambda t: F.struct(t.alias("text"), F.lit(0).alias("n"))

    def cut(t: Column) -> Column:
        head = F.regexp_extract(t, rf"(?is)\A.*</{tag}>", 0)
        before = F.left(head, F.length(head) - len(tag) - 3)
        upto = F.regexp_extract(before, r"(?s)\A.*>", 0)
        parts = F.struct(F.concat(upto, F.lit(_HELD), F.right(head, F.lit(len(tag) + 3))).alias("work"), F.substr(before, F.length(upto) + 1).alias("held"), F.substr(t, F.length(head) + 1).alias("tail"))
        return bound(parts, lambda p: F.struct(F.concat(F.replace(F.regexp_replace(p["work"], pattern, ""), F.lit(_HELD), p["held"]), p["tail"]).alias("text"), F.regexp_count(p["work"], F.lit(pattern)).alias("n")))

    return bound(text, lambda t: F.when(F.regexp_like(t, F.lit(rf"(?i)</{tag}>")), cut(t)).otherwise(same(t)))


def clean_markup(text: Column, blocks: tuple[str, ...] = MEDIA, voids: tuple[str, ...] = ("source", "track")) -> tuple[Column, Column]:
    """The text without media elements and with at most one empty line in a row; and how many elements went."""

    def without(done: Column, tag: str) -> Column:
        return bound(done, lambda d: bound(_without_element(d["text"], tag), lambda x: F.struct(x["text"].alias("text"), (d["n"] + x["n"]).alias("n"))))

    done = F.struct(text.alias("text"), F.lit(0).alias("n"))
    for tag in blocks:
        done = without(done, tag)
    if voids:
        pattern = rf"(?i)<(?:{'|'.join(voids)})\b[^>]*>"
        # without a `>` after it no tag ends, and none is looked for
        ends = lambda t: F.regexp_extract(t, r"(?s)\A.*>", 0)
        done = bound(done, lambda d: bound(ends(d["text"]), lambda h: F.struct(F.concat(F.regexp_replace(h, pattern, ""), F.substr(d["text"], F.length(h) + 1)).alias("text"), (d["n"] + F.regexp_count(h, F.lit(pattern))).alias("n"))))
    return F.concat(strip(F.regexp_replace(done["text"], r"\n{3,}", "\n\n")), F.lit("\n")), done["n"]


def date_parts(parts: Column) -> Column:
    """[2021, 5, 3] as 2021-05-03; a date of fewer parts stays shorter, no parts are null."""
    text = F.transform(parts, lambda p, i: F.when(i == 0, p.cast("string")).otherwise(F.lpad(p.cast("string"), 2, "0")))
    return F.when(F.size(parts) > 0, F.array_join(text, "-"))


def unmasked(value: Column) -> Column:
    """Null for null, NaN and the usual marks of no value; else the value as text."""
    text = strip(value.cast("string"))
    return F.when(~F.lower(text).isin("", "--", "none", "nan", "masked"), text)


def number(value: Column) -> Column:
    return unmasked(value).try_cast("double")


def table_cell(text: Column, width: int = 70) -> Column:
    """One line of at most so many characters, with bars escaped after the cut."""
    return F.replace(F.substring(collapse(text), 1, width), F.lit("|"), F.lit("\\|"))


def title_says_retracted(title: Column) -> Column:
    t = F.lower(strip(F.coalesce(title, F.lit(""))))
    starts = [F.startswith(t, F.lit(p)) for p in ("retracted", "retraction:", "retracted article", "withdrawn")]
    return starts[0] | starts[1] | starts[2] | starts[3]


def host_allowed(url: Column, suffix: str) -> Column:
    """Whether a token may go to this URL's host."""
    return F.coalesce(F.endswith(F.try_parse_url(url, F.lit("HOST")), F.lit(suffix)), F.lit(False))


def in_dir(path: Column, name: str) -> Column:
    return F.array_contains(F.split(path, "/"), name)


def verdict_of_text(text: Column) -> Column:
    """ok, almost empty, watermark (too little text a page) or mojibake; the first that holds, in this order."""
    n = F.length(F.regexp_replace(text, SPACE, ""))
    feeds = F.regexp_count(text, F.lit(r"\f"))
    pages = F.when(feeds == 0, 1).otherwise(feeds)
    share = F.length(F.regexp_replace(text, "[^!-~]", "")) / n
    return F.when(n < MIN_CHARS, "almost empty").when((pages >= 2) & (n / pages < MIN_CHARS_PAGE), "watermark").when(share < MIN_ASCII_SHARE, "mojibake").otherwise("ok")


def all_lines(text: Column) -> Column:
    """Lines cut wherever a reader of text would: also at form feeds and the separators; no empty last line."""
    parts = F.split(text, "\r\n|[\n\r\\f\\x0b\\x1c-\\x1e\\x85\\x{2028}\\x{2029}]")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def has_gutter(line: Column) -> Column:
    return F.regexp_like(line, F.lit(rf"\S {{{GUTTER},}}\S"))


def ends_hyphenated(line: Column) -> Column:
    return F.regexp_like(line, F.lit(rf"\p{{L}}-{SPACE}*+\z"))


def joined_lines(text: Column) -> Column:
    """The text with words that are split at a line's end put together, for finding a quote; never to be stored."""
    return F.regexp_replace(text, r"(?<=\p{L})-[ \t]*+\n[ \t]*+(?=\p{Ll})", "")


def segments(text: Column) -> Column:
    """Lines cut at gutters, blank segments dropped: what may be searched without joining columns."""
    cut = F.flatten(F.transform(F.split(text, "\n"), lambda line: F.split(line, f" {{{GUTTER},}}")))
    return F.filter(cut, lambda s: strip(s) != "")


def grep_line(lines: Column, quote: Column) -> Column:
    """The first line (from 1) that holds the quote, both collapsed and lower-cased; 0 for none."""
    q = F.lower(collapse(quote))
    return F.array_position(F.transform(lines, lambda s: F.contains(F.lower(collapse(s)), q)), True)


def rescue_hint(bibstem: Column, year: Column) -> Column:
    """Where a document that the resolver doesn't give may be found."""
    stem = strip(F.coalesce(bibstem, F.lit("")))
    return (
        F.when(F.startswith(stem, F.lit("Msngr")), "open archive of the journal")
        .when(F.startswith(stem, F.lit("SPIE")), "the instrument's page of papers, or an academic mirror")
        .when(F.startswith(stem, F.lit("A&A")) & (parse_int(year) < 2005), "no preprint and a closed site: ask for institutional access")
        .otherwise("academic mirror, the publisher's table server, or ask for the document")
    )


def frontmatter_parts(text: Column) -> tuple[Column, Column, Column]:
    """Head, body and status (none, open, closed) of a note that may start with a `---` block."""
    parts = F.split(text, "---", 3)
    starts = F.startswith(text, F.lit("---"))
    closed = starts & (F.size(parts) == 3)
    head, body = F.when(closed, F.get(parts, F.lit(1))), F.when(closed, F.get(parts, F.lit(2))).otherwise(text)
    return head, body, F.when(~starts, "none").when(closed, "closed").otherwise("open")
