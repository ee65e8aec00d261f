"""The subset of a catalogue's query language that stored queries use, compiled to a Column.

title:"..." abs:"..." full:"..." bibcode:"..." and bare phrases; AND, OR, parentheses, AND by juxtaposition;
references(...) and citations(...) become semi-joins with the edges. Precedence: AND before OR.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as X

_TOKEN = re.compile(r'\s*(?:(?P<op>AND\b|OR\b|\(|\))|(?P<hop>references|citations)\(|(?:(?P<field>[a-z_]+):)?(?:"(?P<phrase>[^"]*)"|(?P<word>[^\s()"]+)))')
FIELDS = {"title": ("title",), "abs": ("title", "abstract", "keyword"), "full": ("text",), "bibcode": ("bibcode",), "year": ("year",)}


class QueryError(ValueError):
    """A query that can't be read."""


@dataclass(frozen=True)
class Term:
    field: str
    phrase: str


@dataclass(frozen=True)
class Hop:
    direction: str
    inner: object


@dataclass(frozen=True)
class Both:
    op: str
    parts: tuple


def parse(query: str):
    """The query as a tree of Term, Hop and Both."""
    tokens, at = [], 0
    while at < len(query.rstrip()):
        m = _TOKEN.match(query, at)
        if not m:
            raise QueryError(f"can't read the query from: {query[at : at + 20]}")
        if m["op"]:
            tokens.append(m["op"])
        elif m["hop"]:
            tokens += [m["hop"], "("]
        else:
            tokens.append(Term(m["field"] or "abs", m["phrase"] if m["phrase"] is not None else m["word"]))
        at = m.end()

    def either(i):
        parts = []
        part, i = every(i)
        parts.append(part)
        while i < len(tokens) and tokens[i] == "OR":
            part, i = every(i + 1)
            parts.append(part)
        return (parts[0] if len(parts) == 1 else Both("OR", tuple(parts))), i

    def every(i):
        part, i = one(i)
        parts = [part]
        while i < len(tokens) and tokens[i] not in ("OR", ")"):
            part, i = one(i + (tokens[i] == "AND"))
            parts.append(part)
        return (parts[0] if len(parts) == 1 else Both("AND", tuple(parts))), i

    def one(i):
        if i >= len(tokens) or tokens[i] in ("AND", "OR", ")"):
            raise QueryError("a term is missing")
        t = tokens[i]
        if t in ("references", "citations"):
            inner, j = one(i + 1)
            return Hop(t, inner), j
        if t == "(":
            inner, j = either(i + 1)
            if j >= len(tokens) or tokens[j] != ")":
                raise QueryError("a bracket isn't closed")
            return inner, j + 1
        return t, i + 1

    tree, end = either(0)
    if end != len(tokens):
        raise QueryError("a bracket is closed that wasn't opened")
    return tree


def predicate(tree, columns: list[str]) -> Column:
    """A tree without hops as a test of a record."""
    if isinstance(tree, Both):
        tests = [predicate(p, columns) for p in tree.parts]
        out = tests[0]
        for t in tests[1:]:
            out = (out & t) if tree.op == "AND" else (out | t)
        return out
    if isinstance(tree, Hop):
        raise QueryError("references() and citations() need the edges: use select()")
    if tree.field not in FIELDS:
        raise QueryError(f"unknown field: {tree.field}")
    names = [c for c in FIELDS[tree.field] if c in columns]
    if not names:
        raise QueryError(f"the table has none of: {', '.join(FIELDS[tree.field])}")
    if tree.field in ("bibcode", "year"):
        return F.col(names[0]) == tree.phrase
    phrase = F.lit(f" {tree.phrase.lower()} ")
    words = lambda c: F.concat(F.lit(" "), F.lower(X.collapse(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[^\w.+-]+", " "))), F.lit(" "))
    out = F.contains(words(names[0]), phrase)
    for c in names[1:]:
        out = out | F.contains(words(c), phrase)
    return out


def select(records: DataFrame, edges: DataFrame, query: str) -> DataFrame:
    """The records that a query names; hops are semi-joins, so keys come once."""

    def keys(tree) -> DataFrame:
        if isinstance(tree, Hop):
            inner = keys(tree.inner)
            a, b = ("src", "dst") if tree.direction == "references" else ("dst", "src")
            return edges.join(inner.withColumnRenamed("bibcode", a), a, "left_semi").select(F.col(b).alias("bibcode")).distinct()
        if isinstance(tree, Both) and any(_hops(p) for p in tree.parts):
            out = keys(tree.parts[0])
            for p in tree.parts[1:]:
                out = out.join(keys(p), "bibcode", "left_semi") if tree.op == "AND" else out.union(keys(p)).distinct()
            return out
        return records.where(predicate(tree, records.columns)).select("bibcode").distinct()

    return records.join(keys(parse(query)), "bibcode", "left_semi")


def _hops(tree) -> bool:
    return isinstance(tree, Hop) or isinstance(tree, Both) and any(map(_hops, tree.parts))
