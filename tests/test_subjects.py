"""Names of all subjects, the positional index and staged discovery against plain restatements."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.operators import names, stages
from quillspark.sources import index
from quillspark.sources.index import Index


def contains_all(rows, aliases):
    flat = lambda t: re.sub(r"\s+", " ", t or "").strip().lower()
    out = set()
    for i, *texts in rows:
        for subject, name in aliases:
            m = re.fullmatch(r"([A-Za-z]{2,4})\s*([0-9][\w.+-]*)", (name or "").strip())
            forms = {flat(f"{m[1]} {m[2]}"), flat(m[1] + m[2])} if m else {flat(name)}
            bits = sum(1 << k for k, t in enumerate(texts) if any(f and f in flat(t) for f in forms))
            if bits:
                out.add((i, subject, bits))
    merged = {}
    for i, s, b in out:
        merged[i, s] = merged.get((i, s), 0) | b
    return merged


@pytest.mark.parametrize("block", [1 << 24, 30])
def test_names_of_all_subjects_as_by_contains(spark, block):
    r = random.Random(4)
    words = ["tau", "Cet", "HD", "123", "eps", "Eri", "b", "star", "Tau\tCet", "HD123"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(9))) if i % 9 else None, " ".join(r.choice(words) for _ in range(5))) for i in range(120)]
    aliases = [("s1", "tau  cet"), ("s1", "Star"), ("s2", "HD 123"), ("s3", "eps Eri"), ("s3", "tau Cet"), ("s4", "never said"), ("s5", ""), ("s6", None), (None, "star"), ("s7", "hd123 b")]
    found = names.mentioned(spark.createDataFrame(rows, "id int, a string, b string"), [F.col("a"), F.col("b")], spark.createDataFrame(aliases, "subject string, name string"), ["id"], block)
    got = [(x.id, x.subject, x.columns) for x in found.collect()]
    want = contains_all(rows, [a for a in aliases if a[0] and a[1]])
    assert len(got) == len(want) and {(i, s): b for i, s, b in got} == want


def test_ten_thousand_names_in_one_pass(spark):
    aliases = spark.range(10_000).select(F.col("id").alias("subject"), F.concat(F.lit("name "), F.format_string("%05d", "id"), F.lit(".")).alias("name"))
    rows = spark.createDataFrame([(1, "Name 00017. and NAME 09999., not name 10000."), (2, "x" * 100_000)], "id int, text string")
    found = names.mentioned(rows, [F.col("text")], aliases, ["id"])
    assert sorted((x.id, x.subject) for x in found.collect()) == [(1, 17), (1, 9999)]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_names_no_hits(spark):
    rows = spark.createDataFrame([(1, "a")], "id int, text string")
    assert names.mentioned(rows, [F.col("text")], spark.createDataFrame([], "subject long, name string"), ["id"]).count() == 0
    assert names.mentioned(rows.where("false"), [F.col("text")], spark.createDataFrame([(1, "a")], "subject long, name string"), ["id"]).count() == 0


def test_blocks_are_made_from_a_bounded_number_of_words(monkeypatch):
    r = random.Random(6)
    docs = [[r.choice("abcdefgh") for _ in range(r.choice([0, 1, 7, 120, 400]))] for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(docs, pa.list_(pa.string()))], ["doc", "words"])
    monkeypatch.setattr(index, "WORDS", 300)
    held = {}
    for b in index._blocks([batch, batch.slice(50)]):
        said = sum(len(p) for row in b.column("places").to_pylist() for p in row)
        assert said <= 300 or len({d for row in b.column("docs").to_pylist() for d in row}) == 1
        for term, ds, places in zip(*(c.to_pylist() for c in b.columns), strict=True):
            for d, p in zip(ds, places, strict=True):
                held.setdefault((term, d), []).append(p)
    want = {(t, d): [[i for i, x in enumerate(w) if x == t]] * (2 if d >= 50 else 1) for d, w in enumerate(docs) for t in set(w)}
    assert held == want


def scan(rows, queries):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for q, phrase in queries:
        p = words(phrase)
        for d, text in rows:
            w = words(text)
            at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p] if p else []
            if at:
                out[q, d] = at
    return out


@pytest.mark.parametrize("most", [0, 1000])
def test_index_of_repeats_empties_and_long_texts(spark, tmp_path, monkeypatch, most):
    """A doc given twice has the places of both texts, also after compaction and without a broadcast; texts without terms leave nothing."""
    monkeypatch.setattr("quillspark.sources.index.MOST_BROADCAST", most)
    index = Index(spark, str(tmp_path / "i"), buckets=4, parts=3)
    rows = [(1, "one two"), (1, "zero one two"), (2, None), (3, ""), (4, "... --"), (5, "one two " * 50_000), (6, "two one")]
    index.append(spark.createDataFrame(rows, "doc long, text string").repartition(5))
    index.append(spark.createDataFrame(rows[:2], "doc long, text string").where("doc < 0"))
    for _ in range(2):
        got = {r.doc: list(r.starts) for r in index.search(spark.createDataFrame([(1, "One two")], "query_id int, phrase string")).collect()}
        assert got == {1: [0, 1], 5: list(range(0, 100_000, 2))}
        assert {r.term: r.n_docs for r in index.document_counts().collect()} == {"zero": 1, "one": 4, "two": 4}
        index.compact()


def test_index_equals_a_scan(spark, tmp_path):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(["the", "the", "cat", "sat", "on", "mat", "Ünï", "x1"]) for _ in range(r.randrange(60)))) for i in range(80)] + [(90, None), (91, ""), (92, "the the the the")]
    queries = [(1, "the cat"), (2, "The, the"), (3, "ünï X1 the"), (4, "zebra cat"), (5, ""), (6, None), (7, "mat"), (8, "the cat sat on the mat"), (9, "the cat the"), (10, "the the the")]
    docs = spark.createDataFrame(rows, "doc long, text string")
    index = Index(spark, str(tmp_path / "i"), buckets=4)
    asked = spark.createDataFrame(queries, "query_id int, phrase string")
    found = lambda i: {(x.query_id, x.doc): x.starts for x in i.search(asked).collect()}
    assert found(index) == {}
    index.append(docs.where("doc < 40"))
    assert found(index) == scan(rows[:40], queries)
    index.append(docs.where("doc >= 40"))
    assert found(index) == scan(rows, queries) and len(index.batches()) == 2
    index.compact()
    assert found(Index(spark, str(tmp_path / "i"), buckets=4)) == scan(rows, queries) and len(index.batches()) == 1


def test_an_append_that_fails_is_never_seen(spark, tmp_path):
    index = Index(spark, str(tmp_path / "i"), buckets=4)
    index.append(spark.createDataFrame([(1, "one two")], "doc long, text string"))
    index._list, kept = (lambda *a: (_ for _ in ()).throw(RuntimeError("killed"))), index._list
    with pytest.raises(RuntimeError):
        index.append(spark.createDataFrame([(2, "one two")], "doc long, text string"))
    index._list = kept
    got = index.search(spark.createDataFrame([(1, "one two")], "query_id int, phrase string")).collect()
    assert [(x.doc, x.starts) for x in got] == [(1, [0])]


RECORD = "bibcode string, ordinal long, title string, abstract string, text string, citation_count long, relevant boolean"


def run(spark, records, aliases, edges=(), extra=(), decisions=(), topics=(), **more):
    table = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    subjects = sorted({(s, False) for s, _ in aliases} | {(s, True) for s, _ in topics})
    return stages.discover(table(subjects, "subject string, is_topic boolean"), table(aliases, "subject string, name string"), table(records, RECORD), table(edges, "src string, dst string"), table(extra, "subject string, bibcode string"), table(decisions, "subject string, bibcode string, decision string"), table(topics, "subject string, bibcode string"), **more)


def rows_of(found):
    return sorted((x.subject, x.stage, x.via, x.bibcode, x.relevant, x.gate) for x in found.rows.collect())


RECORDS = [
    ("a", 1, "On tau Cet", None, None, 9, True), ("b", 2, "A survey", "with tau  Cet", None, 8, False), ("c", 3, "Rotation", None, "a table lists tau Cet", 7, True),
    ("d", 4, "tau Cet again", None, None, 1, True), ("e", 5, "On ϵ Eri", None, None, 6, True), ("f", 6, "On eps Eri", None, None, 5, True), ("g", 7, "Eri in the south", None, None, 4, True),
    ("h", 8, "Discs", None, "eps Eri and tau Cet", 3, True), ("i", 9, "Noise", None, "tau Cet", 2, False), ("j", 10, None, None, None, None, True),
]
NAMES = [("tc", "tau Cet"), ("ee", "eps Eri")]


def test_stages_seed_each_other_and_bring_new_keys_only(spark):
    edges = [("b", "c"), ("a", "c"), ("a", "d"), ("c", "a"), ("a", "i"), ("e", "h"), ("h", "e"), ("h", "a"), ("a", None), (None, "a")]
    found = run(spark, RECORDS, NAMES, edges, extra=[("tc", "b"), ("tc", "zz"), ("tc", "g"), ("tc", "a"), ("nobody", "a")], decisions=[("tc", "h", "discarded"), ("ee", "h", "accepted")])
    assert rows_of(found) == sorted([
        ("tc", 0, "query", "a", True, "accepted"), ("tc", 0, "query", "d", True, "accepted"), ("tc", 0, "manual", "b", True, "accepted"), ("tc", 1, "manual", "g", True, "accepted"),
        ("tc", 3, "chain:references", "c", True, "pending"), ("tc", 3, "chain:citations", "h", True, "suppressed"),
        ("ee", 0, "query", "f", True, "accepted"), ("ee", 2, "glyph", "e", True, "accepted"), ("ee", 3, "chain:references", "h", True, "pending"),
    ])
    assert [(x.subject, x.bibcode) for x in found.missing.collect()] == [("tc", "zz")]
    assert found.empty.count() == 0 and found.cut.count() == 0


def test_the_gate_is_for_stars_and_lets_titles_in(spark):
    records = [*RECORDS, ("k", 11, "tau Cet rotates", "no", None, 0, True)]
    aliases = [*NAMES, ("rot", "Rotation")]
    edges = [("c", "k"), ("c", "h")]
    found = run(spark, records, aliases, edges, topics=[("disc", "a"), ("disc", "c"), ("disc", "h")])
    got = rows_of(found)
    assert ("disc", 0, "query", "h", True, "accepted") in got and not [x for x in got if x[0] == "disc" and x[1] == 3]
    records = [r if r[0] != "g" else (*r[:5], 60, True) for r in records]
    found = run(spark, records, aliases, [("a", "k"), ("f", "h")], rows=1)
    assert ("tc", 3, "chain:references", "k", True, "accepted") in rows_of(found)  # its title says the subject
    assert sorted((x.subject, x.stage, x.letter, x.num_found) for x in found.cut.collect()) == [("ee", 2, "epsilon", 3), ("tc", 0, None, 4)]
    assert not [x for x in rows_of(found) if x[2] == "glyph"]  # the superset is cut before the glyph filter


def test_a_subject_without_hits_keeps_nothing(spark):
    found = run(spark, RECORDS, [*NAMES, ("none", "no such star")], extra=[("none", "a")])
    assert [x.subject for x in found.empty.collect()] == ["none"] and not [x for x in rows_of(found) if x[0] == "none"]
    assert rows_of(run(spark, [], NAMES)) == [] and rows_of(run(spark, RECORDS, [])) == []


def test_folding_equals_the_plain_pattern(spark):
    blanks = [chr(k) for k in range(0x3100) if chr(k).isspace() or k in (0x180E, 0x200B, 0x200E, 0x2010, 0x2060, 0x3001)]
    rows = [(f"{b}A{b}{b} B{c}Ü{b}",) for b in blanks for c in ("", " ", "\n", "\u3000")] + [("",), (None,), ("  ",), ("Ab  c",)]
    got = spark.createDataFrame(rows, "t string").select(names.folded(F.col("t")).alias("a"), F.lower(X.collapse(F.col("t"))).alias("b")).collect()
    assert len(got) == len(rows) and all(x.a == x.b for x in got)


def test_texts_are_asked_about_reached_keys_only(spark, tmp_path):
    path = str(tmp_path / "run")
    names = [(f"s{k}", f"name{k:02d} x") for k in range(20)]
    every = " ".join(n for _, n in names)  # each text says all names, each title its own
    records = [(f"r{k}", k, names[k][1], None, every, k, True) for k in range(20)]
    records += [("silent", 20, "none", None, None, 1, True), ("other", 21, "none", None, "name00  X", 1, False)]
    found = stages.discover(spark.createDataFrame([(s, False) for s, _ in names], "subject string, is_topic boolean"), spark.createDataFrame(names, "subject string, name string"), spark.createDataFrame(records, RECORD), spark.createDataFrame([("r0", "r7"), ("r0", "silent"), ("r0", "other"), ("r9", "r0")], "src string, dst string"), spark.createDataFrame([], "subject string, bibcode string"), spark.createDataFrame([], "subject string, bibcode string, decision string"), path=path)
    chained = [x for x in rows_of(found) if x[1] == 3]
    assert chained == [("s0", 3, "chain:citations", "r9", True, "pending"), ("s0", 3, "chain:references", "r7", True, "pending"), ("s7", 3, "chain:citations", "r0", True, "pending"), ("s9", 3, "chain:references", "r0", True, "pending")]
    assert spark.read.parquet(f"{path}/said").count() == 20  # not the 400 pairs of names and texts


def test_a_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "run")
    whole = rows_of(run(spark, RECORDS, NAMES, [("a", "c")], path=path))
    monkeypatch.setattr(stages, "_said", lambda *a: spark.read.parquet(f"{path}/said"))
    monkeypatch.setattr(stages, "mentioned", lambda *a: spark.createDataFrame([], "bibcode string, ordinal long, citation_count long, relevant boolean, subject string, columns int"))
    assert rows_of(run(spark, [], NAMES, [("a", "c")], path=path, triage=False)) == [(*x[:5], "accepted") for x in whole]  # nothing is searched again


def test_top_of_a_hot_group_is_exact(spark):
    rows = spark.range(5000).select(F.lit(1).alias("subject"), F.col("id").cast("string").alias("bibcode"), F.col("id").alias("ordinal"), (F.col("id") * 7919 % 1000).alias("citation_count"))
    got = sorted((x.citation_count, -x.ordinal) for x in stages.top(rows, ["subject"], 30).collect())
    assert got == sorted(((i * 7919 % 1000, -i) for i in range(5000)))[-30:]
    assert {(x.num_found, x.truncated) for x in stages.top(rows, ["subject"], 30).collect()} == {(5000, True)}
