import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from brute import ALNUM, FOLD, ODD, PLAIN, contamination, lines, near_classes, pii, rules, words
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import decontam, lm, mixing, near, substring, tokens, toxicity
from quillspark.llm import lines as line_ops
from quillspark.llm import pii as pii_ops
from quillspark.llm import rules as rule_ops
from quillspark.llm.cuckoo import CuckooFilter

DOC = "doc_id long, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, DOC)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(r.choice("abcdefgh") + str(r.randrange(vocabulary)) for _ in range(n))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbé \t\n.1😀", max_size=40), max_size=6))
def test_words_are_those_of_the_pattern(texts):
    for inside, pattern in ((tokens.PLAIN, PLAIN), (tokens.ALNUM, ALNUM)):
        got = []
        for _, b in tokens.batches(pa.array(texts, pa.string()), step=16):
            starts, ends, first = b.words(inside)
            raw = b.buf.tobytes()
            got += [[raw[starts[k] : ends[k]].decode().translate(FOLD) for k in range(first[i], first[i + 1])] for i in range(b.n)]
        assert got == [words(t, pattern, fold=True) for t in texts]


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    b = next(tokens.batches(pa.array(["x Word word longerword", "word"])))[1]
    starts, ends, _ = b.words(tokens.PLAIN)
    h = b.hashes(starts, ends, fold=True)
    assert h[1] == h[2] == h[4] and len(set(h.tolist())) == 3
    assert b.hashes(starts, ends, fold=False)[1] != h[1]
    whole = b.hashes(starts, ends, fold=True)
    monkeypatch.setattr(tokens, "PIECE", 4)  # words longer than a piece are hashed block by block
    tokens._powers.cache_clear()
    assert (b.hashes(starts, ends, fold=True) == whole).all()
    tokens._powers.cache_clear()


def test_rule_counts(spark):
    out = {r.doc_id: r for r in rule_ops.document_stats(table(spark, ODD)).withColumn("bad", rule_ops.base_failed()).collect()}
    for i, text in ODD:
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.bad) == rules(text), i


def test_decision_list_learns_precise_rules():
    r = np.random.default_rng(0)
    x = {"a": r.random(3000), "b": r.random(3000), "noise": r.random(3000)}
    bad = (x["a"] > 0.8) & (x["b"] < 0.5) | (x["a"] < 0.05)
    got = rule_ops.learn(x, bad).applies(x)
    assert (got & bad).sum() > 0.9 * bad.sum() and (got & ~bad).sum() < 0.03 * got.sum()
    assert rule_ops.learn(x, np.zeros(3000, bool)).rules == ()


def test_rules_without_labels_and_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rule_ops.judged(table(spark, ODD), labels).count() == len(ODD)
    assert rule_ops.judged(table(spark, []), labels).count() == 0
    extra = table(spark, [(1, prose(1, 80)), (2, "short")]).withColumn("n_words", __import__("pyspark").sql.functions.lit("mine"))
    assert [(r.doc_id, r.n_words) for r in rule_ops.filtered(extra, labels).collect()] == [(1, "mine")]


def test_kept_is_what_the_list_says(spark):
    r = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        bad = i % 4 == 0
        w = prose(i, 80, 10**6).split()
        rows.append((i, " ".join(f"{x} #|$" if bad and r.random() < 0.5 else x for x in w)))
        labels.append((i, int(not bad)))
    rows += [(5000 + i, t) for i, t in ODD] + [(None, prose(1, 90, 10**6)), (None, None), (3, rows[3][1])]
    df, marks = table(spark, rows), spark.createDataFrame([*labels, (None, 0), (7, None), (99_999, 0)], "doc_id long, quality int")
    list_ = rule_ops.fit(df, marks)
    assert list_.rules and list_ == rule_ops.fit(df.repartition(7), marks)
    got = rule_ops.judged(df, marks).collect()
    assert len(got) == len(rows)
    for x in got:
        features = {name: np.array([f(lambda c, x=x: float(x[c]))]) for name, f in rule_ops.FEATURES.items()}
        assert x.kept == (not x.base_failed and not list_.applies(features)[0])
    held = [x for x in got if x.doc_id is not None and x.doc_id < 900]
    assert sum(x.kept == (x.doc_id % 4 != 0) for x in held) > 0.97 * len(held)
    clash = df.selectExpr("*", "'a' as s", "1 as n_words", "2 as quality")
    assert rule_ops.filtered(clash, marks).count() == sum(x.kept for x in got) and rule_ops.filtered(clash, marks).columns == clash.columns


def test_line_dedup_like_brute_force(spark):
    rows = [*ODD, (13, "unique text of its own\n  SAME LINE here\t\nend"), (14, "short\nshort"), (15, "short"), (13, "unique text of its own\n  SAME LINE here\t\nend")]
    want = lines(rows)
    got = line_ops.deduplicated(table(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r["__q_lines"]) == want[r.doc_id], r.doc_id


def test_line_dedup_is_reversible_and_incremental(spark):
    one, two = [(1, "a shared line\nown line one"), (2, "A SHARED line \nown line two")], [(3, "a shared line\nown line three")]
    store = line_ops.LineStore.empty(spark).insert(table(spark, one)).insert(table(spark, two))
    kept = lambda s, rows: {r.doc_id: r["__q_lines"].n_dropped for r in line_ops.deduplicated(table(spark, rows), s).collect()}
    assert kept(store, one + two) == {1: 0, 2: 1, 3: 1}
    store = store.delete(table(spark, one[:1]))
    assert kept(store, one[1:] + two) == {2: 0, 3: 1}
    store = store.delete(table(spark, one[1:]))
    assert kept(store, two) == {3: 0}
    assert store.counts().agg({"n_docs": "max"}).first()[0] == 1


def test_line_filters_follow_insertions_and_deletions(spark, monkeypatch):
    """Changed in place, filters answer as ones that are built anew from the exact table, and hold as many marks."""
    monkeypatch.setattr(line_ops, "SHARD_KEYS", 16)
    r = random.Random(3)
    rows = {i: "\n".join(f"a line of number {r.randrange(60)}" for _ in range(12)) for i in range(40)}
    part = lambda ids: table(spark, [(i, rows[i]) for i in ids])
    store = line_ops.LineStore.empty(spark).insert(part(range(10)))
    held = set(range(10))
    built = []
    monkeypatch.setattr(line_ops.LineStore, "_built", lambda self, old=line_ops.LineStore._built: built.append(1) or old(self))
    for come, gone in (((10, 11, 12), ()), ((), (0, 3, 11)), ((13, 14, 3), ()), ((), (1, 2, 4, 5, 6, 7, 12)), (range(15, 18), ())):
        store = store.insert(part(come)) if come else store.delete(table(spark, [(i, "") for i in gone]))
        held = held | set(come) - set(gone) if come else held - set(gone)
        anew = line_ops.LineStore.empty(spark).insert(part(sorted(held)))
        cells = lambda s: {x.shard: CuckooFilter.load(bytes(x.cells)) for x in s.filters.collect()}
        mine, theirs = cells(store), cells(anew)
        keys = np.array([x.key_lo for x in anew.shared.collect()], np.int64).view(np.uint64)
        assert store.keys == anew.keys == len(keys) == sum(int((f.table > 0).sum()) for f in mine.values())
        assert all(mine[int(k) % store.shards].maybe(np.array([k]))[0] for k in keys)
        got = {x.doc_id: tuple(x["__q_lines"]) for x in line_ops.deduplicated(part(sorted(held)), store).collect()}
        assert got == lines([(i, rows[i]) for i in sorted(held)])
    assert len(built) < 10  # five are those built for comparison
    assert len(store.log) == 6


def test_line_filters_grow_where_they_are_too_full(spark, monkeypatch):
    monkeypatch.setattr(line_ops, "SHARD_KEYS", 1 << 15)
    some = [(i, "\n".join(f"a line of number {k}" for k in range(6))) for i in range(2)]
    more = [(i, "\n".join(f"a line of number {k}" for k in range(300))) for i in range(2, 4)]
    store = line_ops.LineStore.empty(spark).insert(table(spark, some)).insert(table(spark, more))
    assert store.keys == 300 and store.filters.count() == 1
    got = {x.doc_id: tuple(x["__q_lines"]) for x in line_ops.deduplicated(table(spark, some + more), store).collect()}
    assert got == lines(some + more)


def test_line_dedup_of_rows_without_id(spark):
    rows = [(None, "a line that is held\nown line of one"), (None, "own line of two\na line that is held"), (None, None), (5, "a line that is held"), (5, "another text here\nA LINE that is held  "), (None, "x" * 200_000 + "\na line that is held")]
    got = sorted((r.doc_id or 0, *r["__q_lines"]) for r in line_ops.deduplicated(table(spark, rows)).collect())
    assert got == sorted([(0, 2, 1, "own line of one"), (0, 2, 1, "own line of two"), (0, 1, 0, ""), (5, 1, 0, "a line that is held"), (5, 2, 0, "another text here\nA LINE that is held  "), (0, 2, 1, "x" * 200_000)])


def test_line_stage_keeps_columns_and_drops_copies(spark):
    df = spark.createDataFrame([(1, "one line of text\nlast", 21, "a"), (2, "one line of text", 16, "b"), (3, None, 0, "c")], "doc_id long, text string, n_chars long, key_hi string")
    assert [tuple(r) for r in line_ops.filtered(df).orderBy("doc_id").collect()] == [(1, "one line of text\nlast", 21, "a"), (3, None, 0, "c")]


def test_cuckoo_filters_hold_and_forget():
    keys = tokens.mix(np.arange(1, 5001, dtype=np.uint64))
    f = CuckooFilter.of(keys[:3000])
    probe = lambda f, k: f.maybe(k)
    assert probe(f, keys[:3000]).all() and probe(f, keys[3000:]).mean() < 0.01
    for k in keys[:1500]:
        assert f.delete(k)
    f = CuckooFilter.load(f.dump())
    assert probe(f, keys[1500:3000]).all() and probe(f, keys[:1500]).mean() < 0.01


@pytest.mark.parametrize("block", [decontam.BLOCK_WINDOWS, 4])
def test_decontamination_like_brute_force(spark, block):
    passage = prose(3, 30)
    items = [(1, passage), (2, "Short Item, here"), (3, None), (4, "..."), (5, passage), (None, prose(9, 12)), (6, "a b c d e f g h i j k"), (7, "one")]
    docs = [*ODD, (20, "x " + passage.upper() + " y"), (21, " ".join(passage.split()[5:17])), (22, "a short   item--HERE a short item"), (23, prose(9, 12)), (24, " ".join(passage.split()[:9]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs += [(25, "z " + passage + " z " + prose(9, 12)), (26, prose(88, 50_000) + " " + passage)]
    clash = table(spark, docs + docs[-2:-1]).selectExpr("*", "'x' as h", "1 as n_hit", "2 as item_id")
    assert {tuple(r["__q_hits"])[:4] for r in decontam.marked(clash, bench, block).where("doc_id = 25").collect()} == {contamination(docs[-2][1], items)}
    got = decontam.marked(table(spark, docs), bench, block).collect()
    assert len(got) == len(docs)
    for r in got:
        h = r["__q_hits"]
        assert (h.n_words, h.n_hit, h.n_items, h.items_sha256) == contamination(dict(docs)[r.doc_id], items), r.doc_id
    clean = {r.doc_id for r in decontam.filtered(table(spark, docs), bench).collect()}
    assert clean == {i for i, t in docs if contamination(t, items)[1] == 0}


def test_decontamination_without_items(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.marked(table(spark, ODD), empty).where("__q_hits.n_hit > 0").count() == 0
    assert decontam.marked(table(spark, []), empty).count() == 0


def near_rows():
    r = random.Random(5)
    rows = list(ODD)
    for g in range(4):
        base = prose(100 + g, 120).split()
        for k in range(6):
            w = list(base)
            for _ in range(k):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            rows.append((100 * (g + 1) + k, " ".join(w)))
        rows.append((100 * (g + 1) + 50, " ".join(base).upper()))
    # a cloud of many texts around the limit, wider than a small bucket
    base = prose(7, 150).split()
    for k in range(40):
        w = list(base)
        for _ in range(3):
            w[r.randrange(len(w))] = f"odd{r.randrange(9999)}"
        rows.append((1000 + k, " ".join(w)))
    return rows


def test_near_classes_like_brute_force(spark, monkeypatch):
    rows = near_rows()
    monkeypatch.setattr(near, "BLOCK", 8)
    monkeypatch.setattr(near, "ROWS", 3)
    monkeypatch.setattr(near, "PART", 2)
    got = {r.id: r.class_id for r in near.classes(table(spark, rows)).collect()}
    assert got == near_classes(rows)
    kept = {r.doc_id for r in near.filtered(table(spark, rows)).collect()}
    assert kept == {i for i, c in near_classes(rows).items() if i == c}


def test_near_empty_and_nulls(spark):
    assert near.classes(table(spark, [])).count() == 0
    got = sorted((r.id, r.class_id) for r in near.classes(table(spark, [(None, "a b c"), (5, "a b c"), (6, ""), (7, "")])).collect())
    assert got == [(5, 5), (6, 6), (7, 7), (near.ordered_id.__globals__["LAST_ID"], 5)]


def test_near_texts_that_share_an_id(spark):
    copied, alone, twice = prose(31, 90), prose(32, 60), prose(33, 80)
    rows = [(1, copied), (None, copied + " end"), (None, alone), (2, twice), (None, twice + " end"), (None, "")]
    rows += [(None, prose(34, 70)), (None, prose(34, 70) + " end")]  # alike, and neither has an id: one of them stays
    kept = [r.text for r in near.filtered(table(spark, rows)).collect()]
    assert sorted(x for x in kept if not x.startswith(prose(34, 70))) == sorted([copied, alone, twice, ""]) and len(kept) == 5
    last = near.ordered_id.__globals__["LAST_ID"]
    got = sorted((r.class_id, r.stays) for r in near.classes(table(spark, rows)).collect() if r.id == last)
    assert got == [(1, False), (2, False), (last, False), (last, True), (last, True), (last, True)]


def test_signatures_estimate_weighted_similarity():
    a = prose(1, 400).split()
    b = a[:300] + prose(2, 100).split()
    batch = next(tokens.batches(pa.array([" ".join(a), " ".join(b)])))[1]
    s, e, first = batch.words(tokens.PLAIN)
    text, el, weight = near.weighted(batch.hashes(s, e, True), first)
    sig = near.signatures(text, el, weight, 2000)
    x, y = set(el[text == 0].tolist()), set(el[text == 1].tolist())
    assert abs((sig[0] == sig[1]).mean() - len(x & y) / len(x | y)) < 0.05


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=40), st.lists(st.integers(0, 40), max_size=40))
def test_parity_bitmaps_never_rule_out_what_is_alike(x, y):
    sets = [np.unique(tokens.mix(np.array(v, np.uint64))) for v in (x, y)]
    if not all(map(len, sets)):
        return
    size = np.array([len(v) for v in sets])
    flat, width = near.parities(np.concatenate(sets), size)
    group = {"size": size, "class_id": np.array([1, 2]), "side": np.zeros(2, int), "width": width, "start": np.cumsum(width) - width, "marks": flat}
    both = len(set(x) & set(y))
    least = both / (len(set(x)) + len(set(y)) - both)
    assert sum(len(x) for x, _, _ in near._may_be(group, least)) == 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    assert {r.id: r.class_id for r in near.components(links).collect()} == {i: 1 for i in range(2, 61)} | {101: 100}


def test_substring_removes_later_passages(spark):
    passage = prose(11, 60)
    rows = [*ODD, (30, prose(1, 40) + " " + passage + " " + prose(2, 40)), (31, "head words " + passage.upper() + "\n" + prose(4, 50)), (32, prose(5, 200)), (33, prose(6, 30) + "\n" + passage)]
    got = [r for r in substring.removed_spans(table(spark, rows)).collect()]
    hit = {r.id: r for r in got if r.id >= 30}
    assert set(hit) == {31, 33} and all(r.first_id == 30 and r.words >= 30 for r in hit.values())
    for r in hit.values():
        assert dict(rows)[r.id][r.start : r.end].lower() in passage.lower()
    clean = {r.doc_id: r.text for r in substring.cleaned(table(spark, rows)).collect()}
    assert clean[32] == dict(rows)[32] and clean[31] == dict(rows)[31][: hit[31].start] + dict(rows)[31][hit[31].end :]
    assert substring.removed_spans(table(spark, [])).count() == 0


def test_substring_removes_whole_lines(spark):
    short, middle = "All rights reserved", prose(21, 20)
    rows = [(1, prose(22, 30) + "\n" + short + "\n" + prose(23, 30) + "\n" + middle), (2, prose(24, 30) + "\n" + short + "!\n" + middle.upper() + "\n" + prose(25, 30)), (3, "Five words of a text"), (4, "five words of a text."), (5, prose(26, 300) + "\n" + prose(27, 40)), (6, prose(26, 300) + "\n" + prose(28, 40))]
    got = {r.id: (r.words, r.first_id, dict(rows)[r.id][r.start : r.end]) for r in substring.removed_spans(table(spark, rows)).collect()}
    assert set(got) == {2, 4, 6}
    assert got[2] == (23, 1, short + "!\n" + middle.upper()) and got[4] == (5, 3, "five words of a text") and got[6] == (300, 5, prose(26, 300))


def test_substring_texts_that_share_an_id(spark):
    one, two = prose(41, 40), prose(42, 40)
    rows = [(None, prose(43, 30) + "\n" + one + "\n" + prose(44, 20)), (None, prose(45, 90) + "\n" + one + "\n" + two), (7, two + "\n" + prose(46, 30)), (8, one + " x"), (8, prose(47, 20) + "\n" + two)]
    clean = sorted((r.text for r in substring.cleaned(table(spark, rows + rows[:1])).collect()), key=len)
    assert len(clean) == 6
    assert sum(one in t for t in clean) == 1 and sum(two in t for t in clean) == 1  # each stays in one text, in its lowest id
    assert any(t.startswith(two) for t in clean) and any(t == one + " x" for t in clean)
    texts = {t for _, t in rows}
    for r in substring.removed_spans(table(spark, rows)).collect():
        assert any(len(t[r.start : r.end]) == r.end - r.start and t[r.start : r.end] in one + "\n" + two for t in texts)


def test_substring_like_brute_force_of_lines(spark):
    """Lines of words that never repeat inside others: what goes is each line's later occurrence."""
    r = random.Random(9)
    pool = [prose(500 + i, r.randrange(3, 60), 10**6) for i in range(40)]
    rows = [(i, "\n".join(r.choice(pool) if r.random() < 0.4 else prose(10_000 + 50 * i + k, r.randrange(2, 40), 10**6) for k in range(r.randrange(1, 9)))) for i in range(60)]
    rows += [*((i + 100, t) for i, t in ODD), (200, ("word " * 30 + "\n") * 3), (201, prose(77, 60_000, 10**6))]
    gone = {}
    for r_ in substring.removed_spans(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, id int")).collect():
        gone.setdefault(r_.id, set()).update(range(r_.start, r_.end))
    first = {}
    for i, text in sorted(rows):
        if i >= 100:
            continue
        at = 0
        for line in text.split("\n"):
            held = first.setdefault(line, (i, at))
            cover = {k for k in range(at, at + len(line))}
            if held == (i, at):
                assert not cover & gone.get(i, set()), (i, line)
            elif held[0] != i:
                assert cover <= gone.get(i, set()), (i, line)
            at += len(line) + 1
    assert 201 not in gone


def test_pii_base_spans(spark):
    rows = [*ODD, (20, "a@b.c%d@e.f x@y foo@bar@baz.com"), (21, "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 0000255.1.1.1"), (22, "9" * 20_000), (23, "a@" + "b." * 4_000 + "c"),
            (24, "+1 (988) 555-2485 +12 3 +1....2 é4539 1488 0343 6467😀 4539148803436468"), (25, "1.2.3.4 " * 500), (26, "1" + "-1" * 9_000), (27, "mail bob (at) host dot com or (269) 555-3296")]
    rows = [(i, t) for i, t in rows]
    got = {r.doc_id: r for r in pii_ops.digest(table(spark, rows)).collect()}
    for i, t in rows:
        want = pii(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), i
        assert [got[i][f"n_{k}"] for k in pii_ops.KINDS] == [sum(w.startswith(k) for w in want) for k in pii_ops.KINDS]
        assert set(want) <= set(got[i].spans.split(",") if got[i].spans else [])
    assert pii_ops.digest(table(spark, [])).count() == 0
    assert pii_ops.digest(table(spark, [(1, None)])).first().spans == ""


def test_pii_added_spans(spark):
    r = random.Random(4)
    number = lambda: f"({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}"
    rows = [(i, f"{prose(i, 12)} please call {number()} now, or mail me at user{i}@host{i % 9}.com today") for i in range(200)]
    rows += [(300 + i, f"{prose(i, 8)} phone +1 ({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)} soon") for i in range(200)]
    rows += [(600 + i, f"the version 999.{i}.{300 + i}.1 of {prose(i, 9)}") for i in range(100)]  # no addresses
    rows += [(800 + i, f"visa card 4539 1488 0343 64{i:02} of {prose(i, 9)}") for i in range(20)]  # one mistyped digit, but named
    got = {x.doc_id: x for x in pii_ops.digest(table(spark, rows)).collect()}
    added = {i: set(got[i].spans.split(",")) - set(pii(t)) - {""} for i, t in rows}
    for i, t in rows:
        if i < 200:
            start = t.index("(")
            assert added[i] == {f"phone:{start}:{start + 14}"}, i
        if 600 <= i < 800:
            assert not added[i]
        if i >= 800 and not any(x.startswith("card") for x in pii(t)):
            assert {x.split(":")[:2][1] for x in added[i] if x.startswith("card")} == {"10"}, i


def test_pii_masked_keeps_every_row(spark):
    rows = [(None, "mail a@b.com now"), (None, None), (1, "x@y.org"), (1, "no data here"), (2, ""), (2, "z@w.net é 1.2.3.4")]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, found string")
    assert sorted(map(str, ((r.doc_id, r.text) for r in pii_ops.masked(df).collect()))) == sorted(map(str, [(None, "mail <email> now"), (None, None), (1, "<email>"), (1, "no data here"), (2, ""), (2, "<email> é <ip>")]))


def test_reliabilities_trust_those_who_agree():
    votes = {(0, 2, 2, 0, 2): 500, (0, 1, 1, 0, 1): 500, (0, 2, 2, 0, 1): 5, (0, 2, 1, 2, 0): 20}
    post = pii_ops.reliabilities(votes)
    assert post[(0, 2, 2, 0, 2)] > 0.95 and post[(0, 1, 1, 0, 1)] < 0.05


def test_mixing_targets_and_order(spark):
    rows = [(i, "w " * (10 + i % 7), s) for i in range(60) for s in ("b",)] + [(100 + i, "w " * 5, "a") for i in range(4)] + [(200, None, "c"), (201, "w w", None), (201, "w w", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    assert len(out) == len(rows) and all(0 <= r.taken <= 2 * r["size"] for r in out)
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    total = sum(r["size"] for r in out)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for v in by.values():
        assert v[0].target <= 2 * v[0].source_size and sum(r.taken for r in v) == int(v[0].target)
    places = [r.positions[0] for r in out if r.positions[0] is not None]
    assert places == sorted(places) and 0 <= places[0] <= places[-1] <= 1
    again = mixing.mix(df).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mixing.mix(df.where("false")).count() == 0
    assert [r.position for r in mixing.schedule(df).collect()] == sorted(r.position for r in mixing.schedule(df).collect())


def test_mixing_of_copies_and_rows_without_id(spark):
    rows = [(None, "w " * (3 + i % 4), "a") for i in range(40)] + [(7, "w w w", "a")] * 30 + [(8, "w " * 30_000, "b"), (8, None, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, n int, place int")
    out = mixing.mix(df).collect()
    assert sorted((r.doc_id or -1, r["size"], r.source or "") for r in out) == sorted((i or -1, len((t or "").split()), s or "") for i, t, s in rows)
    for source in ("a", "b"):
        own = [r for r in out if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target) and own[0].source_size == sum(r["size"] for r in own)
        at = sorted(p for r in own for p in r.positions if p is not None)
        assert all(x < y for x, y in zip(at, at[1:], strict=False))  # each copy has a place of its own


def test_toxicity_learns_and_generalises(spark):
    r = random.Random(2)
    docs, labels = [], []
    for i in range(900):
        w = prose(i, 40).split()
        if i % 6 == 0:
            for k in range(3):
                w[r.randrange(40)] = r.choice(["vile", "nasty", "rotten"]) + r.choice(["", "er", "est"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(i % 6 == 0)))
    docs += [(10_000 + i, t) for i, t in ODD]
    df, lab = table(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.scored(df, lab, l1=2.0).collect()
    assert len(out) == len(docs) and all(0 <= x.score <= 1 for x in out)
    held = [x for x in out if x.held_out and x.doc_id < 900]
    assert sum(x.predicted == (x.doc_id % 6 == 0) for x in held) > 0.95 * len(held)
    away = [(i, 1) for i in range(900) if __import__("zlib").crc32(str(i).encode()) % 4 == 2] + [(77_777, 1), (None, 1), (3, None)]
    for left in (away, away[:5], away[-3:]):  # labels, but none that may be learned from
        out = toxicity.scored(df, spark.createDataFrame(left, "doc_id long, toxic int")).agg({"score": "max", "predicted": "max"}).first()
        assert tuple(out) == (0, 0)
    odd = spark.createDataFrame([(None, "vile", 1, 2), (1, "again", 1, 2), (1, "again", 1, 2), (1, prose(1, 90_000), 1, 2)], "doc_id long, text string, label int, toxic int")
    assert toxicity.scored(odd, spark.createDataFrame([(1, 1), (1, 0), (None, 1)], "doc_id long, toxic int")).count() == 4
    none = toxicity.scored(df, lab.where("false")).agg({"score": "max"}).first()[0]
    assert none == 0 and toxicity.scored(df.where("false"), lab).count() == 0


def layer(seed, size=90):
    r = np.random.default_rng(seed)
    counts = r.random(size) * 50
    cls, cell, share = lm.classed(counts)
    w = lm.initial(cls, cell, counts)
    w["g"] += (r.standard_normal(w["g"].shape) * 0.2).astype(np.float32)
    return r, lm.Model(cls, cell, share, w)


def test_attention_gradients():
    r, m = layer(0)
    w = {k: v.astype(np.float64) for k, v in m.weights.items()}
    ids, valid = r.integers(0, 90, (2, 2 * lm.STRIDE)), np.ones((2, 2 * lm.STRIDE), bool)
    valid[0, :5] = False
    goal, scored = r.integers(0, 90, (2, lm.STRIDE)), np.ones((2, lm.STRIDE), bool)
    scored[1, 3] = False
    run = lambda w: lm.gradients(w, ids, valid, m.cls[goal], m.cell[goal], scored)
    g = run(w)[1]
    for name in ("q", "k", "v", "o", "u", "b", "p", "g", "t", "c"):
        for _ in range(3):
            at = tuple(int(r.integers(0, n)) for n in w[name].shape)
            if name in "gc":
                at = (int(m.cls[goal[0, 0]]), at[1])
            loss = []
            for step in (1e-5, -1e-5):
                moved = w | {name: w[name].copy()}
                moved[name][at] += step
                loss.append(run(moved)[0])
            assert g[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-5, abs=2e-4), name


def test_quick_logs_are_those_of_the_whole_pass():
    r, m = layer(1)
    ids, valid = r.integers(0, 90, (50, 2 * lm.STRIDE)), np.ones((50, 2 * lm.STRIDE), bool)
    valid[::3, : lm.STRIDE] = False
    valid[1::7, lm.STRIDE + 4 :] = False
    goal = r.integers(0, 90, (50, lm.STRIDE))
    for scale in (1, 40):  # with large weights exponentials would overflow
        big = lm.Model(m.cls, m.cell, m.log_share, {k: v * np.float32(scale) if k in "quk" else v for k, v in m.weights.items()})
        one, two, _ = lm.forward(big.weights, ids, valid, m.cls[goal])
        row = np.arange(goal.size)
        want = (one[row, m.cls[goal].reshape(-1)] + two[row, m.cell[goal].reshape(-1)] + m.log_share[goal].reshape(-1)).reshape(goal.shape)
        on = valid[:, lm.STRIDE :]
        assert np.allclose(lm.Scorer(big)(ids, valid, goal)[on], want[on], rtol=1e-3, atol=1e-2 * scale)


def test_probabilities_of_all_ids_add_up_to_one():
    r, m = layer(2, 5000)  # more ids than cells
    ids, valid = np.repeat(r.integers(0, 5000, (1, 2 * lm.STRIDE)), 313, 0), np.ones((313, 2 * lm.STRIDE), bool)
    ids[:, 1 + lm.STRIDE :] = ids[:, lm.STRIDE : lm.STRIDE + 1]
    goal = np.resize(np.arange(5000), (313, lm.STRIDE))
    ids = np.repeat(ids[:1], 5000, 0)  # one place, asked for every id
    goal = np.zeros((5000, lm.STRIDE), int)
    goal[:, 7] = np.arange(5000)
    got = np.concatenate([lm.Scorer(m)(ids[:500], valid[:1].repeat(500, 0), goal[i : i + 500])[:, 7] for i in range(0, 5000, 500)])
    assert np.exp(got.astype(float)).sum() == pytest.approx(1, abs=1e-3)


def naive_score(m, ids):
    """log10 probability of a text's ids, one id at a time, with the window that holds it."""
    w, total = {k: v.astype(float) for k, v in m.weights.items()}, 0.0
    for place, goal in enumerate(ids):
        start = max(0, place // lm.STRIDE * lm.STRIDE - lm.STRIDE)
        read = [len(m.cls) if j == 0 else ids[j - 1] for j in range(start, place + 1)]
        slot = lm.STRIDE - (place // lm.STRIDE * lm.STRIDE - start)
        x = np.array([w["e"][i] + w["p"][slot + j] for j, i in enumerate(read)])
        a = np.exp((x[-1] @ w["q"]) @ (x @ w["k"]).T / np.sqrt(lm.WIDTH))
        y = x[-1] + (a / a.sum()) @ (x @ w["v"]) @ w["o"]
        one = np.exp(y @ w["u"] + w["b"])
        two = np.exp((y * w["g"][m.cls[goal]]) @ w["t"] + w["c"][m.cls[goal]])
        total += np.log10(one[m.cls[goal]] / one.sum()) + np.log10(two[m.cell[goal]] / two.sum()) + m.log_share[goal] / np.log(10)
    return total


def test_scores_like_one_id_at_a_time():
    r, m = layer(3)
    lengths = [1, 15, 16, 17, 33, 70, 2]
    ids = r.integers(0, 90, sum(lengths)).astype(np.int32)
    at = np.concatenate(([0], np.cumsum(lengths)))
    got = lm.scores(lm.Scorer(m), ids, at, batch=3)
    for k in range(len(lengths)):
        assert got[k] == pytest.approx(naive_score(m, ids[at[k] : at[k + 1]].tolist()), rel=1e-4)


def test_learning_lowers_the_loss():
    r = np.random.default_rng(0)
    ids = np.tile(np.arange(40), 400).astype(np.int32)  # what follows is always the same
    counts = np.bincount(ids, minlength=90).astype(float)
    cls, cell, _ = lm.classed(counts)
    w = lm.initial(cls, cell, counts)
    windows = lm.training_windows(90, ids, np.arange(0, len(ids) + 1, 200), r.integers(0, 2**62, 80).astype(np.uint64), 1)[0]
    seen = {n: np.full_like(x, 1e-6) for n, x in w.items()}
    first = lm.learn(w, seen, cls, cell, windows)
    assert lm.learn(w, seen, cls, cell, windows) < 0.5 * first < 0.5 * np.log(40)


def test_a_step_of_learning_is_adagrad_on_the_gradients():
    r = np.random.default_rng(8)
    counts = r.integers(0, 50, 90).astype(float)
    cls, cell, _ = lm.classed(counts)
    w = {name: x.astype(float) for name, x in lm.initial(cls, cell, counts).items()}
    seen = {name: np.full_like(x, 1e-6) for name, x in w.items()}
    ids, target = r.integers(0, 91, (40, 2 * lm.STRIDE)), r.integers(0, 90, (40, lm.STRIDE))
    ids[::3, :5], target[::4, 9:] = -1, -1
    want, held = ({name: x.copy() for name, x in y.items()} for y in (w, seen))
    on = target >= 0
    inputs = np.where(ids >= 0, ids, 90)
    _, g = lm.gradients(w, inputs, ids >= 0, np.where(on, cls[target], 0), np.where(on, cell[target], 0), on)
    e = np.zeros_like(w["e"])
    np.add.at(e, inputs, g.pop("e"))
    kept = w["e"], seen["e"]
    lm.learn(w, seen, cls, cell, np.concatenate((ids, target), axis=1))
    for name, x in (g | {"e": e}).items():
        held[name] += x**2
        want[name] -= 0.05 * x / np.sqrt(held[name])
        assert np.allclose(w[name], want[name]) and np.allclose(seen[name], held[name])
    assert w["e"] is kept[0] and seen["e"] is kept[1]  # changed in place


def test_batches_of_learning_follow_each_other():
    """Three batches, the last one shorter, against gradients that are added up one input at a time."""
    r = np.random.default_rng(9)
    counts = np.sort(r.integers(0, 50, 90))[::-1].astype(float)
    cls, cell, _ = lm.classed(counts)
    w = {name: x.astype(float) for name, x in lm.initial(cls, cell, counts).items()}
    seen = {name: np.full_like(x, 1e-6) for name, x in w.items()}
    windows = np.minimum(r.zipf(1.3, (150, 3 * lm.STRIDE)) - 1, 89).astype(np.int32)  # some ids stand very often, some once
    windows[::5, :7], windows[::6, 2 * lm.STRIDE + 9 :] = -1, -1
    want, held = ({name: x.copy() for name, x in y.items()} for y in (w, seen))
    total, order = 0.0, np.random.default_rng(150).permutation(150)
    for i in range(0, 150, 64):
        ids, target = np.split(windows[order[i : i + 64]], [2 * lm.STRIDE], axis=1)
        on, inputs = target >= 0, np.where(ids >= 0, ids, 90)
        loss, g = lm.gradients(want, inputs, ids >= 0, np.where(on, cls[target], 0), np.where(on, cell[target], 0), on)
        e = np.zeros_like(want["e"])
        np.add.at(e, inputs, g.pop("e"))
        total += loss * len(ids)
        for name, x in (g | {"e": e}).items():
            held[name] += x**2
            want[name] = want[name] - 0.05 * x / np.sqrt(held[name])
    assert lm.learn(w, seen, cls, cell, windows) == pytest.approx(total / 150)
    assert all(np.allclose(w[name], want[name]) and np.allclose(seen[name], held[name]) for name in w)


class Watched(np.ndarray):
    """Keeps the shapes of all products that it takes part in."""

    seen: list = []

    def __array_ufunc__(self, ufunc, method, *inputs, out=None, **kw):
        plain = lambda x: x.view(np.ndarray) if isinstance(x, Watched) else x
        got = getattr(ufunc, method)(*map(plain, inputs), **kw, **({} if out is None else {"out": tuple(map(plain, out))}))
        if ufunc is np.matmul:
            self.seen.append(tuple(np.shape(x) for x in inputs))
        return got.view(Watched) if isinstance(got, np.ndarray) else got


def test_inputs_are_not_projected_one_by_one():
    """No product, forth or back, is of all inputs of all windows with weights: only the half that is asked for is."""
    r, m = layer(4)
    ids, valid = r.integers(0, 90, (64, 2 * lm.STRIDE)), np.ones((64, 2 * lm.STRIDE), bool)
    goal, on = r.integers(0, 90, (64, lm.STRIDE)), np.ones((64, lm.STRIDE), bool)
    Watched.seen = []
    loss, _ = lm.gradients({name: x.view(Watched) for name, x in m.weights.items()}, ids, valid, m.cls[goal], m.cell[goal], on)
    assert loss == pytest.approx(lm.gradients(m.weights, ids, valid, m.cls[goal], m.cell[goal], on)[0])
    flat = [shapes for shapes in Watched.seen if all(len(x) == 2 for x in shapes)]
    assert len(flat) > 5 and not [x for x in flat if ids.size in x[0]]


def test_exponentials_that_overflow_are_computed_again():
    r, m = layer(5)
    ids, valid = r.integers(0, 90, (8, 2 * lm.STRIDE)), np.ones((8, 2 * lm.STRIDE), bool)
    valid[::3, :9] = False
    goal, on = r.integers(0, 90, (8, lm.STRIDE)), np.ones((8, lm.STRIDE), bool)
    big = {name: x * np.float32(60) if name in "quk" else x for name, x in m.weights.items()}
    got, want = (lm.gradients({name: x.astype(kind) for name, x in big.items()}, ids, valid, m.cls[goal], m.cell[goal], on) for kind in (np.float32, np.float64))
    assert got[0] == pytest.approx(want[0], rel=1e-3)
    assert all(np.allclose(got[1][name], x, rtol=1e-2, atol=1e-3 * np.abs(x).max()) for name, x in want[1].items())


def test_windows_score_each_id_once():
    at = np.array([0, 1, 18, 18 + 33, 52])
    ids = np.arange(52, dtype=np.int32)
    inputs, valid, target, text = lm.windowed(ids, at, 99)
    assert sorted(target[target >= 0].tolist()) == list(range(52))
    for row, t in zip(inputs, target, strict=True):
        for k, place in enumerate(t):
            if place >= 0:
                assert row[lm.STRIDE + k] == (99 if place in at[:-1] else ids[place - 1])


def test_lm_scores(spark):
    rows = [(i, prose(i, 30, 20)) for i in range(60)] + [(1000 + i, t) for i, t in ODD] + [(1002, "")]
    rows += [(None, "no id at all"), (None, None)]
    clash = table(spark, rows).selectExpr("*", "'x' as row", "1 as score", "'y' as key", "2 as n")
    out = lm.scored(clash, head_words=20).collect()
    assert len(out) == len(rows)
    import math
    import zlib
    from collections import Counter

    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    texts = {(i, len(words(t)) + 1): t for i, t in rows}
    c = Counter(x for i, t in rows if not held(i) for x in [*words(t, fold=True), "\n"])
    n, v = sum(c.values()), len(c)
    for r in out:
        w = [*words(texts[r.doc_id, r.n_tokens], fold=True), "\n"]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
        assert r.score < 0
    assert lm.scored(table(spark, [])).count() == 0


def test_lm_learns_from_every_window(spark):
    """Two words change places in the middle of a long text: no count changes, but the weights do."""
    import zlib

    train = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 != 1)
    other = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    long = prose(3, 2000).split()
    long[80], long[81] = "alpha", "omega"
    changed = [*long]
    changed[80], changed[81] = "omega", "alpha"
    got = [lm.scored(table(spark, [(train, " ".join(x)), (other, "alpha omega " * 5)]).coalesce(1), every=1).where(f"doc_id = {other}").first() for x in (long, changed)]
    assert got[0].base_score == got[1].base_score and got[0].score != got[1].score
