"""Renames, ranks, history, contradicting values, the vault source, rendered notes and markup, against plain restatements."""

import datetime as dt
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quillspark.config import Lens, lens_from
from quillspark.functions import text as X
from quillspark.operators import audit, claims, ranks, render, renames
from quillspark.operators import notes as N
from quillspark.sources import vaultfs
from quillspark.sources.vaultfs import PENDING, read_vault, recover, write_vault

# ---------------------------------------------------------------- renames


def table(spark, rows, schema):
    return spark.createDataFrame(list(rows), schema)


def test_chains_cycles_and_ties_of_renames(spark):
    chain = [(f"c{k}", f"c{k + 1}") for k in range(50)]
    rows = [*chain, ("x", "y"), ("y", "z"), ("z", "x"), ("into", "x"), ("same", "same"), ("t", "b"), ("t", "a"), (None, "q"), ("q", None)]
    got = {r.old: (r.new, r.state) for r in renames.resolved(table(spark, rows, "old string, new string")).collect()}
    assert got == {f"c{k}": ("c50", "ok") for k in range(50)} | {k: (None, "cycle") for k in ("x", "y", "z", "into")} | {"t": ("a", "ok")}
    assert renames.resolved(table(spark, [], "old string, new string")).count() == 0


def test_links_follow_names_and_all_else_stays(spark):
    notes = [
        ("a", "see [[b]] and [[ b |label]], [[b#part|x]] [[bb]] [[c]] [[ [[b]] [[]] [[b"), ("b", "[[a]] $1 \\ [[gone]]"), ("c", None), ("gone", "[[b]]"), ("d", "no links"),
        ("e", "[[x]] [[y]]"), ("taken", ""), ("w1", "[[w2]]"), ("w2", "[[w1]]"),
    ]
    moves = [("b", "b2"), ("b2", "b3"), ("x", "y"), ("y", "x"), ("a", "taken"), ("w1", "w"), ("w2", "w"), ("gone", "elsewhere"), ("nowhere", "c2"), ("c", "c2")]
    out = renames.applied(table(spark, notes, "stem string, text string"), table(spark, moves, "old string, new string"), table(spark, [("gone",), (None,)], "stem string"))
    assert {(r.old_stem, r.stem, r.text, r.changed) for r in out.notes.collect()} == {
        ("a", "a", "see [[b3]] and [[b3|label]], [[b3#part|x]] [[bb]] [[c2]] [[ [[b3]] [[]] [[b3", True), ("b", "b3", "[[a]] $1 \\ [[gone]]", True), ("c", "c2", None, True), ("d", "d", "no links", False),
        ("e", "e", "[[x]] [[y]]", False), ("taken", "taken", "", False), ("w1", "w", "[[w2]]", True), ("w2", "w2", "[[w]]", True),
    }
    assert sorted((r.what, r.stem, r.target) for r in out.report.collect()) == [("cycle", "x", None), ("cycle", "y", None), ("dangling", "b", "gone"), ("taken", "a", "taken"), ("taken", "w2", "w")]


def test_only_names_that_many_notes_say_are_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(renames, "LINKS", 5, raising=False)
    notes = [(f"n{i}", f"[[hub]] [[n{i // 2}|x]]") for i in range(40)] + [("hub", "")]
    moves = [("hub", "centre"), *[(f"n{i}", f"m{i}") for i in range(40)]]
    held, moved = table(spark, notes, "stem string, text string"), table(spark, moves, "old string, new string")
    asking, named = renames._dealt(held.select("stem", F.explode(F.array_distinct(renames.link_targets(F.col("text")))).alias("old")), moved)
    assert named.count() == 40 + 9 and named.where("old = 'hub'").count() == 9  # 40 links to the hub, two at most to the others
    assert asking.where("old = 'hub'").select("part").distinct().count() > 1 and asking.join(named, ["old", "part"]).count() == 80
    out = renames.applied(held, moved, table(spark, [], "stem string"))
    assert {r.stem: r.text for r in out.notes.collect()} == {"centre": ""} | {f"m{i}": f"[[centre]] [[m{i // 2}|x]]" for i in range(40)}


def test_no_renames_no_changes(spark):
    out = renames.applied(table(spark, [("a", "[[b]]")], "stem string, text string"), table(spark, [], "old string, new string"), table(spark, [], "stem string"))
    assert [(r.stem, r.text, r.changed) for r in out.notes.collect()] == [("a", "[[b]]", False)] and out.report.count() == 0


# ---------------------------------------------------------------- ranks and what lies before


@pytest.mark.parametrize("parts", [1, 5])
def test_numbers_are_those_of_row_number(spark, parts):
    r = random.Random(parts)
    rows = [(k, r.choice([None, "hot", "hot", "hot", "b", "a"]), r.random()) for k in range(500)]
    got = {x.id: x.n for x in ranks.numbered(table(spark, rows, "id int, a string, b double"), "a", F.col("b").desc(), parts=parts).collect()}
    order = sorted(rows, key=lambda x: (x[1] is not None, x[1] or "", -x[2]))
    assert got == {x[0]: k for k, x in enumerate(order)}
    assert ranks.numbered(table(spark, [], "id int"), "id").count() == 0


@pytest.mark.parametrize("strict", [False, True])
def test_what_lies_before_a_point_over_split_ranges(spark, strict):
    r = random.Random(9)
    key = lambda: r.choice([None, "hot", "hot", "hot", "hot", "b", "only points"])
    points = [(k, key(), r.choice([None, *range(20)])) for k in range(200)] + [(999, "nobody", 3)]
    log = [(r.choice([None, "hot", "hot", "hot", "b", "only log"]), r.choice([None, *range(20)])) for _ in range(400)]
    out = ranks.before(table(spark, points, "id int, k string, t int"), table(spark, log, "k string, t int"), "k", "t", strict, parts=7)
    for x in out.collect():
        own = [t for k, t in log if k is not None and k == x.k and t is not None] if x.t is not None else []
        early = [t for t in own if (t < x.t if strict else t <= x.t)]
        assert (x.n_before, x.n_after, x.last) == (len(early), len(own) - len(early), max(early, default=None)), x
    assert out.count() == len(points)


def test_verification_against_many_changes(spark):
    text = "# T\n## Checked 2024-01-10\n## Checked 2024-03-05 again\n"
    notes = table(spark, [("a", text), ("b", text), ("c", "# T\n## Checked\n"), ("d", text), ("e", None)], "stem string, text string")
    day = lambda m, d: dt.date(2024, m, d)
    log = [("a", day(3, 5)), ("a", day(3, 5)), ("a", day(1, 1)), ("b", day(3, 6)), ("b", day(2, 1)), ("b", day(4, 4)), ("c", day(1, 1)), (None, day(1, 1)), ("a", None)]
    history = audit.verified_since(notes, table(spark, log, "stem string, changed_on date"), table(spark, [("d",), ("d",)], "stem string"), F.lit("2024-06-01"), "Checked")
    assert sorted((r.stem, r.n_before, r.n_after, r.last_before) for r in history.collect()) == [("a", 3, 0, day(3, 5)), ("b", 1, 2, day(2, 1)), ("d", 0, 1, None)]
    assert sorted((r.key, r.detail) for r in audit.stale_since(history).collect()) == [("b", "verified 2024-03-05, changes since: 2"), ("d", "verified 2024-03-05, changes since: 1")]


def test_the_lens_names_headings_and_leaks(spark):
    lens = lens_from({"relevance": {"topics": {"x": "x"}}, "verification": "Verificaci[oó]n de citas", "leaks": {"secret": "sesame"}})
    note = [("q", "query", "# T\n- claim [[2001A]]\nopen sesame\n## Verificación de citas 2024-01-02\n")]
    notes = table(spark, note, "stem string, kind string, text string").withColumn("path", F.lit("v/queries/q.md"))
    links = audit.link_rows(notes)
    changes = table(spark, [("q", dt.date(2024, 1, 1))], "stem string, changed_on date")
    assert audit.verification(notes, links, changes, lens).count() == 0
    assert [r.category for r in audit.verification(notes, links, changes).collect()] == ["never_verified"]
    assert [r.detail for r in audit.implementation_leaks(notes, lens=lens).collect()] == ["line 3: secret"]
    assert audit.implementation_leaks(notes, lens=Lens({"x": "x"})).count() == 0


def test_values_that_cannot_both_be_true(spark):
    r = random.Random(2)
    rows = [(k, r.choice(["hot", "hot", "hot", "b", None]), r.choice(["P", "P", None]), r.choice(["r1", "r2", "r3", None]), *(r.choice([None, *range(30)]) for _ in range(2))) for k in range(250)]
    schema = "id int, entity string, parameter string, bibcode string, low int, high int"
    got = {x.id: x.n_apart for x in claims.contradicting(table(spark, rows, schema)).collect()}

    def whole(x):
        return None not in (x[1], x[2], x[4], x[5])

    def apart(x, y):
        same = x[3] is not None and x[3] == y[3]
        a, b = sorted(x[4:]), sorted(y[4:])
        return x[1:3] == y[1:3] and not same and (a[1] < b[0] or b[1] < a[0])

    # claims without a record contradict all others, themselves excepted
    want = {x[0]: sum(y[0] != x[0] and whole(y) and apart(x, y) for y in rows) if whole(x) else 0 for x in rows}
    assert got == want


# ---------------------------------------------------------------- the vault source


def vault_rows(spark, path):
    return {r.path: r.text for r in read_vault(spark, str(path)).collect()}


def notes_of(spark, **rows):
    return spark.createDataFrame([(k.replace("__", "/") + ".md", v) for k, v in rows.items()], "path string, text string").repartition(3)


def test_notes_are_inserted_and_updated(spark, tmp_path):
    path = tmp_path / "v"
    assert vault_rows(spark, path) == {}
    assert write_vault(notes_of(spark, stars__a="A", stars__b="Bé\n", c=""), str(path)) == 3
    assert write_vault(notes_of(spark, stars__a="other", d="D"), str(path)) == 1
    assert vault_rows(spark, path) == {"stars/a.md": "A", "stars/b.md": "Bé\n", "c.md": "", "d.md": "D"}
    before = os.stat(path / "stars/b.md").st_mtime_ns
    assert write_vault(notes_of(spark, stars__a="new", stars__b="Bé\n"), str(path), "update") == 1
    assert write_vault(notes_of(spark, stars__a="new", stars__b="Bé\n"), str(path), "update") == 0
    assert vault_rows(spark, path)["stars/a.md"] == "new" and os.stat(path / "stars/b.md").st_mtime_ns == before
    assert write_vault(spark.createDataFrame([], "path string, text string"), str(path)) == 0
    assert not [f for _, _, files in os.walk(path / PENDING) for f in files]


def test_a_failed_write_leaves_no_half_vault(spark, tmp_path):
    path = tmp_path / "v"
    write_vault(notes_of(spark, a="A"), str(path))
    bad = spark.createDataFrame([("b.md", "B"), ("../out.md", "no")], "path string, text string")
    with pytest.raises(Exception, match="not a note's path"):
        write_vault(bad, str(path))
    assert vault_rows(spark, path) == {"a.md": "A"} and not (tmp_path / "out.md").exists()


def test_a_killed_commit_is_finished_by_whoever_comes_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "v")
    write_vault(notes_of(spark, a="A"), path)
    import pyarrow as pa

    batch = lambda rows: iter([pa.RecordBatch.from_pydict({"path": [r[0] for r in rows], "text": [r[1] for r in rows]})])
    w = vaultfs._Writer(path, "update", "w1")
    messages = [w.write(batch([("a.md", "A2"), ("x/b.md", "B")])), w.write(batch([("c.md", "C")])), w.write(batch([])), None]
    assert vault_rows(spark, path) == {"a.md": "A"}  # written, not committed
    files, _ = vaultfs._open(path)
    moved = []

    class Dying:
        def __getattr__(self, name):
            return getattr(files, name)

        def move(self, a, b):
            if not b.endswith("JOURNAL"):
                if moved:
                    raise RuntimeError("killed")
                moved.append(b)
                time.sleep(0.05)
            return files.move(a, b)

    monkeypatch.setattr(vaultfs, "_open", lambda p: (Dying(), p))
    with pytest.raises(RuntimeError):
        w.commit(messages)
    monkeypatch.undo()
    assert moved and len(os.listdir(f"{path}/{PENDING}")) > 0
    assert vault_rows(spark, path) == {"a.md": "A2", "x/b.md": "B", "c.md": "C"} and recover(path) == 0
    other = vaultfs._Writer(path, "insert", "w2")
    other.abort([other.write(batch([("z.md", "Z")]))])
    assert "z.md" not in vault_rows(spark, path) and not os.path.exists(f"{path}/{PENDING}/w2")


# ---------------------------------------------------------------- rendered notes


def test_rendered_notes_are_read_again_and_pass_the_audit(spark):
    hosts = table(spark, [("tc", "tau Cet's", "G8", 5344.0, 3.65, 34.0, ["HD 10700"], None), ("lone", "Lone\nstar", None, None, 1e9, float("nan"), None, "data/x")], "slug string, name string, spectral_type string, teff_K double, dist_pc double, st_rotp_days double, aliases array<string>, data_local string")
    planets = table(spark, [("tc", "e", 162.9, 0.55, 0.18, 3.9, "published"), ("tc", "g", 20.0, 0.49, None, 1.75, None), ("tc", "x", None, None, None, None, "it's")], "slug string, letter string, P_days double, K_ms double, e double, mass double, status string")
    excluded = table(spark, [("tc", f"b{k}", k, f"Title | {k}", k, "no topic matches") for k in range(12)], "slug string, bibcode string, ordinal int, title string, citation_count int, why_excluded string")
    none = table(spark, [], "stem string")
    made = render.entity_notes(hosts, planets, none, excluded=excluded)
    parsed = N.parse_heads(made.withColumn("path", F.concat(F.lit("v/stars/"), "stem", F.lit(".md")))).withColumn("kind", F.lit("star"))
    held = {r.stem: r for r in parsed.collect()}
    assert {r.fm_status for r in held.values()} == {"ok"} and held["tc"].tags == ["star"] and held["tc"].fm.title == "tau Cet's" and held["lone"].fm.title == "Lone star"
    assert [(p.letter, p.P_days, p.K_ms, p.e, p.mass_earth) for p in held["tc"].fm.planets] == [("g", 20.0, 0.49, None, 1.75), ("e", 162.9, 0.55, 0.18, 3.9), ("x", None, None, None, None)]
    assert held["lone"].fm.planets == [] and held["tc"].fm.P_rot_days == 34.0 and held["lone"].fm.P_rot_days is None and "dist_pc: 1.0E+9" in held["lone"].text
    assert audit.planet_counts(parsed, planets).count() == 0 and audit.unreadable_heads(parsed).count() == 0 and audit.broken_links(parsed, audit.link_rows(parsed)).count() == 0
    section = held["tc"].text.split("## Excluded records\n")[1].splitlines()
    assert section[0] == "12 records that aren't core; the most cited:" and section[4] == "| Title \\| 11 | `b11` | 11 | no topic matches |" and len(section) == 14 and "## Excluded" not in held["lone"].text
    assert [r.letter for r in N.planets_of(parsed, "tc").collect()] == ["e", "g", "x"]
    assert render.entity_notes(hosts, planets, made.select("stem")).count() == 0
    concepts = table(spark, [("m", "A method", "methods", None, ["alias"]), ("h", "An idea", "hypotheses", None, None)], "slug string, name string, area string, status string, aliases array<string>")
    found = {r.stem: r for r in N.parse_heads(render.concept_notes(concepts, none, Lens({"x": "x"}))).collect()}
    assert {r.fm_status for r in found.values()} == {"ok"} and found["h"].fm.status == "open" and found["m"].fm.status is None and "and by method" in found["m"].text


# ---------------------------------------------------------------- markup


def cleaned(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    text, n = X.clean_markup(F.col("t"))
    return {r.i: (r.text, r.n) for r in df.select("i", text.alias("text"), n.alias("n")).collect()}


def test_markup_is_cleaned_as_by_its_patterns(spark):
    r = random.Random(6)
    parts = ["<video>", "</video>", "<VIDEO src=1>", "</Video>", "<video ", ">", "<videos>", "text", "\n\n\n", "<source a>", "<track/>", "<source ", "<svg>", "</svg>", "<svg ", "é$1\\", " "]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(400)] + ["", "<video </video> x </video> y", "a</video>b<video>c"]
    got = cleaned(spark, [*texts, None])
    for i, t in enumerate(texts):
        n = 0
        for tag in X.MEDIA:
            t, k = re.subn(rf"(?is)<{tag}\b[^>]*>.*?</{tag}>", "", t)
            n += k
        t, k = re.subn(r"(?i)<(?:source|track)\b[^>]*/?>", "", t)
        assert got[i] == (re.sub(r"\n{3,}", "\n\n", t).strip() + "\n", n + k), texts[i]
    assert got[len(texts)][0] is None


@pytest.mark.parametrize("text", ["<video>" * 150_000, "<video " * 150_000, "<video " * 150_000 + "</video>", "</video>" * 130_000, "<video>x</video>" * 60_000, "<source " * 130_000, "<video>" * 75_000 + "</svg>" * 80_000])
def test_a_megabyte_of_tags_is_cleaned_in_linear_time(spark, text):
    cleaned(spark, ["warm"])
    start = time.time()
    cleaned(spark, [text])
    assert time.time() - start < 20


def test_a_repeated_head_is_met_once(spark):
    line = "of the way " * 500
    quotes = table(spark, [(k, f"w{k} of the way of the way end") for k in range(20)] + [(99, "the way of"), (98, "way way way")], "quote_id int, quote string")
    docs = table(spark, [(1, line + "end"), (2, "nothing of the kind")], "doc int, text string")
    start = time.time()
    got = {(r.quote_id, r.doc): (r.line, r.n) for r in claims.ladder(quotes, docs).collect()}
    assert got == {(k, 1): (1, 7) for k in range(20)} | {(99, 1): (1, 3)} and time.time() - start < 30
    capped = {(r.quote_id, r.doc): r.n for r in claims.ladder(quotes, docs, longest=4).collect()}
    assert capped == {(k, 1): 4 for k in range(20)} | {(99, 1): 3}
