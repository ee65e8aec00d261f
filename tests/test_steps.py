"""The keyed store and the ledger of steps."""

import random

import numpy as np
import pytest

from quillspark.config import ConfigError
from quillspark.operators import steps
from quillspark.sources import keyed
from quillspark.sources.keyed import KeyedStore


def rows(spark, *held):
    return spark.createDataFrame([(k, v) for k, v in held], "k string, v int")


def stored(store):
    held = store.rows()
    return sorted(((r.k, r.v) for r in held.collect()), key=lambda x: (x[0], x[1] or 0)) if held is not None else []


def test_a_bloom_filter_never_denies_what_it_holds():
    h = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    bloom = keyed.bloom_of(h)
    assert keyed.may_hold(bloom, h).all()
    other = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 5000)
    assert keyed.may_hold(bloom, other).mean() < 0.05


def test_first_rows_of_keys_stay(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    assert stored(store) == [] and store.append(rows(spark), "none") == 0
    assert store.append(rows(spark, ("a", 2), ("a", 1), (None, 9), ("b", None), ("", 5)), "one") == 3
    assert stored(store) == [("", 5), ("a", 1), ("b", None)]
    assert store.append(rows(spark, ("a", 0), ("c", 3)), "two") == 1
    assert store.append(rows(spark, ("a", 0), ("z", 3)), "two") == 1  # the same batch again
    assert stored(store) == [("", 5), ("a", 1), ("b", None), ("c", 3)]
    assert KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4).append(rows(spark, ("c", 8)), "three") == 0


def test_many_batches_equal_one(spark, tmp_path):
    r = random.Random(5)
    store, want = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=3), {}
    for n in range(4):
        batch = [(f"k{r.randrange(60)}", 100 * n + i) for i in range(40)]
        new = {}
        for k, v in batch:
            new[k] = min(v, new.get(k, v))
        fresh = {k: v for k, v in new.items() if k not in want}
        assert store.append(rows(spark, *batch), f"b{n}") == len(fresh)
        want |= fresh
    assert stored(store) == sorted(want.items())


def test_only_files_that_may_hold_a_key_are_read(spark, tmp_path):
    from pyspark.sql import functions as F

    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    for n in range(3):
        store.append(rows(spark, *[(f"b{n}-{i}", i) for i in range(30)]), f"b{n}")
    asked = rows(spark, ("b1-3", 0)).withColumn("h", F.xxhash64("k")).withColumn("bucket", F.pmod("h", F.lit(4)).cast("int"))
    found = store._files_for(asked)
    assert any("=b1/" in f for f in found) and len(found) < 3


def test_a_batch_that_failed_is_written_anew(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=4)
    store.append(rows(spark, ("a", 1)), "one")
    monkeypatch.setattr(keyed, "_ENTRY", "no such schema")
    with pytest.raises(Exception, match="."):
        store.append(rows(spark, ("a", 2), ("b", 2)), "two")
    monkeypatch.undo()
    assert stored(store) == [("a", 1)]  # data without a manifest isn't seen
    assert store.append(rows(spark, ("a", 2), ("c", 3)), "two") == 1 and stored(store) == [("a", 1), ("c", 3)]


def test_a_stream_is_stored_once(spark, tmp_path):
    src, state = str(tmp_path / "in"), str(tmp_path / "state")
    store = KeyedStore(spark, str(tmp_path / "s"), "k", buckets=2)
    rows(spark, ("a", 1), ("b", 2)).write.parquet(src)
    ingest = lambda where=state: store.ingest(spark.readStream.schema("k string, v int").parquet(src), "in", where)
    assert ingest() == 2 and ingest() == 0
    rows(spark, ("b", 9), ("c", 3)).write.mode("append").parquet(src)
    assert ingest() == 1 and stored(store) == [("a", 1), ("b", 2), ("c", 3)]
    ingest(str(tmp_path / "lost"))  # the stream's own state is lost: its first batch's name is known
    assert stored(store) == [("a", 1), ("b", 2), ("c", 3)]


def chain(seen, codes, inputs):
    def action(name):
        def run(subject):
            seen.append(name)
            code = codes.get(name)
            if isinstance(code, Exception):
                raise code
            return code

        return run

    return [steps.Step(n, action(n), inputs.get(n, ())) for n in ("one", "two", "three")]


def test_steps_run_in_order_stop_at_a_failure_and_go_on(spark, tmp_path):
    book = steps.Ledger(spark, str(tmp_path / "l"))
    seen, data = [], tmp_path / "d.txt"
    data.write_text("1")
    inputs = {"one": (str(data),), "two": (rows(spark, ("a", 1)),)}
    assert book.run("s", chain(seen, {"two": 7}, inputs)) == 7 and seen == ["one", "two"]
    assert book.run("s", chain(seen, {"two": ValueError("no")}, inputs)) == steps.FAILED and seen == ["one", "two", "two"]
    assert book.run("s", chain(seen, {}, inputs)) == steps.OK and seen[3:] == ["two", "three"]
    assert book.run("s", chain(seen, {}, inputs)) == steps.OK and len(seen) == 5
    assert book.run("other", chain(seen, {}, inputs)) == steps.OK and len(seen) == 8
    inputs["two"] = (rows(spark, ("a", 2)),)
    assert book.run("s", chain(seen, {}, inputs)) == steps.OK and seen[8:] == ["two", "three"]  # what follows runs again
    data.write_text("22")
    assert book.run("s", chain(seen, {}, inputs)) == steps.OK and seen[10:] == ["one", "two", "three"]
    assert book.run("s", chain(seen, {}, inputs), again=True) == steps.OK and len(seen) == 16
    held = [(r.step, r.status, r.code) for r in book.rows().where("subject = 's'").orderBy("at").collect()]
    assert held[:4] == [("one", "done", 0), ("two", "failed", 7), ("one", "skipped", 0), ("two", "failed", 1)]
    assert "ValueError: no" in [r.detail for r in book.rows().collect()]


def test_fingerprints_follow_content_and_not_order(spark, tmp_path):
    a = rows(spark, ("a", 1), ("b", 2)).repartition(2)
    assert steps.fingerprint(spark, [a]) == steps.fingerprint(spark, [rows(spark, ("b", 2), ("a", 1))]) != steps.fingerprint(spark, [rows(spark, ("a", 1))])
    assert steps.fingerprint(spark, [rows(spark, ("a", 1), ("a", 1))]) != steps.fingerprint(spark, [rows(spark)])
    assert steps.fingerprint(spark, [str(tmp_path / "none")]) == steps.fingerprint(spark, [str(tmp_path / "none")])


def test_kinds_of_subjects_and_their_chains(spark, tmp_path):
    done = []
    actions = {n: steps.Step(n, lambda s, n=n: done.append(n)) for names in steps.CHAINS.values() for n in names if n != "guard"}
    assert steps.kind_of({"slug": "s"}) == "star" and steps.kind_of({"is_topic": True, "query": "q"}) == "topic" and steps.kind_of({"is_topic": True, "source": "web"}) == "web"
    assert steps.kind_of({"is_topic": True, "source": "local-pdfs", "extra_core": ["k"]}) == "mixed" and steps.kind_of({"is_topic": True, "extra_core": ["k"]}) == "topic"
    for bad in ({"is_topic": True}, {"is_topic": True, "source": "ftp"}):
        with pytest.raises(ConfigError):
            steps.kind_of(bad)
    with pytest.raises(ConfigError, match="fetch"):
        steps.chain_of({}, {k: v for k, v in actions.items() if k != "fetch"}, lambda s: False)
    book = steps.Ledger(spark, str(tmp_path / "l"))
    assert book.run("s", steps.chain_of({}, actions, lambda s: True)) == steps.STOPPED and done == ["discover"]
    assert book.run("s", steps.chain_of({}, actions, lambda s: True, yes=True)) == steps.OK and done == ["discover", *[n for n in steps.CHAINS["star"] if n not in ("discover", "guard")]]


@pytest.mark.parametrize(
    ("flags", "code"),
    [
        (steps.Flags(), steps.USAGE), (steps.Flags("s"), 0), (steps.Flags(probe="q"), 0), (steps.Flags(dry_run=True), 0), (steps.Flags("s", extra_only=True), steps.USAGE), (steps.Flags("s", True, extra_only=True), 0),
        (steps.Flags("s", True, sweep=True), steps.USAGE), (steps.Flags("s", sweep=True), 0), (steps.Flags("", probe=None), steps.USAGE),
    ],
)
def test_flags_that_do_not_go_together(flags, code):
    assert steps.called(flags, lambda f: 0) == code
