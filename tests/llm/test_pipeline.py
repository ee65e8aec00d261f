"""The queries on the supplied tables, and the pipeline's stages against brute force."""

import hashlib

import duckdb
import pytest
from brute import ODD, contamination, lines, near_classes, pii, rules

import __spark_entry__
import corpus_pipeline
from quillspark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_like_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "clicks", "sales"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    rel = con.execute(queries.ORACLES[name])
    names = [d[0] for d in rel.description]
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r[c] for c in cols) for r in df.collect()) == key(tuple(row[names.index(c)] for c in cols) for row in rel.fetchall())


def test_whole_tables(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    run = lambda name: {r.doc_id: r for r in queries.QUERIES[name](spark, sf_dir).collect()}
    near = run("op6_near_dedup")
    assert {i: r.class_id for i, r in near.items()} == near_classes(sorted(docs.items()))
    for i, r in run("op7_quality_rules").items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == rules(docs[i])
    for i, r in run("op8_pii").items():
        assert r.base_sha256 == hashlib.sha256(",".join(pii(docs[i])).encode()).hexdigest()


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        before = sorted((r.doc_id, r.text) for r in docs.collect())
        out = stage(spark, docs, sf_dir)
        if name == "mixing":
            rows = out.collect()
            assert len(rows) == len(before) and all(r.taken <= 2 * r["size"] for r in rows)
            break
        assert out.columns == docs.columns
        after = sorted((r.doc_id, r.text) for r in out.collect())
        if name == "quality_rules":
            assert not any(rules(t)[5] for _, t in after) and set(after) <= set(before)
        if name == "line_dedup":
            assert after == sorted((i, k) for i, (_, n, k) in lines(before).items() if not n or k.split())
        if name == "near_dedup":
            classes = near_classes(before)
            assert after == [(i, t) for i, t in before if classes[i] == i]
        if name == "decontamination":
            assert after == [(i, t) for i, t in before if not contamination(t, items)[1]]
        docs = spark.createDataFrame(out.collect(), out.schema)


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, repeats, long texts and columns with clashing names go through all stages, and an empty table too."""
    clean = [(100 + i, " ".join(f"w{(i * 97 + k * 31) % 9973}x{k}" for k in range(90))) for i in range(40)]
    rows = [*ODD, *clean, clean[0], (None, clean[1][1]), (None, None), (500, clean[2][1] + " end"), (501, clean[3][1] + "\n" + " ".join(f"q{k}" for k in range(12))), (502, " ".join(f"v{k}" for k in range(60_000)))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, n long, stays string, h string"
    table = lambda rows: spark.createDataFrame([(i, t, "en", None if i is None else f"src{i % 3}", len(t or ""), 1, "r", 2, "s", "h") for i, t in rows], schema)
    spark.createDataFrame([(i, 1, 0) for i, _ in clean] + [(None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(12))), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted([i for i, _ in clean[1:]] + [502] + [100] * got.count(100)) and 100 in got
    docs = table(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == table([]).columns
    empty = table([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
