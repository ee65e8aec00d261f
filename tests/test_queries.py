"""Every query that has an SQL twin gives the same rows."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__
from quillspark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_like_sql(spark, sf_dir, con, name):
    df = __spark_entry__.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    want = Counter(tuple(plain(row[names.index(c)]) for c in cols) for row in rel.fetchall())
    assert got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_same_rows_with_other_partitions(spark, sf_dir):
    one = Counter(map(tuple, registry.QUERIES["chain_gate"](spark, sf_dir).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert one == Counter(map(tuple, registry.QUERIES["chain_gate"](spark, sf_dir).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
