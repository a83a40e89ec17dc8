"""Every registered query against its SQL on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from buyerlens.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def comparable(data):
    return sorted(tuple(repr(round(v, 9)) if isinstance(v, float) else repr(v) for v in r) for r in data)


def test_every_query_has_sql():
    # Queries of the text-collection operators are tested beside them.
    assert set(QUERIES) <= set(registry.queries())
    assert set(QUERIES) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in cols]).collect()
    sql = registry.oracle_sql()[name]
    want = duck.sql("SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM ({sql})").fetchall()
    assert sorted(duck.sql(sql).columns) == cols
    assert comparable(got) == comparable(want)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
