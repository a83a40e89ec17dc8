"""Benchmark items without an id count as the SQL counts them."""

import duckdb
import pandas as pd

import corpus_pipeline
from buyerlens.llm.oracles import ORACLES
from buyerlens.llm.queries import op1_decontamination

DOCS = [(1, "the quick brown fox"), (2, "alpha beta gamma"), (3, "nothing here"), (4, "fox and alpha beta and quick brown")]
ITEMS = [(None, "alpha beta"), (None, "quick brown"), (7, "quick brown"), (8, "fox and")]


def test_query_equals_sql_and_stage_drops(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(DOCS, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame({"item_id": pd.array([i for i, _ in ITEMS], "Int64"), "text": [t for _, t in ITEMS]}))
    got = op1_decontamination(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op1_decontamination']})").fetchall()
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want)
    assert [r[2:4] for r in rows] == [(2, 2), (2, 1), (0, 0), (6, 3)]
    assert [r.doc_id for r in corpus_pipeline.without_benchmarks(spark, docs, str(tmp_path)).collect()] == [3]
