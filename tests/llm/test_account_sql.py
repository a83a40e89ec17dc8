"""The SQL of personal data on account numbers with words, or other account numbers, around them."""

import duckdb

from buyerlens.llm.oracles import OP3
from buyerlens.llm.queries import op3_pii
from test_account_ends import CASES


def test_sql_finds_every_start_and_end(spark, tmp_path):
    texts = [t for t, _ in CASES] + [" ".join(t for t, _ in CASES), None, "", "order ES9121000418450200051332"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = op3_pii(spark, str(tmp_path)).orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == con.sql(f"SELECT {', '.join(got.columns)} FROM ({OP3}) ORDER BY doc_id").fetchall()
    found = {r.doc_id: r.spans for r in got.collect()}
    for i, (text, want) in enumerate(CASES):
        spans = [s.split(":") for s in found[i].split(",") if s.startswith("iban")]
        assert [text[int(a) : int(b)] for _, a, b in spans] == want
