"""The registered queries of the text-collection operators on the given tables."""

import os

import duckdb
import pytest

from buyerlens.llm.oracles import ORACLES
from buyerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_decontamination": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op2_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op3_pii": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op4_simhash": {"doc_id", "fingerprint", "component_id"},
    "op5_lm": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op6_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op7_toxicity": {"doc_id", "held_out", "score", "predicted"},
    "op8_top_k": {"query_id", "rank", "vec_id", "score"},
    "op9_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op10_quality": {"doc_id", "held_out", "score", "predicted"},
    "op11_divergence": {"lang", "source", "part", "item", "value", "rank"},
    "op12_warc": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op13_collocations": {"lang", "rank", "phrase", "a", "l", "r", "n", "score"},
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are absent")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(df.columns)
    rows = df.collect()
    if name in ORACLES:
        con = duckdb.connect()
        for t in ("documents", "benchmark", "embeddings", "pages"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        found = con.sql(ORACLES[name])
        assert sorted(found.columns) == sorted(df.columns)
        cols = ", ".join(df.columns)
        want = con.sql(f"SELECT {cols} FROM ({ORACLES[name]})").fetchall()
        assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    elif name != "op8_top_k":
        ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
        assert sorted(r.doc_id for r in rows) == sorted(ids)
