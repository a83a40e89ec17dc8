"""The pipeline stage by stage against brute force, and the registry."""

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_matching import brute_fingerprint, brute_groups, brute_hits
from test_scores import base_spans
from tokenizers import Tokenizer

import corpus_pipeline
from buyerlens.llm import quality
from buyerlens.llm.common import fold

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest tables with planted rows and a column that clashes with inner names."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("*", F.lit("r").alias("row"))
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = [r.text for r in docs.filter("length(text) between 800 and 1500").orderBy("doc_id").limit(6).collect()]
    rows = [
        (90_001, plain[0], "en", "s", 1, "copy"),
        (90_001, plain[0], "en", "s", 1, "the same row again"),
        (90_002, plain[1] + " " + items[0], "en", "s", 1, "benchmark"),
        (90_003, plain[2] + " write to joe.doe@example.org or 10.1.2.3, card 4111 1111 1111 1111", "en", "s", 1, "pii"),
        (90_004, None, "en", "s", None, "null"),
        (90_005, "", "en", "s", 0, "empty"),
        (None, plain[3] + " and some more words", "en", None, 2, "no id"),
        (90_006, " ".join(plain) * 40, "en", "s", 3, "long"),
    ]
    docs.unionByName(spark.createDataFrame(rows, SCHEMA)).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path


def test_stages_equal_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs.collect()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        seen.append(docs.collect())
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row"]
    first, good, single, clean, private, tokens = seen

    # Quality: the operator's scores decide, row by row.
    learn = fold("doc_id", 5) != 0
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter(learn)
    scores = quality.score_documents(spark.read.parquet(f"{folder}/documents.parquet"), labels, learn).collect()
    kept = sorted(str(r.doc_id) for r in scores if r.score >= 0.3)
    assert sorted(str(r.doc_id) for r in good) == kept
    truth = {r.doc_id: r.quality for r in labels.collect()}
    gone = {r.doc_id for r in first} - {r.doc_id for r in good}
    assert sum(truth.get(i, 0) for i in gone) <= 0.05 * len(truth)

    # Near copies: one row of each group, with the smallest id.
    group = brute_groups([brute_fingerprint(r.text, 3) for r in good], 3)
    best = {}
    for r, g in zip(good, group, strict=True):
        best.setdefault(g, []).append(r.doc_id)
    want = [min((i for i in ids if i is not None), default=None) for ids in best.values()]
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in single)

    # Contaminated documents go, all others stay.
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = brute_hits([(i, r.text) for i, r in enumerate(single)], items)
    want = [tuple(single[i]) for i, _, n, _, _ in hits if n == 0]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in clean)
    assert 90_002 not in {r.doc_id for r in clean}

    # Personal data are replaced, all else stays as it is.
    before = {(r.doc_id, r.row): r for r in clean}
    assert len(private) == len(clean)
    for r in private:
        old = before[r.doc_id, r.row]
        assert not [s for s in base_spans(r.text) if not s.startswith("card")]
        if not base_spans(old.text) and r.text != old.text:
            assert re.search("<(IBAN|NATIONAL|SSN)>", r.text)
        if r.doc_id == 90_003:
            assert r.text.endswith("write to <EMAIL> or <IP>, card <CARD>")
        assert r.text is None or r.n_chars == len(r.text)

    # Token ids are the library's and spell the text.
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(tokens) == len(private)
    for r in tokens:
        assert list(r.ids) == tok.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) and r.round_trip


def test_empty_tables_pass_through(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.collect() == [] and "ids" in docs.columns


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert {"op1_decontamination", "op3_pii", "op8_top_k"} <= set(entry.oracle_sql())
