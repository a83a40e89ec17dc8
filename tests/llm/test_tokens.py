"""Token operators against the libraries they must agree with, and exact round trips."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from buyerlens.llm import bpe, packing, token_counts

TEXTS = [
    "Plain words, and more words.",
    "",
    " leading and trailing ",
    "two  spaces\tand a tab\nline\n\nends",
    "special <|endoftext|> inside",
    "Ünïcödé 中文 🙂 ² ª ß nbsp em",
    "x" * 3000,
    "don't we'll I'm they've",
    "a" * 40 + " " + "ab" * 50,
    "word " * 4000,
    "\x1c\x1d odd separators",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(100, None, "n"), (None, "no id", "n"), (3, TEXTS[3], "again"), (3, TEXTS[3], "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\tab'sthe.,é中² "), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=4))
def test_automaton_equals_library(texts):
    codec = bpe.codec("byte_bpe_50k.json")
    tok = packing.encoder("byte_bpe_50k.json").tok
    want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    arrow = pa.array(texts, pa.string())
    ids = codec.encode(arrow)
    assert ids.to_pylist() == want
    assert codec.decode(ids).to_pylist() == texts
    flat, sizes = packing.encoder("byte_bpe_50k.json").encode(arrow)
    assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == want if want else not len(flat)


def test_gadgets_follow_merge_order():
    # "aab": a+a comes first, so a b never meets; "ab" alone uses the second merge.
    vocab = {"a": 0, "b": 1, "aa": 2, "ab": 3, "aab": 4}
    merges = [("a", "a"), ("a", "b"), ("aa", "b")]
    auto = bpe.Automaton(vocab, merges, {})
    assert auto.word(b"aab") == [4]
    assert auto.word(b"ab") == [3]
    assert auto.word(b"aaa") == [2, 0]
    assert auto.word(b"aaab") == [2, 3]


def test_encode_and_decode_rows(spark, docs, library):
    rows = bpe.with_text(bpe.with_ids(docs)).select("doc_id", "text", "ids", "decoded").collect()
    assert len(rows) == len(TEXTS) + 4
    for r in rows:
        assert list(r.ids) == library(r.text or "")
        assert r.decoded == (r.text or "")
    assert bpe.with_ids(docs.limit(0)).collect() == []


@pytest.mark.parametrize("width", [1, 3, 8, 15, 16, 17, 24, 31, 32])
def test_packing_round_trip(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 70_003, dtype=np.uint64).astype(np.uint32)
    packed = packing.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8)
    assert (packing.unpack(packed, width, 0, len(ids)) == ids).all()
    for start, n in ((0, 0), (1, 1), (65_535, 3), (69_990, 13)):
        assert (packing.unpack(packed, width, start, n) == ids[start : start + n]).all()


def test_width_is_smallest():
    assert [packing.width_of(n) for n in (1, 2, 3, 256, 257, 50_257, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


def test_token_files(spark, docs, library):
    found = packing.token_files(docs).collect()
    order = [(None, "no id")] + sorted([(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])] * 2 + [(100, "")], key=lambda r: r[0])
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [i for i, _ in order]
    start = 0
    for r, (_, text) in zip(by_start, order, strict=True):
        ids = np.array([*library(text), 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert packing.token_files(docs.limit(0)).collect() == []


def test_small_blocks_and_ranges(spark, monkeypatch, library):
    monkeypatch.setattr(packing, "BLOCK_IDS", 10)
    docs = spark.createDataFrame([(i, "some words " * (i % 7)) for i in range(200)], "doc_id long, text string").repartition(5)
    found = sorted(packing.token_files(docs).collect(), key=lambda r: r.doc_id)
    start = 0
    for r in found:
        n = len(library("some words " * (r.doc_id % 7))) + 1
        assert (r.start, r.n_tokens) == (start, n)
        start += n


def test_token_counts_and_cache(spark, docs, tmp_path):
    model = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    cache = str(tmp_path / "cache")
    rows = token_counts.token_counts(docs, cache=cache, keep=("doc_id", "text")).collect()
    assert len(rows) == len(TEXTS) + 4
    for r in rows:
        assert r.n_tokens == len(model.encode(r.text or ""))
        assert r.n_bytes == len((r.text or "").encode())
    stored = spark.read.parquet(cache)
    distinct = {hashlib.sha256((t or "").encode()).hexdigest() for t in [*TEXTS, None, "no id"]}
    assert {r.content_digest for r in stored.collect()} == distinct
    assert stored.count() == len(distinct)
    # A second run adds only what is new; another tokenizer has counts of its own.
    more = docs.union(spark.createDataFrame([(7, "quite new", "x")], docs.schema))
    assert token_counts.token_counts(more, cache=cache).count() == len(TEXTS) + 5
    assert spark.read.parquet(cache).count() == len(distinct) + 1
    token_counts.token_counts(more, tokenizer="byte_bpe_50k.json", cache=cache).count()
    assert spark.read.parquet(cache).count() == 2 * (len(distinct) + 1)
    assert token_counts.token_counts(docs.limit(0), cache=cache).collect() == []


def test_stored_counts_are_used(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = spark.createDataFrame([(1, "known text")], "doc_id long, text string")
    version = token_counts.tokenizer_digest(public_tokenizers.path("piece_bpe_32k.model"))
    row = [(hashlib.sha256(b"known text").hexdigest(), version, 777)]
    spark.createDataFrame(row, token_counts.CACHE_SCHEMA).write.parquet(cache)
    assert token_counts.token_counts(docs, cache=cache).collect()[0].n_tokens == 777
    assert docs.filter(F.lit(False)).count() == 0
