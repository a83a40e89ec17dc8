"""The registered model's contexts run on over white space."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from buyerlens.llm import lm
from buyerlens.llm.common import fold
from buyerlens.llm.queries import op5_lm


def brute(texts, train):
    trie = [defaultdict(Counter) for _ in range(6)]

    def steps(t):
        past = b"\xff" * 5
        for x in t.encode().lower() + b"\xff":
            yield past, x
            past = (past + bytes([x]))[1:]

    for i in train:
        for past, x in steps(texts[i]):
            for k in range(6):
                trie[k][past[5 - k :]][x] += 1

    def log(past, x):
        out, gone = 0.0, set()
        for k in range(5, -1, -1):
            whole = trie[k].get(past[5 - k :], {})
            seen = {a: m for a, m in whole.items() if a not in gone}
            total = sum(seen.values()) + len(seen)
            if x in seen:
                return out + math.log10(seen[x] / total)
            if seen:
                out += math.log10(len(seen) / total)
            gone |= set(whole)
        return out - math.log10(256 - len(gone))

    return [sum(log(p, x) for p, x in steps(t)) for t in texts]


def corpus():
    rng = np.random.default_rng(4)
    vocab = ["the", "then", "a", "zebra", "ünï", "中", "Run", "running"]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(vocab, rng.integers(1, 30))) for _ in range(30)]
    texts += ["", "a\tb  c\n\n x \r\n", "qqq zzz zebras", " ", "\x0b\x0c", "the zebra then runs", "zebra then the runs"]
    return texts, [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]


@pytest.mark.parametrize("grams", [lm.GRAMS, 20])
def test_contexts_run_on(spark, tmp_path, monkeypatch, grams):
    texts, train = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if grams == lm.GRAMS:
        docs.write.parquet(str(tmp_path / "documents.parquet"))
        rows = op5_lm(spark, str(tmp_path)).collect()
    else:
        rows = lm.score_documents(docs, fold("doc_id", 7) != 2, grams=grams, pieces=3).collect()
    got = {r.doc_id: r.score for r in rows}
    want = brute(texts, train)
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-7)
    # Order of words counts.
    assert abs(want[-1] - want[-2]) > 1e-3


def test_long_texts_are_cut_without_loss():
    texts = [b"some words and more" * 20, b"", b"x y"]
    whole = [lm.gram_keys(g) for g in lm.parts_of(texts)]
    cut = [lm.gram_keys(g) for g in lm.parts_of(texts, 7)]
    for i in range(2):
        assert np.concatenate([w[i] for w in whole]).tolist() == np.concatenate([c[i] for c in cut]).tolist()
