"""Personal data, language model, quality and toxicity."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from buyerlens.llm import lm, pii, quality, toxicity
from buyerlens.llm.common import fold

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


PII_TEXTS = [
    "mail me at joe.doe+x@mail.example.org, or a@b.c_d@e.f now",
    "a@b.c..d@e.f @x.y foo@ bar@baz q@w.e@r.t",
    "hosts 10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8 0001.002.3.4 99999999999.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 5500005555555559 1 2 3 4 5 6 7 8 9",
    "call +49 (30) 1234-5678 or +1.2.3 or +44 20 7946 0958 +1234567890123456",
    "中文 🙂 é joe@example.com 🙂 10.1.2.3",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, not DE88370400440532013000",
    "phone: 555-123-4567" + " and so on" * 8 + " order 555-123-4567" + " and so on" * 8 + " (555) 123-4567",
    "social security 078-05-1120" + " and so on" * 8 + "; version 078-05-1120; ssn 000-12-1234",
    "",
    None,
    "1" * 30_000 + " " + "a" * 30_000 + "@",
    "7 " * 5000 + "4111111111111111",
    "x@" * 500 + "x@y.zz",
]


def test_base_spans_equal_plain_patterns(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(PII_TEXTS)] + [(0, PII_TEXTS[0], "s")], "doc_id long, text string, kind string")
    rows = pii.with_spans(docs).collect()
    assert len(rows) == len(PII_TEXTS) + 1
    for r in rows:
        got = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in pii.BASE_KINDS]
        assert got == base_spans(r.text), r.doc_id
        assert all(s.score >= 0 for s in r.spans)
    assert pii.with_spans(docs.limit(0)).collect() == []


def test_added_kinds_need_checks_and_context(spark):
    docs = spark.createDataFrame(list(enumerate(PII_TEXTS)), "doc_id long, text string")
    rows = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.spans if s.kind not in pii.BASE_KINDS] for r in pii.with_spans(docs).collect() if r.text}
    assert rows[6] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert [k for k, _ in rows[7]] == ["national"]  # no word, or one that speaks against it, is near the others
    assert rows[8][0] == ("ssn", "078-05-1120") and all(m != "000-12-1234" for _, m in rows[8])
    assert all(not rows[i] for i in (0, 1, 2))


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "to joe@example.com from 10.0.0.1", 5), (2, None, 6), (3, "clean", 7), (4, "+49 (30) 1234-5678", 8)], "doc_id long, text string, spans int")
    rows = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert rows[1].text == "to <EMAIL> from <IP>" and rows[1].spans == 5
    assert rows[2].text is None and rows[3].text == "clean" and rows[4].text == "<PHONE>"


def brute_lm(texts, train):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t.encode().lower().decode())
    c = Counter()
    for i in train:
        c.update(words(texts[i]))
        c[None] += 1
    n, v = sum(c.values()), len(c)
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
            seen = {a: m for a, m in trie[k].get(past[5 - k :], {}).items() if a not in gone}
            total = sum(seen.values()) + len(seen)
            if x in seen:
                return out + math.log10(seen[x] / total)
            if seen:
                out += math.log10(len(seen) / total)
            gone |= set(trie[k].get(past[5 - k :], {}))
        return out - math.log10(256 - len(gone))

    for i, t in enumerate(texts):
        w = [*words(t), None]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        yield i, len(w), sum(c[x] > 0 for x in w), n, base, sum(log(p, x) for p, x in steps(t))


@pytest.mark.parametrize(("grams", "pieces"), [(lm.GRAMS, lm.PIECES), (20, 10), (0, 0)])
def test_lm_equals_brute_force(spark, grams, pieces):
    rng = np.random.default_rng(1)
    vocab = ["the", "then", "a", "zebra", "ünï", "中", "Run", "running"]
    texts = [rng.choice([" ", "\n"]).join(rng.choice(vocab, rng.integers(1, 30))) for _ in range(30)]
    texts += ["", "a\tb  c\n\n x \r\n", "qqq zzz zebras", " ", "\x0b\x0c"]
    docs = spark.createDataFrame([(i, t or None, 1) for i, t in enumerate(texts)], "doc_id long, text string, row int")
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = {r.doc_id: r for r in lm.score_documents(docs, fold("doc_id", 7) != 2, grams=grams, pieces=pieces).collect()}
    for i, n, known, total, base, score in brute_lm(texts, train):
        r = rows[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.train) == (n, known, total, i in train)
        assert r.base_score == pytest.approx(base, abs=1e-7) and r.score == pytest.approx(score, abs=1e-7)


def test_lm_without_training(spark):
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    r = lm.score_documents(docs, F.lit(False)).collect()[0]
    assert (r.n_tokens, r.n_known, r.train_tokens) == (2, 0, 0)
    assert r.score == pytest.approx(4 * math.log10(1 / 256)) and r.base_score == 0.0
    assert lm.score_documents(docs.limit(0), F.lit(True)).collect() == []


def scored_corpus(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def accuracy(rows, labels, name, least):
    truth = {r.doc_id: r[name] for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if not r.train and r.doc_id in truth]
    good = [s for s, y in held if y]
    bad = [s for s, y in held if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    return auc, np.mean([(s >= least) == bool(y) for s, y in held])


def test_quality_on_held_out_documents(spark):
    docs, labels = scored_corpus(spark)
    learn = fold("doc_id", 5) != 0
    rows = quality.score_documents(docs, labels.filter(learn), learn).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    auc, right = accuracy(rows, labels, "quality", 0.3)
    assert auc > 0.97 and right > 0.93


def test_toxicity_on_held_out_documents(spark):
    docs, labels = scored_corpus(spark)
    learn = fold("doc_id", 3) != 1
    rows = toxicity.score_documents(docs, labels.filter(learn), learn).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    auc, right = accuracy(rows, labels, "toxic", 0.7)
    assert auc > 0.9 and right > 0.9


def test_toxic_sentences_are_located(spark):
    mild = ["the weather is fine. we walk home", "she reads a book. it is long", "numbers are fun. sums too"]
    docs, labels = [], []
    for i in range(120):
        toxic = i % 3 == 0
        text = mild[i % 3] + (". you stupid fool. bye" if toxic else ". see you. bye")
        docs.append((i, text, 1))
        labels.append((i, int(toxic)))
    docs += [(500, "all is well. you stupid person! good day", 1), (501, None, 1), (502, "", 1), (503, "word " * 5000, 1)]
    labels += [(3, None), (None, 1), (5, 0), (5, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, y int")
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = {r.doc_id: r for r in toxicity.score_documents(d, y, F.lit(True)).collect()}
    text = docs[-4][1]
    assert rows[500].score > 0.7
    assert [text[int(s.split(":")[0]) : int(s.split(":")[1])] for s in rows[500].spans] == ["you stupid person!"]
    assert rows[501].score == rows[502].score < 0.3 and rows[503].score < 0.5
    assert rows[1].score < 0.3


@pytest.mark.parametrize("values", [[], [1], [0], [None]])
def test_classifiers_without_both_labels(spark, values):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (1, "some text")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, v) for v in values], "doc_id long, quality int")
    want = 0.5 if values in ([], [None]) else float(values[0])
    assert {r.score for r in quality.score_documents(docs, labels, F.lit(True)).collect()} == {want}
    toxic = labels.withColumnRenamed("quality", "toxic")
    assert {r.score for r in toxicity.score_documents(docs, toxic, F.lit(True)).collect()} == {want}
    assert quality.score_documents(docs.limit(0), labels, F.lit(True)).collect() == []


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(2)
    n = rng.integers(1, 9, 200).astype(float)
    s = np.array([rng.integers(0, k + 1) for k in n], float)
    at, value = quality.isotonic(np.arange(200.0), n, s)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    first = pd.Series(s).cumsum() / pd.Series(n).cumsum()
    assert value[0] == pytest.approx(first.min())
