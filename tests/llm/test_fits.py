"""Toxicity and quality against plain fits of the same models, score by score."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from buyerlens.llm import quality, toxicity

MILD = ["the weather is fine.", "she reads a long book.", "numbers are fun", "we walk home!", "the cat sleeps.", "rain falls today"]
RUDE = ["you stupid fool.", "what a fool you are!", "shut up, idiot"]


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        rude = i % 3 == 0
        lines = list(rng.choice(MILD, rng.integers(1, 6))) + ([str(rng.choice(RUDE))] if rude else [])
        rng.shuffle(lines)
        out.append((i, str(rng.choice([" ", "\n"])).join(lines), int(rude)))
    return out


def words_of(piece):
    for w in re.findall(r"[^\W\d_]+", piece.lower()):
        yield "=" + w
        for k in (3, 4, 5, 6):
            if len(w) >= k:
                yield "^" + w[:k]


def sentences(text):
    for line in text.split("\n"):
        now = []
        pieces = line.split(" ")
        for k, piece in enumerate(pieces):
            now.append(piece)
            if k == len(pieces) - 1 or re.search(r"[.!?][\"')\]»”’]*$", piece):
                yield now
                now = []


def plain_noisy_or(train, texts):
    """One document, one sentence and one word at a time."""
    n0, n1 = sum(not y for _, y in train), sum(y for _, y in train)
    seen = {}
    for text, y in train:
        for f in {f for s in sentences(text) for p in s for f in words_of(p)}:
            seen.setdefault(f, [0, 0])[y] += 1
    ranked = []
    for f, (a, b) in seen.items():
        if a + b >= 3:
            odds = math.log((b + 0.5) / (n1 - b + 0.5)) - math.log((a + 0.5) / (n0 - a + 0.5))
            z = abs(odds / math.sqrt(1 / (b + 0.5) + 1 / (a + 0.5)))
            if z > 2:
                ranked.append((-z, f))
    place = {f: i for i, (_, f) in enumerate(sorted(ranked)[: toxicity.VOCABULARY])}
    n = len(place)

    def bags(text):
        rows = []
        for s in sentences(text):
            x = np.zeros(n + 1)
            x[n] = 1
            for p in s:
                for f in words_of(p):
                    if f in place:
                        x[place[f]] += 1
            rows.append(x)
        return np.array(rows)

    data = [(bags(t), y) for t, y in train]
    theta = np.zeros(n + 1)
    theta[n] = -5
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, toxicity.STEPS + 1):
        grad = np.zeros(n + 1)
        for x, y in data:
            p = 1 / (1 + np.exp(-(x @ theta)))
            none = np.prod(1 - p)
            slope = none / (1 - none) if y else -1.0
            grad += (-slope * p) @ x / len(data)
        grad[:n] += toxicity.PENALTY * theta[:n]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        theta -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return [1 - np.prod(1 - 1 / (1 + np.exp(-(bags(t) @ theta)))) for t in texts]


@pytest.mark.parametrize("chunk", [toxicity.CHUNK, 40])
def test_toxicity_equals_plain_noisy_or(spark, monkeypatch, chunk):
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    rows = corpus(60, 1)
    more = [(100, "you stupid cat. the fool sleeps"), (101, ""), (102, None), (103, "fine weather " * 400 + "idiot")]
    docs = spark.createDataFrame([(i, t, 1, 2.0) for i, t, _ in rows] + [(i, t, 0, 0.0) for i, t in more], "doc_id long, text string, y int, w double")
    docs = docs.unionAll(docs.filter("doc_id = 7"))  # learned from once, scored twice
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4], "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels, F.lit(True)).collect()
    assert len(got) == 65
    want = plain_noisy_or([(t, y) for i, t, y in rows if i % 4], [t for _, t, _ in rows] + [t or "" for _, t in more])
    want = dict(zip([i for i, _, _ in rows] + [i for i, _ in more], want, strict=True))
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], abs=1e-5)


def test_sample_is_bounded_in_bytes(spark):
    rows = corpus(300, 2) + [(999, "a very long text " * 5000, 1)]
    sample = spark.createDataFrame([(i, t, y, 1.0) for i, t, y in rows], "doc_id long, text string, y int, w double")
    whole = toxicity._within(sample, 10**9).collect()
    assert len(whole) == 301 and all(r.w == 1.0 for r in whole)
    part = toxicity._within(sample, 2000).collect()
    texts = {t for _, t, _ in rows}
    for y in (0, 1):
        own = [r for r in part if r.y == y]
        assert own and sum(len(r.text) for r in own) <= 2000 and all(r.text in texts for r in own)
        assert sum(r.w for r in own) == pytest.approx(sum(1 for r in rows if r[2] == y))
    assert toxicity._within(sample, 0).collect() == []


def plain_quality(rows, texts):
    """One ridge fit over all rows, and the greatest of least means as isotonic values."""
    x = np.array([quality.statistics(t) for _, t, _ in rows], np.float32).astype(float)
    y = np.array([float(v) for _, _, v in rows])
    half = np.array([zlib.crc32(f"half{i}".encode()) % 2 for i, _, _ in rows])
    rng = np.random.default_rng(quality.SEED)
    mean, scale = x.mean(0), x.std(0)
    scale[scale <= 1e-9] = 1
    weights = rng.normal(size=(x.shape[1], quality.FEATURES)) / np.sqrt(x.shape[1] / 2)
    phase = rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def lifted(x):
        z = np.cos(np.clip((x - mean) / scale, -quality.CLIP, quality.CLIP) @ weights + phase)
        return np.hstack([z * np.sqrt(2 / quality.FEATURES), np.ones((len(x), 1))])

    def ridge(x, y):
        penalty = np.full(quality.FEATURES + 1, quality.RIDGE * len(y) / quality.FEATURES)
        penalty[-1] = 1e-9
        return np.linalg.solve(x.T @ x + np.diag(penalty), x.T @ y)

    z = lifted(x)
    fits = [ridge(z[half != h], y[half != h]) for h in (0, 1)]
    raw = np.array([row @ fits[h] for row, h in zip(z, half, strict=True)])
    bins = {}
    for r, v in zip(raw, y, strict=True):
        bins.setdefault(int(np.floor((min(max(r, -1), 2) + 1) * (quality.BINS / 3))), []).append((r, v))
    groups = [bins[b] for b in sorted(bins)]
    n, s = np.array([len(g) for g in groups]), np.array([sum(v for _, v in g) for g in groups])
    at = np.array([np.mean([r for r, _ in g]) for g in groups])
    k = range(len(groups))
    level = [max(min(s[a : b + 1].sum() / n[a : b + 1].sum() for b in k[i:]) for a in k[: i + 1]) for i in k]
    knots, values = [], []
    for v in sorted({round(v, 12) for v in level}):
        own = [i for i in k if round(level[i], 12) == v]
        knots.append((at[own] * n[own]).sum() / n[own].sum())
        values.append(v)
    return np.clip(np.interp(lifted(np.array([quality.statistics(t) for t in texts], np.float32).astype(float)) @ ridge(z, y), knots, values), 0, 1)


def test_quality_equals_plain_ridge_and_isotonic_fit(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        good = int(rng.random() < 0.6)
        words = rng.choice(["house", "river", "walks", "green", "seven", "Tree"], rng.integers(5, 60))
        text = " ".join(words) + "." if good or i % 5 == 0 else " ".join(rng.choice(["BUY!!", "$$$", "a", "a", "99"], rng.integers(3, 40)))
        rows.append((i, text, good))
    more = [(500, None), (501, ""), (502, "river " * 200_000), (503, "seven green trees.\nA house")]
    docs = spark.createDataFrame(
        [(i, t, "q", 1.0, 0, True) for i, t, _ in rows] + [(i, t, "", 0.0, 1, False) for i, t in more],
        "doc_id long, text string, x string, y double, half int, train boolean",  # names the operator uses itself
    )
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(3, None), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score_documents(docs, labels, F.lit(True)).collect()}
    want = plain_quality(rows, [t for _, t, _ in rows] + [t or "" for _, t in more])
    for i, w in zip([i for i, _, _ in rows] + [i for i, _ in more], want, strict=True):
        assert got[i] == pytest.approx(w, abs=1e-6)
    kept = quality.keep_good(docs, labels, F.lit(True), 0.3)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s >= 0.3}
    repeated = quality.score_documents(docs.unionAll(docs.filter("doc_id = 503")), labels, F.lit(True))
    assert repeated.filter("doc_id = 503").count() == 2
