"""Decontamination, SimHash groups and top-k search against brute force."""

import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from buyerlens.llm import components, decontam, simhash, topk

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_hits(docs, items, window=10):
    wins = []
    for item, text in items:
        w = WORD.findall(lowered(text))
        if item is None or not w:
            continue
        n = min(window, len(w))
        wins += [(item, w[i : i + n]) for i in range(max(1, len(w) - window + 1))]
    out = []
    for doc, text in docs:
        w = WORD.findall(lowered(text))
        hit, found = set(), set()
        for item, win in wins:
            for i in range(len(w) - len(win) + 1):
                if w[i : i + len(win)] == win:
                    hit.update(range(i, i + len(win)))
                    found.add(str(item))
        out.append((doc, len(w), len(hit), len(found), ",".join(sorted(found))))
    return out


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)] + ["Éa", "ß", "中文"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "  ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 30]))) for i in range(25)]
    items += [(90, items[8][1]), (91, ""), (92, None), (93, "..."), (None, "w1 w2"), (10, items[0][1])]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(items)[1] or "", text(rng.randrange(0, 6))]
        docs.append((i, " ".join(parts).swapcase() if i % 3 else " ".join(parts)))
    docs += [(70, None), (71, ""), (72, "?!"), (5, docs[5][1]), (None, docs[9][1])]
    d = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, row string, found int")
    b = spark.createDataFrame([(*r, "y") for r in items], "item_id long, text string, h string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"])) for r in decontam.find_items(d, b).collect()]
    assert sorted(got, key=str) == sorted(brute_hits(docs, items), key=str)
    kept = decontam.find_items(d, b, keep_docs=True).select("doc.*")
    assert kept.columns == d.columns and kept.count() == len(docs)
    assert decontam.find_items(d.limit(0), b).collect() == []
    clean = decontam.find_items(d, b.limit(0)).collect()
    assert len(clean) == len(docs) and all(r.n_hit == 0 for r in clean)


def test_window_across_hash_filter_clashes(spark, monkeypatch):
    # A filter of 64 bits lets nearly everything through; results must not change.
    monkeypatch.setattr(decontam, "FILTER_BITS", (6, 6))
    docs = [(i, " ".join(f"t{(i * k) % 17}" for k in range(60))) for i in range(20)]
    items = [(i, " ".join(f"t{(i * k) % 17}" for k in range(12, 25))) for i in range(6)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r["items"])) for r in decontam.find_items(d, b).collect()]
    assert sorted(got) == sorted(brute_hits(docs, items))


def brute_fingerprint(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text).encode())
    if not words:
        return 0
    n = min(k, len(words))
    hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps, radius):
    ids = list(range(len(fps)))

    def root(i):
        while ids[i] != i:
            i = ids[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = root(i), root(j)
                ids[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(f"word{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 3, 30, 200]))) for _ in range(30)]
    docs = []
    for i, t in enumerate(base * 4):
        w = t.split()
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"word{rng.randrange(400)}"
        docs.append((1000 - i, "\t ".join(w).upper() if i % 5 == 0 else " ".join(w)))
    docs += [(2000, None), (2001, ""), (2002, " \n"), (2003, "A b"), (2003, "a B"), (None, base[3])]
    got = simhash.near_duplicates(spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, fp int"))
    fps = [brute_fingerprint(t, 3) for _, t in docs]
    group = brute_groups(fps, 3)
    least = {}
    for (i, _), g in zip(docs, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    want = [(i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(docs, fps, group, strict=True)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(got.limit(0).select("doc_id", F.lit("").alias("text"))).collect() == []


@pytest.mark.parametrize(("radius", "segments", "bucket"), [(3, 2, 64), (3, 2, 1), (2, 2, 2), (1, 2, 1), (3, 4, 3), (5, 3, 64), (6, 3, 64)])
def test_links_connect_what_brute_force_connects(spark, radius, segments, bucket):
    rng = np.random.default_rng(radius * 7 + segments)
    fps = {0, (1 << 64) - 1, 7}
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.add(centre ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(s,) for s in signed], "fp long")
    pairs = simhash.links(rows, radius, segments, bucket)
    for a, b in pairs.distinct().collect():
        assert bin((a ^ b) & ((1 << 64) - 1)).count("1") <= radius
    roots = dict(components.components(pairs).collect())
    want = brute_groups(fps, radius)
    got = [roots.get(s, s) for s in signed]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_one_of_each_keeps_whole_rows(spark):
    docs = spark.createDataFrame(
        [(5, "same text here", "a", 1), (3, "Same TEXT here", "b", 2), (3, "same text here", "c", 3), (9, "quite another thing", "d", 4), (None, "same text here", "e", 5), (None, "alone without id", "f", 6)],
        "doc_id long, text string, row string, fp int",
    )
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 3), (False, 9), (True, 0)]
    assert {r.text for r in rows if r.doc_id is None} == {"alone without id"}


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = path + star + [(200, 200), (201, None), (203, 202), (202, 203)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {202: 202, 203: 202}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_top(rows, k, is_query):
    fine = [(i, np.floor(1024 * np.array(v, float)).astype(object)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in fine:
        if not is_query(i):
            continue
        scores = [(-int(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in fine if j != i and len(v) == len(q)]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("n", "dim", "block", "queries"), [(300, 8, 64, 3), (90, 1, 32, 5), (500, 16, 4096, 32), (7, 3, 2, 2)])
def test_top_k_equals_brute_force(spark, n, dim, block, queries):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=dim).round(2).tolist()) for i in range(n)]
    rows += [(n + i, rows[1][1]) for i in range(15)]  # ties
    rows += [(5000, [0.0] * dim), (5010, None), (5020, [None] * dim), (5030, [float("nan")] * dim), (5040, [float("inf")] * dim), (5050, [1.0] * (dim + 1)), (None, [1.0] * dim)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, rank int, q int").repartition(3)
    rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=10, block=block, queries=queries)
    assert sorted(map(tuple, got.collect())) == brute_top(rows32, 10, lambda i: i % 10 == 0)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_decontamination_sql_on_fixture(spark):
    from buyerlens.llm.oracles import ORACLES

    docs = pd.DataFrame({"doc_id": [1, 2, 3], "text": ["The quick BROWN fox jumps", None, "nothing here"]})
    bench = pd.DataFrame({"item_id": [10, 9], "text": ["quick brown", "fox jumps"]})
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("benchmark", bench)
    got = con.sql(ORACLES["op1_decontamination"]).df().sort_values("doc_id")
    assert got["n_hit"].tolist() == [4, 0, 0] and got["n_items"].tolist() == [2, 0, 0]
