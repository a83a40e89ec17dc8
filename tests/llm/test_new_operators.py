"""Divergence audit, WARC archives and collocations against brute force, and their edge cases."""

import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from buyerlens.llm import collocations, divergence, warc
from buyerlens.llm.perfect_hash import PerfectHash, key_hashes
from buyerlens.llm.word_arrays import byte_set, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, c long, k string"


def some_docs(seed=3, n=60):
    """Null and empty texts, ties, repeated rows, a long text, other scripts; column names that operators use."""
    rnd = random.Random(seed)
    words = ["the", "The", "cat", "sat", "Über", "naïve", "x1", "don't", "日本語", "a", "b", "mat", "ON"]
    out = []
    for i in range(n):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", ", ", ".\n", "\t", "; "]) for _ in range(rnd.randrange(0, 60)))
        out.append((i, text, rnd.choice(["en", "de", None, "und", ""]), rnd.choice(["s1", "s2", None, "s3"]), 7, "other"))
    out += [(100, None, "en", "s1", None, None), (101, "", "xx", "only", 1, ""), (102, "1 2 3", "xx", "two", 1, "")]
    out += [(103, "the cat sat on the mat " * 2000, "en", "s2", 1, "")]
    out += [out[5]] * 3
    return out


def brute_audit(rows, least=3, top=200):
    per, df = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        per[lang, source].update(terms)
        df[lang].update(set(terms))
    out = set()
    share = lambda c, n, v: 1 + 10**9 * (c + 1) // (n + v)
    for lang in {g[0] for g in per}:
        kept = [t for t, n in df[lang].items() if n >= least]
        v = len(kept)
        groups = {s: c for (x, s), c in per.items() if x == lang}
        n = {s: sum(c[t] for t in kept) for s, c in groups.items()}
        p = {s: {t: share(c[t], n[s], v) for t in kept} for s, c in groups.items()}
        q = {t: share(sum(c[t] for c in groups.values()), sum(n.values()), v) for t in kept}
        for s in groups:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in groups if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            out |= {(lang, s, "pair", o, -x, i) for i, (x, o) in enumerate(sorted(pairs), 1)}
            out |= {(lang, s, "term", t, -x, i) for i, (x, _, t) in enumerate(sorted(terms)[:top], 1)}
    return out


@pytest.mark.parametrize("shipped", [1 << 20, 4, 0])
def test_audit_equals_brute_force(spark, shipped, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 8)  # several blocks of terms
    rows = some_docs()
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    found = divergence.audit(df, top=5, shipped=shipped)
    assert {tuple(r) for r in found.collect()} == brute_audit(rows, top=5)
    assert found.schema.simpleString() == "struct<lang:string,source:string,part:string,item:string,value:bigint,rank:int>"


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).collect() == []


def test_shares_are_exact_beyond_64_bits(spark):
    c, n, v = 12_345_678_901_234, 98_765_432_109_876, 77_777_777
    row = spark.range(1).select(divergence._share(F.lit(c), F.lit(n), F.lit(v)).alias("p")).head()
    assert row.p == 1 + 10**9 * (c + 1) // (n + v)


def test_perfect_hash():
    rnd = random.Random(1)
    keys = pa.array(sorted({"".join(rnd.choices("abcé", k=rnd.randrange(1, 9))) for _ in range(5000)}))
    h = PerfectHash.build(keys)
    slots = h.slots(keys, key_hashes(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))
    again = PerfectHash(h.sizes, h.bits, h.keys)
    assert again.slots(keys, key_hashes(keys)).tolist() == slots.tolist()
    others = pa.array(["zz" + k for k in keys.to_pylist()] + [""])
    assert set(h.slots(others, key_hashes(others)).tolist()) == {-1}
    none = PerfectHash.build(pa.array([], pa.string()))
    assert none.slots(keys, key_hashes(keys)).max() == -1


def test_keys_with_equal_hashes_are_listed(monkeypatch):
    import numpy as np

    from buyerlens.llm import perfect_hash

    monkeypatch.setattr(perfect_hash, "key_hashes", lambda keys: np.array([len(k) for k in keys.to_pylist()], np.uint64))
    keys = pa.array(["a", "bb", "cc", "ddd", "ee"])
    h = PerfectHash.build(keys)
    asked = pa.array(["a", "bb", "cc", "ddd", "ee", "ff", "g"])
    slots = h.slots(asked, perfect_hash.key_hashes(asked)).tolist()
    assert sorted(slots[:5]) == [0, 1, 2, 3, 4] and slots[5:] == [-1, -1]


def test_words_of_slices():
    texts = pa.array(["a", "one Two", "", "b.c d", "END"]).slice(1, 3)
    found = words_of(texts, ~byte_set(b" ."), byte_set(b"."))
    words = found.vocab.take(pa.array(found.ids)).to_pylist()
    assert (words, found.row.tolist(), found.first.tolist()) == (
        ["one", "two", "b", "c", "d"], [0, 0, 2, 2, 2], [True, False, True, True, False],
    )


# Collocations


def brute_collocations(rows, longest=3, least=10, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        wanted = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for longer, b in wanted.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    if 100 * b >= share * counts[longer[i : i + k]]:
                        gone.add(longer[i : i + k])
        kept = []
        for p, a in wanted.items():
            if p not in gone:
                s, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize(("longest", "least", "top"), [(3, 2, 2000), (3, 10, 4), (2, 2, 2000), (4, 2, 2000), (5, 3, 2000)])
def test_collocations_equal_brute_force(spark, longest, least, top):
    rows = some_docs(9, 40)
    rows += [(200 + i, "w" + " w".join(map(str, range(150))) + ". tail of it", "de", "s", 0, "") for i in range(4)]  # a long path
    rows += [(300, "go round go round go round go round, u u u u u u u", "en", "s", 0, "")]  # rings
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    found = collocations.collocations(df, longest, least, top=top)
    assert sorted(tuple(r) for r in found.collect()) == brute_collocations(rows, longest, least, top=top)


def test_paths_hold_each_edge_once(spark):
    rows = [(i, "w" + " w".join(map(str, range(300))) + (" x y" if i else " p q"), "en", "s", 0, "") for i in range(3)]
    phrases = collocations.phrase_counts(spark.createDataFrame(rows, DOCS), 3, 1)
    edges = phrases.filter("k = 3")
    found = collocations.paths(edges, 3).collect()
    seen = Counter()
    for r in found:
        assert len(r.weights) == len(r.words) - 2
        for i, w in enumerate(r.weights):
            seen[" ".join(r.words[i : i + 3]), w] += 1
    assert seen == Counter((r.phrase, r.f) for r in edges.collect())
    assert len(found) < len(seen) / 4  # runs of a repeated passage are a few rows


def test_flows_give_every_count(spark):
    rows = some_docs(4, 30)
    found = collocations.phrase_counts(spark.createDataFrame(rows, DOCS).repartition(4), 4).collect()
    want = Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            want["und" if lang is None else lang, 0, ""] += len(words)
            for k in range(1, 5):
                want.update(("und" if lang is None else lang, k, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    assert {tuple(r)[:3]: r.f for r in found} == {k: v for k, v in want.items() if v}


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 9_000_000_000_001, 9_000_000_000_777, 9_100_000_000_003
    rows = [("en", 0, "", 10**15), ("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)]
    row = collocations.scored(spark.createDataFrame(rows, "lang string, k int, phrase string, f long")).head()
    assert row.score == 10**6 * a * a // (l * r)


# WARC

PAGES = "page_id long, url string, html string, type string, payload string"
LONG = "<p>" + "é" * 60 + "</p>"


def some_pages():
    pages = [
        (5, "http://a/5", LONG, "t", "p"),
        (3, "http://a/3\r\nWARC-Type: resource", LONG, None, None),  # a header in a url
        (9, None, LONG, "", ""),
        (None, "http://a/none", LONG, "", ""),
        (4, "http://a/4", "short", "", ""),
        (2, "http://a/2", "short", "", ""),
        (1, "http://a/1", None, "", ""),
        (0, "http://a/0", "", "", ""),
        (7, "http://a/7", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n" * 10, "", ""),
        (8, "http://a/8", "x" * 3_000_000, "", ""),
        (10, "http://a/10", "y" * 100, "", ""),
        (11, "http://a/11", "y" * 100, "", ""),
        (12, "http://a/12", "z" * 99, "", ""),
        (13, "http://a/13", "z" * 99, "", ""),
    ]
    return pages + [pages[0], pages[1]]


def brute_roles(pages):
    first = {}
    for i, _, html, *_ in pages:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html, *_ in pages:
        data = (html or "").encode()
        top = first.get(html or "")
        again = len(data) >= 100 and top is not None and i != top
        role = ("revisit", str(top)) if again else ("response", None)
        out.append((None if i is None else str(i), *role, len(data), hashlib.sha256(data).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archive_round_trip(spark, tmp_path, compression, monkeypatch):
    pages = some_pages()
    df = spark.createDataFrame(pages, PAGES).repartition(3)
    warc.register(spark)
    path = f"file://{tmp_path}/w"
    warc.with_roles(df).write.format("warc").option("compression", compression).option("roll", "5000").option("split", "200").mode("append").save(path)
    read = spark.read.format("warc").load(path)
    rows = read.filter("type <> 'warcinfo'").collect()
    texts = {f"urn:page:{'null' if i is None else i}": (h or "").encode() for i, _, h, *_ in pages}
    for r in rows:
        if r.type == "response":
            assert bytes(r.payload) == texts[r.record_id] and r.payload_bytes == len(r.payload)
        else:
            assert bytes(r.payload) == b"" and r.headers["warc-profile"] == warc.SAME
            assert r.payload_bytes == len(texts[r.record_id])
        assert r.digest == "sha256:" + hashlib.sha256(texts[r.record_id]).hexdigest()
    assert len(rows) == len(pages)
    assert {r.uri for r in rows} >= {None, "http://a/3%0D%0AWARC-Type: resource"}
    found = warc.archived(df)
    assert sorted(map(tuple, found.select("page_id", "type", "refers_to", "payload_bytes", "payload_digest").collect()), key=str) == brute_roles(pages)


def test_predicates_reach_the_source(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "w")
    warc.with_roles(spark.createDataFrame(some_pages(), PAGES)).write.format("warc").mode("append").save(path)
    read = spark.read.format("warc").load(path)
    everything = spark.createDataFrame(read.collect(), read.schema)
    for test in (
        "type = 'revisit'", "type IN ('revisit', 'warcinfo')", "uri LIKE 'http://a/1%'", "uri IS NULL", "refers_to IS NOT NULL",
        "block_bytes > 300", "type <> 'response'", "record_id LIKE '%:7' AND type = 'response'", "uri LIKE '%a/1%'",
        "type <=> 'revisit'", "date >= '1970'", "block_bytes <= 300 AND block_bytes < 250", "uri LIKE '%0'", "NOT uri LIKE '%0'",
        "length(uri) > 9 AND type = 'response'",
    ):
        asked = warc.records_of(spark, path, ["record_id", "type", "uri", "refers_to", "block_bytes", "date"]).filter(test)
        want = sorted(map(str, everything.filter(test).select(*asked.columns).collect()))
        assert sorted(map(str, asked.collect())) == want and want
    # A frame that is loaded without the option may be used twice.
    pair = read.filter("type = 'response'").alias("a").join(read.filter("type = 'revisit'").alias("b"), F.expr("a.record_id = b.refers_to"))
    assert pair.count() == 9  # four revisits of a response that is there twice, one of another


def test_reader_gives_matching_records_only(tmp_path):
    kinds = ["response", "revisit", "resource"]
    rows = [{"record_id": f"r{i}", "type": kinds[i % 3], "uri": f"http://h{i % 2}/"} for i in range(12)]
    (tmp_path / "a.warc").write_bytes(b"".join(warc.record_bytes(r, warc.EPOCH) for r in rows))
    reader = warc.PushingReader(str(tmp_path), ["record_id"], warc.SPLIT)
    asked = [warc.In(("type",), ("response", "resource")), warc.Not(warc.StringStartsWith(("uri",), "http://h1")), warc.IsNotNull(("date",))]
    assert reader.pushFilters([*asked, warc.EqualTo(("headers", "x"), "y")]) and reader.filters == asked
    found = [r["record_id"] for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()]
    assert found == [r["record_id"] for r in rows if r["type"] != "revisit" and r["uri"] == "http://h0/"]


def test_unwanted_payloads_are_not_decoded(tmp_path, monkeypatch):
    big = b"".join(warc.member(warc.record_bytes({"record_id": f"r{i}", "payload": b"%d" % i * 500_000}, warc.EPOCH), 6) for i in range(5))
    (tmp_path / "a.warc.gz").write_bytes(big)
    inflated = []
    real = warc.PackedRecord._inflated
    monkeypatch.setattr(warc.PackedRecord, "_inflated", lambda self, n: inflated.append(len(out := real(self, n))) or out)
    reader = warc.Reader(str(tmp_path), ["record_id", "type"], warc.SPLIT)
    (part,) = reader.partitions()
    rows = [r for b in reader.read(part) for r in b.to_pylist()]
    assert [r["record_id"] for r in rows] == [f"r{i}" for i in range(5)]
    assert sum(inflated) <= 5 * 1024
    reader = warc.PushingReader(str(tmp_path), ["payload"], warc.SPLIT)
    reader.pushFilters([warc.EqualTo(("record_id",), "r3")])
    inflated.clear()
    assert [b.to_pylist() for b in reader.read(part)] == [[{"payload": b"3" * 500_000}]]
    assert sum(inflated) < 520_000


def test_files_of_other_writers(spark, tmp_path):
    """Members without their length, folded header lines, lower-case names, blocks that are not HTTP."""
    one = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:1>\r\nX-Long: a\r\n b\r\nContent-Type: application/http\r\nContent-Length: 31\r\n\r\nHTTP/1.0 200 OK\r\nA: b\r\n\r\nbody!!\r\n\r\n"
    two = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:2>\r\nContent-Type: text/plain\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    (tmp_path / "y.warc").write_bytes(one + two)
    (tmp_path / "notes.txt").write_bytes(b"no archive")
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).orderBy("file", "offset").collect()
    assert [(r.file, r.record_id, r.type, bytes(r.payload)) for r in rows] == [
        ("x.warc.gz", "urn:1", "response", b"body!!"), ("x.warc.gz", "urn:2", "resource", b"abc"),
        ("y.warc", "urn:1", "response", b"body!!"), ("y.warc", "urn:2", "resource", b"abc"),
    ]
    assert rows[0].headers["x-long"] == "a b"
    (tmp_path / "z.warc").write_bytes(one + two[:-20])
    with pytest.raises(Exception, match="cut off|header"):
        spark.read.format("warc").load(str(tmp_path / "z.warc")).collect()


def test_only_committed_files_are_read(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "w")
    df = warc.with_roles(spark.createDataFrame(some_pages()[:3], PAGES).coalesce(1))
    df.write.format("warc").mode("append").save(path)
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(b"half a rec")
    df.write.format("warc").mode("append").save(path)
    read = lambda: spark.read.format("warc").schema("type string, record_id string").load(path).filter("type <> 'warcinfo'")
    assert read().count() == 6
    df.limit(1).write.format("warc").mode("overwrite").save(path)
    assert read().count() == 1


def test_archive_of_nothing(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).collect() == []


def test_large_components_of_top_k(spark):
    from buyerlens.llm import topk

    rows = [(0, [1e15, 1.0]), (1, [1e18, -1e300]), (2, [1e12, 5.0]), (3, [-1e18, 2.0]), (4, [1e12, 6.0]), (5, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, F.col("vec_id") == 0).collect()
    top = topk.LARGEST
    whole = {i: [int(max(-top, min(top, 1024 * x))) for x in v] for i, v in rows}
    exact = {i: sum(a * b for a, b in zip(whole[0], v, strict=True)) for i, v in whole.items() if i}
    assert [r.vec_id for r in found] == sorted(exact, key=lambda i: (-exact[i], i))
    assert [r.score for r in found] == [max(-(1 << 63), min((1 << 63) - 1, exact[r.vec_id])) for r in found]


def test_misses_are_reduced_before_they_meet_the_cache(spark, tmp_path, monkeypatch):
    """However large the cache, a hot text is one row of each task when it moves."""
    from buyerlens.llm import token_counts

    plans = []
    real = spark.createDataFrame([("x",)], "a string").write.__class__.parquet
    monkeypatch.setattr(
        spark.createDataFrame([("x",)], "a string").write.__class__, "parquet",
        lambda self, *a, **b: plans.append(self._df._jdf.queryExecution().optimizedPlan().toString()) or real(self, *a, **b),
    )
    docs = spark.createDataFrame([(i, "same text") for i in range(50)] + [(50, None)], "doc_id long, text string")
    cache = str(tmp_path / "cache")
    for _ in range(2):
        rows = token_counts.token_counts(docs, cache=cache).collect()
        assert {(r.n_bytes, r.n_tokens > 0) for r in rows} == {(9, True), (0, False)}
    assert spark.read.parquet(cache).count() == 2
    plan = next(p for p in plans if "LeftOuter" in p)
    assert plan.index("LeftOuter") < plan.index("Aggregate")  # the reduction stands below the join
