"""Crowded fingerprints are linked on the executors: their meets, thousands a fingerprint, never pass the driver."""

import random
from collections import Counter

import numpy as np
from test_matching import brute_fingerprint, brute_groups

import corpus_pipeline
from buyerlens.llm import components as simhash_components
from buyerlens.llm import simhash


def test_meets_are_not_broadcast(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = [int(rng.integers(0, 1 << 63)) for _ in range(3)]
    fps = sorted({c ^ sum(1 << int(b) for b in rng.choice(40, rng.integers(0, 5), replace=False)) for c in centres for _ in range(60)})
    # From files, whose few bytes the planner knows.
    spark.createDataFrame([(f,) for f in fps], "fp long").write.parquet(str(tmp_path / "fps"))
    pairs = simhash.meet_links(spark.read.parquet(str(tmp_path / "fps")), 3)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    root = {f: f for f in fps}
    for a, b in pairs.collect():
        assert (a ^ b).bit_count() <= 3
        old, new = root[a], root[b]
        root = {f: new if r == old else r for f, r in root.items()}
    want, got = brute_groups(fps, 3), list(root.values())
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want)) > 3


def sent_meets(plan):
    """Lines of a plan that make meets below a broadcast."""
    found, above = [], None
    for line in plan.split("\n"):
        depth = next((i for i, c in enumerate(line) if c.isalpha()), 0)
        above = None if above is not None and depth <= above else above
        if "BroadcastExchange" in line and above is None:
            above = depth
        elif above is not None and "MapInArrow" in line:
            found.append(line)
    return found


def test_stage_with_a_crowd_of_near_copies(spark, monkeypatch):
    rng, plans, kept_written = random.Random(8), [], simhash_components.written
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    docs = [(5000, "quite another text of a few words")]
    for i in range(900):
        words = list(base)
        words[rng.randrange(300)] = f"v{rng.randrange(5000)}"
        docs.append((1000 - i, " ".join(words)))
    fps = [brute_fingerprint(t, 3) for _, t in docs]
    halves = [Counter(f >> shift & 0xFFFFFFFF for f in set(fps)) for shift in (0, 32)]
    assert max(max(h.values()) for h in halves) > simhash.BUCKET

    def watched(df, kind):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept_written(df, kind)

    monkeypatch.setattr(simhash_components, "written", watched)
    got = corpus_pipeline.without_copies(spark, spark.createDataFrame(docs, "doc_id long, text string"), "").collect()
    least = {}
    for (i, _), g in zip(docs, brute_groups(fps, 3), strict=True):
        least[g] = min(least.get(g, i), i)
    assert sorted(r.doc_id for r in got) == sorted(least.values())
    assert any("MapInArrow" in p for p in plans) and not [x for p in plans for x in sent_meets(p)]
