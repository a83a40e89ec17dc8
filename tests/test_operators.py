"""Batch operators against small brute-force programs, with and without heavy keys."""

import random

import pytest
from pyspark.sql import functions as F

import shop
from buyerlens import schemas
from buyerlens.operators import activity, cdc, dedup, joins, labels, lookups, scoring
from buyerlens.functions.scores import BANDS, SHORT_OLDEST_BAND
from conftest import rows

HEAVY = [2_000_000, 40]  # nothing is heavy; the hot key is cut into ranges


def hot_data(n=600, seed=3):
    """Key 0 holds a third of the rows; times repeat and run backwards now and then."""
    rnd = random.Random(seed)
    out = []
    for seq in range(n):
        key = 0 if rnd.random() < 0.33 else rnd.randrange(1, 40)
        label = rnd.choice(["a", "b", "c", None, "ü"])
        other = rnd.choice(["x", "y"])
        out.append((key, seq, rnd.randrange(seq // 2, seq + 20), label, other))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "k int, seq long, ts long, p string, q string").repartition(5)


def by_key(data):
    keys = {}
    for row in sorted(data, key=lambda r: r[1]):
        keys.setdefault(row[0], []).append(row)
    return keys


@pytest.mark.parametrize("heavy", HEAVY)
def test_keep_if_newer(spark, heavy):
    data = hot_data()
    want = []
    for items in by_key(data).values():
        newest = None
        for r in items:
            if newest is None or r[2] > newest:
                newest = r[2]
                want.append((r[0], r[1]))
    got = dedup.keep_if_newer(frame(spark, data), ["k"], "ts", ["seq"], heavy)
    assert rows(got, "k", "seq") == sorted(want, key=lambda r: tuple((True, str(v)) for v in r))
    assert got.columns == ["k", "seq", "ts", "p", "q"]


def test_keep_if_newer_in_time_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 7, "c"), (2, 1, "d")], "k int, ts long, v string")
    assert rows(dedup.keep_if_newer(df, ["k"], "ts", ["ts", "v"])) == [(1, 5, "a"), (1, 7, "c"), (2, 1, "d")]


@pytest.mark.parametrize("heavy", HEAVY)
def test_emit_on_change(spark, heavy):
    data = hot_data()
    want = []
    for items in by_key(data).values():
        before = ()
        for r in items:
            if (r[3], r[4]) != before:
                want.append((r[0], r[1]))
            before = (r[3], r[4])
    got = labels.emit_on_change(frame(spark, data), "k", ["p", "q"], ["seq"], heavy)
    assert sorted(tuple(r) for r in got.select("k", "seq").collect()) == sorted(want)


@pytest.mark.parametrize("heavy", HEAVY)
@pytest.mark.parametrize("seed", [3, 4])
def test_label_changes(spark, heavy, seed):
    data = hot_data(900, seed)
    want = []
    for items in by_key(data).values():
        counts, before = [{}, {}], None
        for r in items:
            leaders = []
            for dim in (0, 1):
                c = counts[dim]
                c[r[3 + dim]] = c.get(r[3 + dim], 0) + 1
                top = max(c.values())
                tied = [x for x, n in c.items() if n == top]
                leaders.append(min(tied, key=lambda x: (x is not None, (x or "").encode())))
            if leaders != before:
                want.append((r[0], r[1], *leaders))
            before = leaders
    got = labels.label_changes(frame(spark, data), "k", ["p", "q"], ["seq"], ["seq"], heavy)
    got = [(r.k, r.seq, r.p, r.q) for r in got.collect()]
    assert sorted(got, key=lambda r: (r[0], r[1])) == sorted(want, key=lambda r: (r[0], r[1]))


def test_heavy_keys_are_found(spark):
    from buyerlens.operators import skew

    df = frame(spark, hot_data())
    parts, cut = skew.split_heavy_keys(df, ["k"], ["seq"], 40)
    assert cut
    by = {r["k"]: r["n"] for r in parts.groupBy("k").agg(F.countDistinct(skew.PART).alias("n")).collect()}
    assert by[0] > 10 and set(by[k] for k in by if k) == {1}
    assert parts.groupBy("k", skew.PART).count().agg(F.max("count")).first()[0] < 40
    assert not skew.split_heavy_keys(df, ["k"], ["seq"])[1]
    assert not skew.split_heavy_keys(df, ["k"], ["seq"], None)[1]


def burst_data(spark):
    """Null times, a row at the epoch and half of a key's rows at one time."""
    rnd = random.Random(8)
    times = [None] * 50 + [0] + [1_700_000_000_000] * 500 + [1_700_000_000_000 + rnd.randrange(10**6) for _ in range(449)]
    data = [(1, t, i, rnd.choice(["a", "b", None]), rnd.choice(["x", "y"])) for i, t in enumerate(times)]
    data += [(2, i, i, "a", "x") for i in range(5)]
    return spark.createDataFrame(data, "k int, ts long, seq long, p string, q string")


def test_bursts_and_missing_times_are_cut(spark):
    from buyerlens.operators import skew

    df = burst_data(spark)
    parts, _ = skew.split_heavy_keys(df, ["k"], ["ts", "seq"], 100)
    sizes = parts.groupBy("k", skew.PART).agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    found = sizes.filter("k = 1").orderBy(skew.PART).collect()
    assert max(r.n for r in found) <= 60 and sum(r.n for r in found) == 1000
    # Ranges follow the order, missing times first.
    assert found[0].lo is None
    for a, b in zip(found, found[1:]):
        assert a.hi is None or a.hi <= b.lo


def test_cut_and_uncut_agree_on_bursts(spark):
    df = burst_data(spark)
    for cut, whole in (
        (labels.label_changes(df, "k", ["p", "q"], ["ts", "seq"], ["seq"], h) for h in (100, 10**9)),
        (labels.label_changes(df, "k", ["p", "q"], ["ts", "seq", "p"], ["seq"], h) for h in (100, 10**9)),
        (labels.emit_on_change(df, "k", ["p", "q"], ["ts", "seq"], h) for h in (100, 10**9)),
        (dedup.keep_if_newer(df, ["k"], "seq", ["ts", "seq"], h) for h in (100, 10**9)),
    ):
        assert rows(cut) == rows(whole) and whole.count() > 2


def test_bursts_are_cut_by_texts(spark):
    from buyerlens.operators import skew

    plain = burst_data(spark)
    name = F.format_string("Order#%09d", "seq")
    for second in (name, name.cast("binary"), F.timestamp_millis("seq"), F.col("seq").cast("decimal(20,2)")):
        df = plain.withColumn("no", second)
        parts, cut = skew.split_heavy_keys(df, ["k"], ["ts", "no"], 100)
        found = parts.filter("k = 1").groupBy(skew.PART).agg(F.count("*").alias("n")).collect()
        assert cut and max(r.n for r in found) <= 60 and sum(r.n for r in found) == 1000
        by_part, by_order = (
            [r.seq for r in parts.filter("k = 1").orderBy(*o).collect()] for o in ([skew.PART, "ts", "no"], ["ts", "no"])
        )
        assert by_part == by_order
        a, b = (labels.label_changes(df, "k", ["p", "q"], ["ts", "no"], ["seq"], h) for h in (100, 10**9))
        assert rows(a) == rows(b) and b.count() > 2


def test_texts_cut_by_their_first_difference(spark):
    from buyerlens.operators import skew

    texts = ["", "\u00e9", "z", None, "user-\u65e5"] + [f"user-{i:05d}" for i in range(300)]
    df = spark.createDataFrame([(1, t, i) for i, t in enumerate(texts)] + [(None, f"user-{i:03d}", i) for i in range(200)], "k int, t string, i int")
    parts, cut = skew.split_heavy_keys(df, ["k"], ["t"], 100)
    assert cut and parts.filter(F.col(skew.PART) == 0).isEmpty() and parts.count() == len(texts) + 200
    for key in ("k = 1", "k IS NULL"):
        own = parts.filter(key)
        assert [r.i for r in own.orderBy(skew.PART, "t").collect()] == [r.i for r in own.orderBy("t").collect()]
    assert parts.filter("k IS NULL").groupBy(skew.PART).count().agg(F.max("count")).head()[0] <= 20


def test_many_heavy_keys_are_joined(spark, monkeypatch):
    from buyerlens.operators import skew

    df = spark.range(2000).selectExpr("id % 10 AS k", "id AS seq")
    sent, _ = skew.split_heavy_keys(df, ["k"], ["seq"], 100)
    monkeypatch.setattr(skew, "SENT_KEYS", 3)
    joined, cut = skew.split_heavy_keys(df, ["k"], ["seq"], 100)
    assert cut and rows(joined) == rows(sent) and joined.filter(F.col(skew.PART) == 0).isEmpty()


def test_label_profile_ties(spark):
    df = frame(spark, [(1, 1, 1, "b", "x"), (1, 2, 2, "a", "x"), (2, 3, 3, None, "y"), (2, 4, 4, None, "x")])
    assert rows(labels.label_profile(df, "k", ["p", "q"])) == [(1, "a", "x"), (2, None, "x")]


def test_latest_and_first(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 9, "z"), (1, 9, "y"), (2, None, "c")], "k int, ts long, v string")
    assert rows(dedup.latest_state(df, ["k"], "ts", ["v"]), "k", "v") == [(1, "y"), (2, "c")]
    assert rows(dedup.keep_first(df, ["k"], ["ts", "v"]), "k", "v") == [(1, "b"), (2, "c")]


def test_hot_key_sends_one_row_per_task(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS ts")
    plan = dedup.latest_state(df, ["k"], "ts", ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


# -- joins -------------------------------------------------------------------------------------


@pytest.mark.parametrize("lower,upper", [(-5000, 5000), (0, 0), (-3, 11), (1000, 4000)])
def test_interval_join(spark, lower, upper):
    rnd = random.Random(5)
    left = [(0 if rnd.random() < 0.4 else rnd.randrange(6), rnd.randrange(-50_000, 50_000), i) for i in range(200)]
    right = [(0 if rnd.random() < 0.4 else rnd.randrange(6), rnd.randrange(-50_000, 50_000), i) for i in range(200)]
    right += [(k, t + d, 1000 + i) for i, (k, t, _) in enumerate(left[:40]) for d in (lower - 1, lower, upper, upper + 1)]
    want = [(i, j) for k, t, i in left for rk, rt, j in right if k == rk and lower <= rt - t <= upper]
    l = spark.createDataFrame(left, "k int, t long, i int")
    r = spark.createDataFrame(right, "rk int, rt long, j int")
    got = joins.interval_join(l, r, [("k", "rk")], "t", "rt", lower, upper)
    assert sorted((x.i, x.j) for x in got.collect()) == sorted(want)
    assert got.columns == ["k", "t", "i", "rk", "rt", "j"]


def test_interval_join_ignores_null_times_and_rejects_clashes(spark):
    l = spark.createDataFrame([(1, None)], "k int, t long")
    r = spark.createDataFrame([(1, 5)], "rk int, rt long")
    assert joins.interval_join(l, r, [("k", "rk")], "t", "rt", -5, 5).count() == 0
    with pytest.raises(ValueError):
        joins.interval_join(l, l, [("k", "k")], "t", "t", 0, 1)


def test_merge_records(spark):
    df = spark.createDataFrame([(1, "left", "right", 2)], "a int, b string, r_b string, r_c int")
    assert rows(joins.merge_records(df, ["a", "b"], ["b", "c"], "r_")) == [(1, "right", 2)]


def test_lookup_default(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "code string")
    dim = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string")
    got = lookups.lookup(df, dim, ("code", "dic_code"), ["dic_name"], "N/A")
    assert rows(got) == [(None, "N/A"), ("1", "one"), ("9", "N/A")]


def test_last_sku(spark):
    skus = spark.createDataFrame(
        [(1, "b", 5, "x"), (1, "a", 9, "y"), (2, None, None, None), (2, "c", None, "z")],
        "sku_id int, tm_name string, sku_price int, order_category string",
    )
    assert rows(lookups.last_sku(skus)) == [(1, "a", 9, "y"), (2, "c", None, "z")]
    numbered = skus.withColumn("seq", -F.coalesce("sku_price", F.lit(0)))
    assert rows(lookups.last_sku(numbered))[0] == (1, "b", 5, "x")


def test_dimension_chains(spark):
    c1 = spark.createDataFrame([(1, "L1")], "id int, name string")
    c2 = spark.createDataFrame([(10, "L2", 1), (11, "none", 99)], "id int, name string, category1_id int")
    c3 = spark.createDataFrame([(100, "L3", 10), (101, "x", 11)], "id int, name string, category2_id int")
    assert rows(lookups.category_dim(c1, c2, c3)) == [(100, "L3", "L2", "L1")]
    sku = spark.createDataFrame(
        [(7, 5, 100, 1), (8, 6, 101, 2), (9, 7, None, None)], "id int, price int, category3_id int, tm_id int"
    )
    compare = spark.createDataFrame([(1, "Cat")], "id int, order_category string")
    tm = spark.createDataFrame([(1, "Brand")], "id int, tm_name string")
    got = lookups.sku_dim(sku, c3, c2, c1, compare, tm)
    assert rows(got) == [(7, "Brand", 5, "Cat"), (8, None, 6, None), (9, None, 7, None)]


def test_search_category_duplicates(spark):
    df = spark.createDataFrame([("t",), ("u",), ("a,b",), (None,)], "search_item string")
    cats = spark.createDataFrame([(1, "t", "old"), (2, "t", "new"), (3, "u", "bare")], "id int, b3name string, b1name string")
    cmp = spark.createDataFrame([(5, "new", "second"), (4, "new", "first")], "id int, category_name string, search_category string")
    got = lookups.search_category(df, cats, cmp)
    assert rows(got) == [
        (None, None, "unknown"), ("a,b", None, "unknown"), ("t", "new", "first"), ("u", "bare", "unknown"),
    ]


# -- activity ----------------------------------------------------------------------------------


def views(spark):
    return cdc.project_page_log(cdc.parse_records(shop.texts(spark, shop.pages()), schemas.PAGE_LOG)[0])


def test_page_projection(spark):
    got = views(spark)
    assert {r.uid for r in got.filter("ts = %d" % shop.T0).collect()} == {"-1"}
    assert got.filter("uid = ''").count() == 0
    assert {r.os for r in got.collect()} == {"iOS", "Android", "Harmony"}


def test_equal_views_on_two_pages_count_once(spark):
    both = [shop.view("1", 5, page="home"), shop.view("1", 5, page="cart", sid="other"), shop.view("1", 6)]
    log = cdc.project_page_log(cdc.parse_records(shop.texts(spark, both), schemas.PAGE_LOG)[0])
    assert activity.user_activity(dedup.dedup_exact(log)).first().pv == 2


def test_activity_snapshots(spark):
    once = [tuple(r) for r in dedup.dedup_exact(views(spark)).select("uid", "ts", "os", "search_item").collect()]
    want = []
    for uid, w in sorted({(u, t // 120_000) for u, t, _, _ in once}):
        seen = [r for r in once if r[0] == uid and r[1] // 120_000 <= w]
        os = {r[2] for r in seen}
        terms = {r[3] for r in seen if r[3] is not None}
        judge = "iOS" if "iOS" in os else "Android" if "Android" in os else min(os)
        last = max(r[1] for r in seen)
        want.append((uid, last, len(seen), judge, next(iter(terms)) if len(terms) == 1 else None))
    got = activity.activity_snapshots(dedup.dedup_exact(views(spark)))
    assert rows(got) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    assert any(r[4] is None for r in want) and any(r[4] for r in want)


def test_activity_without_terms_is_empty_text(spark):
    df = spark.createDataFrame([("1", 5, "b", None), ("1", 6, "a", None)], "uid string, ts long, os string, s string")
    assert rows(activity.user_activity(df, set_cols=["os", "s"])) == [("1", 2, 6, "a,b", "")]


def test_tumbling_last(spark):
    df = spark.createDataFrame(
        [("u", 0, 1), ("u", 119_999, 2), ("u", 119_999, 3), ("u", 120_000, 4), ("v", 5, 5)], "uid string, ts long, n int"
    )
    got = activity.tumbling_last(df, "uid", "ts", ["n"])
    assert rows(got, "uid", "n") == [("u", 3), ("u", 4), ("v", 5)]


# -- scoring -----------------------------------------------------------------------------------


def test_unlisted_labels_score_zero(spark):
    df = spark.createDataFrame([("none",), (None,)], "l string")
    for row in scoring.score(df, {"tm": "l"}).collect():
        assert all(v == 0 for v in row[1:])


def test_oldest_band_of_device_and_search(spark):
    df = spark.createDataFrame([("iOS", "性价比")], "os string, s string")
    scored = scoring.score(df, {"device": "os", "search": "s"})
    assert {c for c in scored.columns if c.endswith("_50")} == {f"{d}_50" for d in SHORT_OLDEST_BAND}
    plain = scoring.total_scores(scored, ["device", "search"]).first()
    fixed = scoring.total_scores(scored, ["device", "search"], fix_50_plus=True).first()
    assert float(plain["50以上"]) == 0 and float(fixed["50以上"]) == pytest.approx(0.02 + 0.12)


def test_ties_follow_fixed_order(spark):
    from decimal import Decimal

    def top(**sums):
        values = [Decimal(sums.get(f"b{i}", "0")) for i in range(6)]
        schema = ", ".join(f"`{b}` decimal(6,3)" for b in BANDS)
        return scoring.top_band(spark.createDataFrame([tuple(values)], schema)).first()["shop_age"]

    assert top() == "50以上"
    assert top(b0="0.1", b1="0.1") == "18_24"
    assert top(b2="0.1", b0="0.1") == "30_34"
    assert top(b3="0.1", b4="0.1", b1="0.05") == "35_39"
    assert top(b4="0.2", b3="0.1") == "40_49"


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Running labels: no task sorts more than its share, however few partitions the settings name."""
    from buyerlens.operators import skew

    monkeypatch.setattr(skew, "TASK_ROWS", 50)
    data = [(k % 200, f"p{k % 3}", f"q{k % 5}", k) for k in range(2000)]
    df = spark.createDataFrame(data, "k long, p string, q string, seq long")
    got = labels.label_changes(df, "k", ["p", "q"], ["seq"], ["seq"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert got.rdd.getNumPartitions() == 2000 // 50 + 1
    assert rows(got) == rows(labels.label_changes(df, "k", ["p", "q"], ["seq"], ["seq"], None))
