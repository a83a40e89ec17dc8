"""How often the portrait's steps make, read and sort their rows, and running labels across batches."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from buyerlens.catalog import standins
from buyerlens.operators import activity, cdc, dedup, joins, labels
from conftest import rows


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def leaders(data):
    """(key, leading p, leading q, seq) of (key, seq, p, q) rows whenever a leader changes, row by row."""
    out, counts, before = [], {}, {}
    for k, seq, *own in sorted(data, key=lambda r: (str(r[0]), r[1])):
        now = []
        for dim, label in enumerate(own):
            seen = counts.setdefault((k, dim), Counter())
            seen[label] += 1
            now.append(min(seen, key=lambda v: (-seen[v], v is not None, v or "")))
        if before.get(k) != now:
            before[k] = now
            out.append((k, seq, *now))
    return out


@pytest.mark.parametrize("batch", [1, 3, 10_000])
@pytest.mark.parametrize("heavy", [None, 40])
def test_labels_across_batches(spark, batch, heavy):
    rnd = random.Random(batch)
    p, q = [None, "", "a", "ä", "\U0001f600", "￮"], [None, "x", "y"]
    data = [(rnd.choice([None, "u", "v", "w" * (i % 30)]), i, rnd.choice(p), rnd.choice(q)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, seq long, p string, q string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = labels.label_changes(df, "k", ["p", "q"], ["seq"], ["seq"], heavy)
        got = rows(got, "k", "seq", "p", "q")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got, key=str) == sorted(leaders(data), key=str)


def test_labels_sort_once(spark, capsys):
    df = spark.createDataFrame([("u", 1, "a", "x")], "k string, seq long, p string, q string")
    text = plan(labels.label_changes(df, "k", ["p", "q"], ["seq"], ["seq"]), capsys)
    assert text.count("Sort [") == 1 and text.count("Exchange") == 1


def test_activity_reads_views_once(spark, capsys):
    df = spark.createDataFrame([("u", 1, "iOS", "t")], "uid string, ts long, os string, search_item string")
    text = plan(activity.activity_snapshots(dedup.dedup_exact(df)), capsys)
    assert text.count("Scan ExistingRDD") == 1


def test_first_terms(spark):
    """Terms count from the window they first appear in; rows without user or time have no term."""
    data = [
        ("u", 0, "b"), ("u", 1, None), ("u", 130_000, "b"), ("u", 250_000, ""), ("u", 250_001, "b"),
        (None, 5, "t"), ("v", None, "t"), ("v", 5, "t"), ("v", 130_000, None),
    ]
    df = spark.createDataFrame(data, "uid string, ts long, search_item string").withColumn("os", F.lit("iOS"))
    got = activity.activity_snapshots(df).select("uid", "ts", "pv", "search_item").collect()
    want = [
        ("u", 1, 2, "b"), ("u", 130_000, 3, "b"), ("u", 250_001, 5, None),
        (None, 5, 1, None), ("v", None, 1, None), ("v", 5, 2, "t"), ("v", 130_000, 3, "t"),
    ]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_texts_are_made_once(spark, tmp_path, capsys):
    spark.range(3).selectExpr("id AS c_custkey", "'n' AS c_name").write.parquet(f"{tmp_path}/customer.parquet")
    tables, _ = cdc.parse_cdc(standins.user_records(spark, str(tmp_path)), {"user_info": "id BIGINT, name STRING"})
    assert plan(tables["user_info"], capsys).count("StructsToJsonEvaluator") == 1
    assert rows(tables["user_info"], "after.id", "after.name") == [(i, "n") for i in range(3)]
    views = cdc.to_json_value(spark.range(3).withColumn("x", F.rand(1)))
    parsed, _ = cdc.parse_records(views, "id BIGINT, x DOUBLE")
    assert plan(parsed, capsys).count("StructsToJsonEvaluator") == 1


def test_interval_join_sends_no_whole_side(spark, capsys):
    left = spark.range(1).selectExpr("id + 1 AS k", "id + 1000 AS t")
    right = spark.range(2).selectExpr("1L AS j", "1500 + 7500 * id AS s")
    df = joins.interval_join(left, right, [("k", "j")], "t", "s", -1000, 1000)
    assert "Broadcast" not in plan(df, capsys)
    assert rows(df) == [(1, 1000, 1, 1500)]
