"""Joins by runs of equal values against all pairs, and how many pairs they make."""

import random

import pytest
from pyspark.sql import functions as F

from buyerlens.operators import validity
from conftest import rows

GAP = 100


def histories(seed, keys=3, n=40, span=1500):
    rnd = random.Random(seed)
    changes = [(rnd.randrange(keys), rnd.randrange(span), rnd.randrange(4)) for _ in range(n)]
    values = [(k, t, rnd.randrange(2) if rnd.random() < 0.2 else t // 400) for k in range(keys) for t in rnd.sample(range(span), 60)]
    values += [(0, 500, 7), (0, 500, 8), (0, 500, 7)]  # equal times, equal rows
    return [*changes, (None, 5, 1), (1, None, 1), (77, 3, 1)], [*values, (None, 5, 1), (1, None, 1), (88, 3, 1)]


def frames(spark, changes, values):
    left = spark.createDataFrame(changes, "k long, t long, a int")
    return left, spark.createDataFrame(values, "k long, t long, v int")


def brute(changes, values):
    pairs = [(c, r) for c in changes for r in values if None not in (*c[:2], *r[:2]) and c[0] == r[0] and abs(c[1] - r[1]) <= GAP]
    return sorted({(c[0], str(10 * c[2] + r[2]), max(c[1], r[1])) for c, r in pairs})


def result(df):
    return df.withColumn("out", (10 * F.col("a") + F.col("v")).cast("string"))


@pytest.mark.parametrize("seed", range(4))
def test_equals_all_pairs(spark, seed):
    changes, values = histories(seed)
    left, right = frames(spark, changes, values)
    got = validity.paired_times(left, right, "k", "t", ["v"], GAP, result, "out")
    assert sorted(map(tuple, got.collect())) == brute(changes, values)


def test_bounds_and_nothing(spark):
    changes, values = [(1, 1000, 0)], [(1, 1000 + d, 5) for d in (-GAP - 1, -GAP, 0, 1, GAP, GAP + 1)]
    left, right = frames(spark, changes, values)
    got = validity.paired_times(left, right, "k", "t", ["v"], GAP, result, "out")
    assert rows(got, "t") == [(1000,), (1001,), (1000 + GAP,)]
    none = validity.paired_times(left.limit(0), right, "k", "t", ["v"], GAP, result, "out")
    assert none.collect() == [] and validity.paired_times(left, right.limit(0), "k", "t", ["v"], GAP, result, "out").collect() == []


def test_pairs_are_linear_in_changes(spark):
    """A busy key: 400 changes and 400 rows within the gap make 400 pairs with each run, not 160,000."""
    left, right = frames(spark, [(1, 10 * i, i % 3) for i in range(400)], [(1, 10 * i + 5, i // 200) for i in range(400)])
    seen = []

    def counted(df):
        seen.append(df.count())
        return result(df)

    got = validity.paired_times(left, right, "k", "t", ["v"], 10_000, counted, "out")
    assert seen == [800]
    assert got.count() == len({(str(10 * a + v), max(s, t)) for s, a in ((10 * i, i % 3) for i in range(400)) for t, v in ((10 * j + 5, j // 200) for j in range(400))})
