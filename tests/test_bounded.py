"""Steps with bounds: requests in flight, stored answers, values of a user."""

import glob
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from buyerlens.operators import activity
from buyerlens.operators.enrich import asked, enrich_bounded


class Service:
    """A slow generator that counts requests side by side."""

    def __init__(self, wait=0.03, fails=0, stuck=()):
        self.wait, self.fails, self.stuck = wait, fails, stuck
        self.now = self.most = self.calls = 0
        self.lock = threading.Lock()

    def __call__(self, prompt):
        with self.lock:
            self.now += 1
            self.calls += 1
            self.most = max(self.most, self.now)
            fails = self.calls <= self.fails
        try:
            time.sleep(1.0 if prompt in self.stuck else self.wait)
            if fails or prompt == "never":
                raise OSError("busy")
            return prompt.upper()
        finally:
            with self.lock:
                self.now -= 1


def test_requests_in_flight_are_bounded_and_side_by_side():
    service = Service()
    prompts = [f"p{i}" for i in range(40)]
    began = time.monotonic()
    assert list(asked(service, prompts, 8, 5.0, 0)) == [p.upper() for p in prompts]
    assert service.most == 8 and service.calls == 40
    assert time.monotonic() - began < 40 * 0.03


def test_failing_requests_are_tried_again():
    service = Service(wait=0, fails=2)
    assert list(asked(service, ["a", "never", "b"], 1, 5.0, 2)) == ["A", None, "B"]
    assert service.calls == 3 + 3 + 1


def test_late_requests_are_given_up():
    service = Service(wait=0, stuck={"slow"})
    assert list(asked(service, ["a", "slow", "b"], 2, 0.2, 0)) == ["A", None, "B"]


def test_each_prompt_is_asked_once_and_stored(spark, tmp_path):
    calls, store = str(tmp_path / "calls"), str(tmp_path / "store")
    os.mkdir(calls)

    def answer(prompt):
        open(f"{calls}/{prompt}-{time.monotonic_ns()}", "w").close()
        if prompt == "bad":
            raise OSError("busy")
        return prompt * 2

    df = spark.createDataFrame([(i, p) for i, p in enumerate(["x", "y", "x", None, "bad", "x"])], "id int, answer string")
    want = ["xx", "yy", "xx", None, None, "xx"]
    for _ in range(2):
        got = enrich_bounded(df, "answer", answer, F.col("answer"), store, retries=1, tasks=2)
        assert got.columns == ["id", "answer"]
        assert [r.answer for r in got.orderBy("id").collect()] == want
    asked_for = sorted(os.path.basename(f).split("-")[0] for f in glob.glob(f"{calls}/*"))
    assert asked_for == ["bad"] * 4 + ["x", "y"]  # failures are not stored: asked again, each tried twice
    more = enrich_bounded(df, "new", answer, F.concat("answer", F.lit("z")), store, retries=0)
    assert [r.new for r in more.orderBy("id").collect()][:2] == ["xzxz", "yzyz"]
    empty = enrich_bounded(df.limit(0), "answer", answer, F.col("answer"), store)
    assert empty.collect() == []


@pytest.mark.parametrize("limit", [1, 3, 100])
def test_bounded_values_equal_the_sets(spark, limit):
    views = spark.createDataFrame(
        [(i % 3 if i % 7 else None, i, f"s{i % 5}" if i % 4 else None, "") for i in range(200)],
        "uid int, ts long, os string, ch string",
    )
    want = {r.uid: r for r in activity.user_activity(views, set_cols=["os", "ch"]).collect() if r.uid is not None}
    got = {r.uid: r for r in activity.activity_bounded(views, set_cols=["os", "ch"], limit=limit).collect()}
    assert set(got) == {0, 1, 2, None}
    for uid, r in want.items():
        values = r.os.split(",")
        g = got[uid]
        assert (g.pv, g.ts, g.os, g.os_more, g.os_distinct) == (
            r.pv, r.ts, ",".join(values[:limit]), len(values) > limit, len(values)
        )
        assert (g.ch, g.ch_more, g.ch_distinct) == ("", False, 1)


def test_sketches_of_days_merge(spark):
    views = spark.range(30_000).select(
        (F.col("id") % 2).alias("uid"), F.col("id").alias("ts"), (F.col("id") % 9_001).alias("os"), (F.col("id") % 3).alias("day")
    )
    days = [activity.activity_sketches(views.filter(F.col("day") == d), set_cols=["os"]) for d in range(3)]
    merged = activity.merge_sketches(days[0].unionAll(days[1]).unionAll(days[2]), set_cols=["os"])
    for r in merged.collect():
        assert r.pv == 15_000 and r.os_distinct == pytest.approx(9_001, rel=0.05)
    bounded = activity.activity_bounded(views, set_cols=["os"], limit=50).collect()
    assert all(r.os_more and r.os_distinct == pytest.approx(9_001, rel=0.05) for r in bounded)
