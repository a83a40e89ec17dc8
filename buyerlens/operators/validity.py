"""Joins of slowly changing values by the runs in which they stay equal (static input).

Two histories of one key are paired where their times are at most ``gap`` apart, and a pair's time is the later
one. Written out, every change on one side meets every row of the other side nearby. But the other side
repeats itself: its rows are runs of equal values. So each change meets each *run* once, and two facts give
all pairs' times: whether the run has a row up to ``gap`` before the change (then the change's own time is one), and
that all rows of the run up to ``gap`` after it are. The latter are intervals, which are united per run and result
before the run's rows are looked up in them, so the work is linear in the changes and in the rows. Changes and runs
meet by key and stretch of time, so a hot key is spread over its stretches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window as W, functions as F

from buyerlens.session import settle


def with_runs(df: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """``df`` with ``run``: rows of a key in order of ``ts`` that agree in ``cols`` without a break share it.

    Rows of equal time are ordered by their values.
    """
    order = W.partitionBy(key).orderBy(ts, *cols)
    values = F.struct(*cols)
    before = F.lag(values).over(order)
    fresh = before.isNull() | ~values.eqNullSafe(before)
    return df.withColumn("__new", fresh.cast("int")).withColumn("run", F.sum("__new").over(order)).drop("__new")


def runs(rows: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """One row for each run that ``with_runs`` found: key, run, first, last and the values."""
    found = rows.groupBy(key, "run").agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.any_value(F.struct(*cols)).alias("v")
    )
    return found.select(key, "run", "first", "last", "v.*")


def last_at(df: DataFrame, rows: DataFrame, key: str, ts: str, gap: int) -> DataFrame:
    """``df`` with ``seen``: the latest ``ts`` among the key's ``rows`` that is at most the row's own and not
    more than ``gap`` older; null if there is none.

    Rows are compared within stretches of ``gap``, each of which begins with the last row of the one before, so
    a key with many rows is spread over time.
    """
    place = F.floor(F.col(ts) / F.lit(gap)).alias("__part")
    points = rows.select(key, ts, place).groupBy(key, ts, "__part").agg(F.lit(1).alias("__is"))
    carried = points.groupBy(key, "__part").agg(F.max(ts).alias(ts))
    carried = carried.select(key, ts, (F.col("__part") + 1).alias("__part"), F.lit(1).alias("__is"))
    points = points.unionByName(carried).withColumn("__point", F.col(ts)).drop("__is")
    both = df.select("*", place, F.lit(None).cast("bigint").alias("__point")).unionByName(points, allowMissingColumns=True)
    order = W.partitionBy(key, "__part").orderBy(ts, F.col("__point").isNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = F.max("__point").over(order)
    out = both.withColumn("seen", seen).filter(F.col("__point").isNull()).drop("__part", "__point")
    return out.withColumn("seen", F.when(F.col("seen") >= F.col(ts) - gap, F.col("seen")))


def history(rows: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """The other side of :func:`paired_times`: rows with their runs, written once. Null keys and times are left out."""
    rows = rows.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(key, ts, *cols)
    return settle(with_runs(rows, key, ts, cols))  # read four times; what stands before is done once


def paired_times(
    changes: DataFrame, rows: DataFrame, key: str, ts: str, cols: list[str], gap: int, result: Callable[[DataFrame], DataFrame], out: str
) -> DataFrame:
    """(key, out, ts), distinct: for each change and row of a key at most ``gap`` apart, what ``result`` makes of
    both and the later of their times.

    ``rows`` may come from :func:`history`, then they are not worked out again. ``result`` adds ``out`` to a frame that has the columns of ``changes`` and ``cols`` of a run; both sides hold
    the time in ``ts`` (epoch millis), their other names differ. Null keys and times pair with nothing.
    """
    changes = changes.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rows = rows if "run" in rows.columns else history(rows, key, ts, cols)
    # A run stands in every stretch from which a change reaches it, a change in its own only: they meet once at most.
    stretch = lambda c: F.floor(F.col(c) / F.lit(gap))
    spans = runs(rows, key, ts, cols).withColumn("__at", F.explode(F.sequence(stretch("first") - 1, stretch("last") + 1)))
    seen = last_at(changes, rows, key, ts, gap).withColumn("__at", stretch(ts))
    met = seen.join(spans, [key, "__at"])
    met = met.filter((F.col("first") <= F.col(ts) + gap) & (F.col("last") >= F.col(ts) - gap))
    met = settle(result(met).select(key, ts, out, "run", "first", "last", "seen"))
    # A row of the run up to the change: the run's last, or the key's latest row if the run goes on.
    before = (F.col("last") <= F.col(ts)) | ((F.col("first") <= F.col(ts)) & F.col("seen").isNotNull())
    at_change = met.filter(before).select(key, out, ts)
    # Of changes in one stretch of ``gap`` the intervals overlap, so they are one.
    after = (
        met.filter(F.col("last") > F.col(ts))
        .groupBy(key, "run", out, F.floor(F.col(ts) / F.lit(gap)).alias("__part"))
        .agg(F.min(ts).alias("low"), F.max(ts).alias("high"))
        .withColumn("high", F.col("high") + gap)
    )
    parts = F.sequence(F.floor(F.col("low") / F.lit(gap)), F.floor(F.col("high") / F.lit(gap)))
    after = after.select(key, "run", out, "low", "high", F.explode(parts).alias("__part"))
    points = rows.select(key, "run", ts, F.floor(F.col(ts) / F.lit(gap)).alias("__part"))
    inside = after.join(points, [key, "run", "__part"]).filter((F.col(ts) > F.col("low")) & (F.col(ts) <= F.col("high")))
    return at_change.unionByName(inside.select(key, out, ts)).distinct()
