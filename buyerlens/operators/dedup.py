"""Duplicate removal and newest-version rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from buyerlens.operators import skew


def dedup_exact(
    df: DataFrame, keys: list[str] | None = None, within: str | None = None
) -> DataFrame:
    """Drop rows equal to an earlier one in ``keys`` (default: every column).

    Duplicates are removed map-side first, so a group of copies of any size shrinks before the
    shuffle, and rows spread over the cluster by their content. Streams keep keys for ever unless
    ``within`` bounds the state; the stream then needs a watermark.
    """
    keys = list(keys or df.columns)
    if within is not None and df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order (static input)."""
    return _rank_one(df, keys, [F.col(c) for c in order])


def latest_state(df: DataFrame, keys: list[str], ts: str, order: list[str]) -> DataFrame:
    """Newest row per key; of rows with equal ``ts`` the first in ``order`` (static input)."""
    return _rank_one(df, keys, [F.col(ts).desc_nulls_last(), *[F.col(c) for c in order]])


def _rank_one(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    # The "= 1" filter is pushed below the shuffle as a per-task limit, so a hot key sends one
    # row per map task, not all its rows.
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def keep_if_newer(
    df: DataFrame,
    keys: list[str],
    ts: str,
    order: list[str],
    heavy_rows: int | None = skew.HEAVY_ROWS,
) -> DataFrame:
    """In order of arrival, the first row of a key and every row newer than all before it.

    Static input; ``order`` gives the arrival (first column numeric, then tie-breaks). Keys with
    more than ``heavy_rows`` rows are cut into arrival ranges that are worked on independently;
    each range starts from one extra row holding the newest time of the ranges before it. Where
    rows arrive in order of ``ts`` itself, every new time is newer, so no ordered step is needed.
    """
    if order[0] == ts:
        return keep_first(df, [*keys, ts], order[1:] or [ts])
    parts, cut = skew.split_heavy_keys(df, keys, order, heavy_rows)
    rows = skew.with_carry(parts, _newest_before(parts, keys, ts) if cut else None)
    before = (
        W.partitionBy(*keys, skew.PART)
        .orderBy(F.desc(skew.CARRY), *order)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    newest = F.max(ts).over(before)
    return (
        rows.withColumn("__newest", newest)
        .filter(~F.col(skew.CARRY) & (F.col("__newest").isNull() | (F.col(ts) > F.col("__newest"))))
        .select(*df.columns)
    )


def _newest_before(parts: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Newest time before each range of a heavy key."""
    heads = parts.filter(F.col(skew.PART) > 0).groupBy(*keys, skew.PART).agg(F.max(ts).alias(ts))
    earlier = W.partitionBy(*keys).orderBy(skew.PART).rowsBetween(W.unboundedPreceding, -1)
    return heads.withColumn(ts, F.max(ts).over(earlier)).filter(F.col(ts).isNotNull())
