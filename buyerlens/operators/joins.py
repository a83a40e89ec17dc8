"""Time-interval joins and record merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def prefixed(df: DataFrame, prefix: str, keep: list[str] | None = None) -> DataFrame:
    """Rename every column (but ``keep``) with a prefix."""
    keep = keep or []
    return df.select([F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


def merge_records(df: DataFrame, left: list[str], right: list[str], prefix: str) -> DataFrame:
    """Merge two column sets of a joined row; a field on both sides takes the right value."""
    return df.select(
        *[c for c in left if c not in right], *[F.col(prefix + c).alias(c) for c in right]
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    left_time: str,
    right_time: str,
    lower_ms: int,
    upper_ms: int,
    extra: Column | None = None,
) -> DataFrame:
    """Inner join with ``right_time`` in ``[left_time + lower, left_time + upper]``, ends included.

    Column names of the two sides must differ. Static input has times in epoch millis; the equi key
    gets a time bucket as wide as the interval, so a hot key is spread over its buckets and compared
    only with neighbours in time, never as a whole. Left rows go to the (one or two) buckets their
    interval touches, right rows to one, so every pair is found once.

    Streaming input has TIMESTAMP times with watermarks; state is dropped as the watermark passes.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if left.isStreaming or right.isStreaming:
        cond = _equal(on)
        lt, rt = F.col(left_time), F.col(right_time)
        cond = cond & (rt >= lt + _millis(lower_ms)) & (rt <= lt + _millis(upper_ms))
        if extra is not None:
            cond = cond & extra
        return left.join(right, cond, "inner")

    width = upper_ms - lower_ms + 1
    first = F.floor((F.col(left_time) + lower_ms) / F.lit(width))
    last = F.floor((F.col(left_time) + upper_ms) / F.lit(width))
    lb = left.filter(F.col(left_time).isNotNull()).withColumn(
        "__lb", F.explode(F.sequence(first, last))
    )
    rb = right.withColumn("__rb", F.floor(F.col(right_time) / F.lit(width)))
    gap = F.col(right_time) - F.col(left_time)
    cond = _equal(on) & (F.col("__lb") == F.col("__rb")) & gap.between(lower_ms, upper_ms)
    if extra is not None:
        cond = cond & extra
    # Sizes of parsed records are guessed from those of the files, far too low: without the hint all rows of a side
    # may be sent to every executor.
    return lb.join(rb.hint("merge"), cond, "inner").drop("__lb", "__rb")


def _equal(on: list[tuple[str, str]]) -> Column:
    cond = F.lit(True)
    for lk, rk in on:
        cond = cond & (F.col(lk) == F.col(rk))
    return cond


def _millis(ms: int) -> Column:
    return F.expr(f"INTERVAL '{ms / 1000:.3f}' SECOND")
