"""Event time for plans that run on static and streaming input alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from buyerlens.functions.calendar import event_time

WATERMARK = "3 seconds"


def timed(df: DataFrame, millis: str, out: str, delay: str | None = WATERMARK) -> DataFrame:
    """Add the join time ``out``: a watermarked TIMESTAMP on streams, epoch millis otherwise.

    A missing time counts as the epoch. Without a delay there is no watermark: no row is ever too late.
    """
    if df.isStreaming:
        marked = df.withColumn(out, event_time(millis))
        return marked.withWatermark(out, delay) if delay else marked
    return df.withColumn(out, F.coalesce(F.col(millis).cast("bigint"), F.lit(0).cast("bigint")))


def window_last(
    df: DataFrame, key: str, time_col: str, cols: list[str], size: str = "2 minutes"
) -> DataFrame:
    """Last row per key and event-time window of a watermarked stream, when the window closes.

    The result keeps ``time_col`` as the window's time, so it can feed an interval join.
    """
    last = df.groupBy(F.window(time_col, size), key).agg(
        F.max_by(F.struct(*cols), F.struct(time_col, *cols)).alias("v")
    )
    return last.select(F.window_time("window").alias(time_col), key, "v.*")
