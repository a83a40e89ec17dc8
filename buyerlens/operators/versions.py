"""Look-ups in a dimension that changes: the version that was valid at each record's time.

A version is valid from its time until the key's next one. Records and versions are compared within stretches
of time; a stretch begins with the version that is valid at its start, which is found from the stretches'
numbers alone. So a key with a third of all records is spread over time, and no record meets more than one
version.

For a stream, give the look-up to each micro-batch with the dimension read anew (``refreshing``): a changed
name is seen without a restart, and since versions carry their times, a late record still gets the old one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window as W, functions as F

from buyerlens.functions.calendar import DAY_MS


def as_of_lookup(
    df: DataFrame,
    versions: DataFrame,
    on: tuple[str, str],
    time: str,
    valid_from: str,
    cols: list[str],
    default: str | None = None,
    stretch_ms: int = DAY_MS,
) -> DataFrame:
    """``df`` with ``cols`` of the version of its key that is valid at ``time`` (static input, epoch millis).

    ``default`` stands where no version is valid yet, where the key is unknown, and for null columns, keys and
    times. Of versions that begin at one time the greatest in ``cols`` counts.
    """
    key, dim_key = on
    place = F.floor(F.col("__at") / F.lit(stretch_ms)).alias("__part")
    known = versions.filter(F.col(dim_key).isNotNull() & F.col(valid_from).isNotNull())
    known = known.groupBy(F.col(dim_key).alias("__key"), F.col(valid_from).cast("bigint").alias("__at")).agg(
        F.max(F.struct(*cols)).alias("__v")
    )
    rows = df.select(F.struct(*df.columns).alias("__row"), F.col(key).alias("__key"), F.col(time).cast("bigint").alias("__at"))
    rows = rows.select("*", place, F.lit(2).alias("__kind"))
    # The version at the start of each stretch that has records.
    starts = rows.filter(F.col("__key").isNotNull() & F.col("__part").isNotNull()).select("__key", "__part").distinct()
    starts = starts.select("__key", (F.col("__part") * stretch_ms).alias("__at"), "__part")
    so_far = W.partitionBy("__key").orderBy("__at", F.col("__part").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = (
        known.unionByName(starts, allowMissingColumns=True)
        .withColumn("__v", F.last("__v", ignorenulls=True).over(so_far))
        .filter(F.col("__part").isNotNull() & F.col("__v").isNotNull())
        .withColumn("__kind", F.lit(0))
    )
    both = rows.unionByName(known.select("*", place, F.lit(1).alias("__kind")), allowMissingColumns=True)
    both = both.unionByName(carried, allowMissingColumns=True)
    in_order = W.partitionBy("__key", "__part").orderBy("__at", "__kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("__found", F.last("__v", ignorenulls=True).over(in_order)).filter("__kind = 2")
    kept = [F.col("__row")[c].alias(c) for c in df.columns if c not in cols]
    none = [] if default is None else [F.lit(default)]
    return found.select(*kept, *[F.coalesce(F.col("__found")[c], *none).alias(c) for c in cols])


def refreshing(
    read: Callable[[], DataFrame], work: Callable[[DataFrame, DataFrame], DataFrame]
) -> Callable[[DataFrame], DataFrame]:
    """``work`` on a micro-batch and the dimension as it is now, for writers that take a function of a batch."""
    return lambda batch: work(batch, read())
