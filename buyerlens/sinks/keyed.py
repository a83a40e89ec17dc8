"""A keyed table that is updated in place, and a ledger that keeps a store from taking a micro-batch twice.

The table lies in hash buckets of its keys, one folder each. An update reads and rewrites the buckets that its
keys fall into and no others. The merged buckets are written beside the table first and then put in place by
Spark's dynamic partition overwrite, each folder as a whole. Merging is idempotent (the newest row of a key
wins), so a batch that died half way is simply merged again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from buyerlens.operators.dedup import latest_state
from buyerlens.session import settle
from buyerlens.sinks.writers import merge_by_key, start

BUCKET = "key_bucket"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert(
    rows: DataFrame, path: str, keys: list[str], ts: str, order: list[str] | None = None, buckets: int = 64
) -> list[int]:
    """Merge ``rows`` into the table at ``path``; gives the numbers of the buckets it rewrote.

    The newest row of a key by ``ts`` stays, at equal times one of ``rows``, and of those the first in
    ``order``. ``buckets`` is a property of the table: it must be the same for every call. Null keys are keys
    like any other. Columns that one side lacks are null there.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    fresh = settle(latest_state(rows, keys, ts, order or keys).withColumn(BUCKET, bucket))
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # ``buckets`` numbers at most
    if not touched:
        return []
    old = _stored(spark, path)
    if old is not None:
        fresh = merge_by_key(old.filter(F.col(BUCKET).isin(touched)), fresh, [BUCKET, *keys], ts, order or keys)
    merged = settle(fresh)
    merged = merged.repartition(BUCKET)  # one task writes a bucket, else each would write a file of every bucket
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched


def keyed_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table's current rows."""
    return spark.read.parquet(path).drop(BUCKET)


def write_upserts(
    df: DataFrame, path: str, name: str, keys: list[str], ts: str, order: list[str] | None = None, buckets: int = 64, once: bool = True
) -> StreamingQuery | None:
    """Merge rows, of a stream by micro-batch, into a keyed table."""
    if not df.isStreaming:
        upsert(df, path, keys, ts, order, buckets)
        return None
    return start(df.writeStream.foreachBatch(lambda batch, _: upsert(batch, path, keys, ts, order, buckets)), df, name, once)


def write_with_ledger(
    df: DataFrame, save: Callable[[DataFrame, int], None], ledger: str, name: str, once: bool = True
) -> StreamingQuery:
    """Give each micro-batch to ``save`` unless the ledger says that the store has it.

    A batch is entered when ``save`` has returned. One that fails on the way is tried again under its old
    number, so ``save`` should replace what an earlier attempt of that number has left.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        entry = f"{ledger}/batch={batch_id}"
        if _stored(spark, entry) is None:
            save(batch, batch_id)
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(entry)

    return start(df.writeStream.foreachBatch(run), df, name, once)


def write_store_lines(df: DataFrame, path: str, name: str, once: bool = True) -> StreamingQuery:
    """JSON lines for an analytic store, a folder for each micro-batch: a repeated batch replaces its own folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").json(f"{path}/load={batch_id}")

    return write_with_ledger(df, save, f"{path}_ledger", name, once)
