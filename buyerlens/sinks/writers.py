"""Batch and streaming writers.

Streaming writers take a checkpoint folder (default: under the cluster's shared folder) and return the
started query. ``once=True`` processes what is available and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from buyerlens.operators.cdc import to_json_value
from buyerlens.operators.dedup import latest_state
from buyerlens.schemas import PORTRAIT_COLUMNS
from buyerlens.session import shared_dir


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    """Acknowledged by all replicas, unlimited retries, idempotent producer."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": str(2**31 - 1),
        "kafka.enable.idempotence": "true",
    }


def write_kafka(df: DataFrame, servers: str, topic: str, name: str):
    """Rows as JSON text to a topic (at least once on streams)."""
    value, options = to_json_value(df), kafka_write_options(servers, topic)
    if df.isStreaming:
        return start(value.writeStream.format("kafka").options(**options), df, name, False)
    return value.write.format("kafka").options(**options).save()


def write_files(
    df: DataFrame, path: str, name: str, fmt: str = "parquet", once: bool = True, **options
) -> StreamingQuery | None:
    """Append rows to a folder: exactly once for streams."""
    if df.isStreaming:
        writer = df.writeStream.format(fmt).options(**options).outputMode("append").option("path", path)
        return start(writer, df, name, once)
    df.write.format(fmt).options(**options).mode("append").save(path)
    return None


def write_json_lines(df: DataFrame, path: str, name: str, once: bool = True):
    """One JSON object per line: the load format of analytic stores."""
    return write_files(df, path, name, "json", once)


def write_portrait_csv(df: DataFrame, path: str, name: str, once: bool = True):
    """The flat portrait file: sixteen columns in fixed order, missing values as ``null``."""
    return write_files(
        df.select(*PORTRAIT_COLUMNS), path, name, "csv", once, nullValue="null", emptyValue=""
    )


def write_console(df: DataFrame, name: str, once: bool = True, rows: int = 20):
    if df.isStreaming:
        writer = df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
        return start(writer, df, name, once)
    return df.show(rows, truncate=False)


def write_jdbc(df: DataFrame, url: str, table: str, name: str, once: bool = True, **options):
    """Append to a relational or analytic table; a retried micro-batch may append again.

    Where the store can replace a load by its number, use :func:`buyerlens.sinks.keyed.write_with_ledger`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()

    if not df.isStreaming:
        return save(df, 0)
    return start(df.writeStream.foreachBatch(save), df, name, once)


def start(writer, df: DataFrame, name: str, once: bool) -> StreamingQuery:
    """Start a stream's writer under a name, with its checkpoint in the shared folder."""
    root = shared_dir(df.sparkSession)
    writer = writer.queryName(name).option("checkpointLocation", f"{root}/queries/{name}")
    return (writer.trigger(availableNow=True) if once else writer).start()


# -- keyed tables ------------------------------------------------------------------------------


def as_cells(df: DataFrame, row_key: str) -> DataFrame:
    """Every field but the key as text, as a keyed store holds them."""
    return df.select(
        F.col(row_key).cast("string").alias(row_key),
        *[F.col(c).cast("string").alias(c) for c in df.columns if c != row_key],
    )


def merge_by_key(
    old: DataFrame, new: DataFrame, keys: list[str], ts: str, order: list[str]
) -> DataFrame:
    """Newest row per key of both frames; at equal ``ts`` the new frame wins."""
    both = old.withColumn("__old", F.lit(1)).unionByName(
        new.withColumn("__old", F.lit(0)), allowMissingColumns=True
    )
    return latest_state(both, keys, ts, ["__old", *order]).drop("__old")


def write_changes(
    df: DataFrame,
    path: str,
    name: str,
    once: bool = True,
    work: Callable[[DataFrame], DataFrame] | None = None,
):
    """Append upserts to a change log, one folder per micro-batch; ``work`` is done on each batch first.

    A retried batch rewrites its own folder, so the log never holds a batch twice. Read the table
    with :func:`current_rows`.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        done = work(batch) if work else batch
        done.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    if not df.isStreaming:
        raise ValueError("a change log is written by a stream; use merge_by_key for static tables")
    return start(df.writeStream.foreachBatch(save), df, name, once)


def current_rows(spark: SparkSession, path: str, keys: list[str], ts: str) -> DataFrame:
    """Newest row per key of a change log; at equal ``ts`` the later batch wins."""
    log = spark.read.parquet(path).withColumn("__newer", -F.col("batch_id"))
    return latest_state(log, keys, ts, ["__newer"]).drop("__newer", "batch_id")


def compact_changes(spark: SparkSession, path: str, to: str, keys: list[str], ts: str) -> None:
    """Write the current rows of a change log to a new folder as a log of one batch.

    Readers and the stream's next start move to the new folder; the old one is the caller's to drop.
    """
    current_rows(spark, path, keys, ts).write.mode("errorifexists").parquet(f"{to}/batch_id=-1")


# -- tables and dictionaries -------------------------------------------------------------------


def table_exists(spark: SparkSession, table: str, namespace: str = "default") -> bool:
    return spark.catalog.tableExists(f"{namespace}.{table}")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: str,
    namespace: str = "default",
    partition_by: list[str] | None = None,
) -> bool:
    """Create the parquet table unless it is there; True if it exists afterwards."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{table}` ({schema}) USING parquet{parts}")
    return table_exists(spark, table, namespace)


def write_dictionary(words: DataFrame, path: str) -> None:
    words.write.mode("overwrite").parquet(path)


def write_routed(df: DataFrame, path: str, name: str, value_col: str = "value", once: bool = True):
    """Land a change topic partitioned by source table, so each consumer reads only its own part.

    The place of arrival is kept if the source gives it, since newest-version rules go by it.
    """
    table = F.coalesce(F.get_json_object(value_col, "$.source.table"), F.lit("unknown"))
    arrival = [c for c in ("arrival",) if c in df.columns]
    landed = df.select(F.col(value_col).alias("value"), *arrival, table.alias("table"))
    if df.isStreaming:
        writer = landed.writeStream.format("parquet").partitionBy("table").option("path", path)
        return start(writer, df, name, once)
    landed.write.mode("append").partitionBy("table").parquet(path)
    return None
