"""Session helpers shared by batch jobs and streaming queries."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

DEFAULT_TZ = "Asia/Shanghai"


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and staged tables, as named by the cluster.

    Only a local session without the setting gets a folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="buyerlens-"))
        return context.getCheckpointDir()
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def use_rocksdb(spark: SparkSession) -> None:
    """Custom stateful operators need the RocksDB state store; it also keeps state off the heap."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def settle(df: DataFrame, *partitions: str) -> DataFrame:
    """Write a costly static intermediate once to the shared folder and read it back.

    For results that several branches of a plan use: later branches read only their columns, and a
    lost executor costs a re-read, not the whole lineage. Runs a job. Streams pass through. With ``partitions``
    the table has a folder for each of their values.
    """
    if df.isStreaming:
        return df
    path = f"{shared_dir(df.sparkSession)}/settled/{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, *builds: Callable[[], DataFrame]) -> list[DataFrame]:
    """Results of functions that run jobs while they build, with their jobs side by side."""
    with ThreadPoolExecutor(len(builds)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(b)) for b in builds]
        return [r.result() for r in running]
