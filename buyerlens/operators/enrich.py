"""Text generation with a caller-supplied generator."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor, TimeoutError as Late

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from buyerlens.functions.text import comment_prompt
from buyerlens.session import settle

ANSWERS = "digest string, answer string"


def enrich_text(
    df: DataFrame,
    out_col: str,
    prompt: Column | None = None,
    generator: Callable[[list[str]], Iterable[str]] | None = None,
    kind: str = "dic_name",
    product: str = "info_trade_body",
) -> DataFrame:
    """Replace or add ``out_col`` with generated text.

    ``generator`` gets the prompts of one Arrow batch and returns as many texts; it runs in the
    tasks, so it can hold a client per worker. Without one the prompt itself is the text.
    """
    prompt = comment_prompt(kind, product) if prompt is None else prompt
    if generator is None:
        return df.withColumn(out_col, prompt)

    @F.pandas_udf("string")
    def generate(prompts: pd.Series) -> pd.Series:
        return pd.Series(list(generator(prompts.tolist())), index=prompts.index, dtype=object)

    return df.withColumn(out_col, generate(prompt))


def asked(
    generator: Callable[[str], str], prompts: Iterable[str], in_flight: int, timeout: float, retries: int
) -> Iterator[str | None]:
    """Answers in the order of the prompts, with at most ``in_flight`` requests at a time.

    A request that raises is tried again, ``retries`` times at most, after a wait that doubles. One that has no
    answer ``timeout`` seconds after its turn came, all tries together, is given up: its answer is None, and its
    thread takes no further request, so a generator should have a time limit of its own.
    """

    def ask(prompt: str) -> str | None:
        for tried in range(retries + 1):
            try:
                return generator(prompt)
            except Exception:
                if tried == retries:
                    return None
                time.sleep(min(0.05 * 2**tried, timeout))

    def answer(request: Future) -> str | None:
        try:
            return request.result(timeout)
        except Late:
            request.cancel()
            return None

    pool = ThreadPoolExecutor(in_flight)
    waiting: deque[Future] = deque()
    try:
        for p in prompts:
            if len(waiting) == in_flight:
                yield answer(waiting.popleft())
            waiting.append(pool.submit(ask, p))
        while waiting:
            yield answer(waiting.popleft())
    finally:
        pool.shutdown(wait=False, cancel_futures=True)


def enrich_bounded(
    df: DataFrame,
    out_col: str,
    generator: Callable[[str], str],
    prompt: Column | None = None,
    store: str | None = None,
    in_flight: int = 8,
    timeout: float = 30.0,
    retries: int = 2,
    tasks: int | None = None,
    kind: str = "dic_name",
    product: str = "info_trade_body",
) -> DataFrame:
    """Replace or add ``out_col`` with the generator's answer to each row's prompt (static input).

    Each distinct prompt is asked once: prompts are reduced by digest, those answered in the ``store`` (a folder of
    Parquet files) are looked up there, and new answers are appended to it. ``tasks`` tasks of ``in_flight`` requests
    each run side by side, which bounds the load on the service; see :func:`asked`. A prompt without an answer
    gives null and is not stored, so the next run asks it again. A null prompt is not asked.

    A task that is run again asks its prompts again; the store commits whole runs, and of an answer that two runs
    stored the smaller counts. Streams call this on their micro-batches.
    """
    spark = df.sparkSession
    prompt = comment_prompt(kind, product) if prompt is None else prompt
    digest = F.sha2(prompt, 256)
    prompts = df.select(digest.alias("digest"), prompt.alias("prompt")).filter("digest is not null").dropDuplicates(["digest"])
    known = _stored(spark, store)
    if known is not None:
        prompts = prompts.join(known.select("digest"), "digest", "left_anti")
    if tasks:
        prompts = prompts.repartition(tasks, "digest")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            answers = asked(generator, b.column(1).to_pylist(), in_flight, timeout, retries)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(answers, pa.string())], names=["digest", "answer"])

    new = prompts.select("digest", "prompt").mapInArrow(ask, ANSWERS).filter("answer is not null")
    if store is None:
        answers = settle(new)
    else:
        new.write.mode("append").parquet(store)
        answers = _stored(spark, store)
    named = df.withColumn("__digest", digest)
    answers = answers.withColumnsRenamed({"digest": "__of", "answer": "__answer"})
    joined = named.join(answers, F.col("__digest") == F.col("__of"), "left")
    filled = joined.withColumn(out_col, F.col("__answer"))
    return filled.select(*df.columns, *([] if out_col in df.columns else [out_col]))


def _stored(spark, store: str | None) -> DataFrame | None:
    """One answer per digest of the store; None if there is no store yet."""
    if store is None:
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    return spark.read.schema(ANSWERS).parquet(store).groupBy("digest").agg(F.min("answer").alias("answer"))
