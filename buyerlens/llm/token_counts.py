"""Token counts through a cache keyed by content and tokenizer digests.

A count depends on the text and the tokenizer only, so it is computed once per distinct pair: the
digests are joined to the cache table, texts without a stored count are encoded once per digest and
their counts are appended. A run that dies half way leaves a whole cache, as rows are appended by one
committed write.

Null texts count as empty. Rows that repeat, ids that are null, and columns of any other name do no
harm: rows are never joined on anything but the digest. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

from buyerlens.llm.common import new_path, text_or_empty, written

CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens long"


def normalised(col: str = "text") -> Column:
    """What the count depends on: the whole text, null as empty.

    The default tokenizer keeps white space and case, so nothing more may be folded together.
    """
    return text_or_empty(col)


def tokenizer_digest(path: str) -> str:
    """Digest of the vocabulary file and the library that reads it: either may change counts."""
    import sentencepiece
    import tokenizers

    library = tokenizers.__version__ if path.endswith(".json") else sentencepiece.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + library.encode()).hexdigest()


@lru_cache(maxsize=4)
def _counter(path: str):
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def count_udf(name: str):
    """Counts of whole texts; ``name`` is a vocabulary file every worker has."""

    @pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = _counter(public_tokenizers.path(name))
        for batch in texts:
            values = batch.tolist()
            # Few texts at a time: the library holds the pieces of all texts of a call.
            out: list[int] = []
            for i in range(0, len(values), 64):
                out += run(values[i : i + 64])
            yield pd.Series(out, dtype="int64")

    return count


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; a folder that does not exist yet is made, empty."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        spark.createDataFrame([], CACHE_SCHEMA).write.parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def fill_cache(texts: DataFrame, path: str, tokenizer: str, text: str = "text") -> None:
    """Encode the distinct texts that the cache lacks and append their counts.

    Texts are reduced to one of each digest first, within a task before they move, so a text that fills a
    third of the table is shuffled once per task; the cache, of any size, meets one row of each digest,
    which lies where the reduction has put it.
    """
    spark = texts.sparkSession
    version = tokenizer_digest(public_tokenizers.path(tokenizer))
    known = (
        open_cache(spark, path)
        .filter(F.col("tokenizer_digest") == version)
        .select("content_digest")
    )
    body = texts.select(normalised(text).alias("body"))
    misses = (
        body.select(F.sha2("body", 256).alias("content_digest"), "body")
        .dropDuplicates(["content_digest"])
        # Not an anti-join, which the optimizer would carry out before the reduction.
        .join(known.withColumn("stored", F.lit(True)), "content_digest", "left")
        .filter(F.col("stored").isNull())
    )
    misses.select(
        "content_digest",
        F.lit(version).alias("tokenizer_digest"),
        count_udf(tokenizer)("body").alias("n_tokens"),
    ).write.mode("append").parquet(path)


def token_counts(
    docs: DataFrame,
    tokenizer: str = "piece_bpe_32k.model",
    text: str = "text",
    cache: str | None = None,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, n_bytes and n_tokens for every row of ``docs``.

    ``cache`` names the cache folder; without it the call uses a new one in the shared folder.
    """
    spark = docs.sparkSession
    cache = cache or new_path(spark, "token-cache")
    fill_cache(docs, cache, tokenizer, text)
    version = tokenizer_digest(public_tokenizers.path(tokenizer))
    stored = (
        open_cache(spark, cache)
        .filter(F.col("tokenizer_digest") == version)
        # A digest may be stored twice if two runs filled the cache at once; the counts are equal.
        .groupBy("content_digest")
        .agg(F.first("n_tokens").alias("__n_tokens"))
    )
    # Two plain tables meet, so adaptive execution can split a digest that a third of the rows share.
    stored = written(stored, "token-counts")
    body = normalised(text)
    rows = docs.select(
        *keep, F.octet_length(body).cast("long").alias("__n_bytes"), F.sha2(body, 256).alias("content_digest")
    )
    return rows.join(stored, "content_digest", "left").select(
        *keep, F.col("__n_bytes").alias("n_bytes"), F.col("__n_tokens").alias("n_tokens")
    )
