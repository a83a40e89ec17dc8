"""File sources: recorded topics, dimension tables and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Recorded topic: one text per line."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def table_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Growing folder of files with a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def text_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def word_lines(spark: SparkSession, path: str) -> DataFrame:
    """Word list, one word per line, every line kept, in column ``value``."""
    return spark.read.text(path)


def key_values(
    spark: SparkSession,
    path: str,
    key: str = "dic_code",
    value: str = "dic_name",
    fmt: str = "parquet",
) -> DataFrame:
    """Key-value dimension (code, name) from files."""
    df = spark.read.format(fmt).load(path)
    return df.selectExpr(f"CAST(`{key}` AS STRING) AS dic_code", f"`{value}` AS dic_name")
