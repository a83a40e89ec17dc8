"""Relational dimensions over JDBC. The driver jar must be on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    sql: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a query reader; ``split`` = (numeric column, lower, upper, tasks) reads in parallel.

    Column labels (aliases) of the query become the column names.
    """
    options = {"url": url, "fetchsize": str(fetch_size)}
    if split is None:
        options["query"] = sql
    else:
        column, lower, upper, tasks = split
        options.update(
            dbtable=f"({sql}) q",
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(tasks),
        )
    for name, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[name] = value
    return options


def jdbc_query(
    spark: SparkSession, url: str, sql: str, camel: bool = False, schema: str | None = None, **kw
) -> DataFrame:
    """Rows of a query; ``camel`` renames snake_case columns, ``schema`` casts to declared types."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, sql, **kw)).load()
    if camel:
        df = camel_columns(df)
    return df if schema is None else df.to(_struct(schema))


def _struct(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def snake_to_camel(name: str) -> str:
    first, *rest = name.lower().split("_")
    return first + "".join(part.capitalize() for part in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_to_camel(c) for c in df.columns])
