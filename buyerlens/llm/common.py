"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import buyerlens
from buyerlens.session import shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship_package(spark: SparkSession) -> None:
    """Give a local session's workers this package, unless they find it by PYTHONPATH or working folder.

    On a cluster it is installed or sent with --py-files, as usual.
    """
    root = Path(buyerlens.__file__).resolve().parents[1]
    context = spark.sparkContext
    if not context.master.startswith("local["):
        return
    found = [Path.cwd(), *(Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p)]
    if root in found or getattr(context, "_buyerlens_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="buyerlens-"), "buyerlens.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "buyerlens").rglob("*.py")):
            z.write(f, f.relative_to(root))
    context.addPyFile(path)
    context._buyerlens_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder in the shared place the cluster names."""
    return f"{shared_dir(spark)}/llm/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """The frame written once to the shared folder and read back, so that lineage ends there."""
    path = new_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(col: Column) -> Column:
    """A-Z only: other letters keep their case."""
    return F.translate(col, UPPER, LOWER)


def fold(id_col: str, buckets: int) -> Column:
    """crc32 of an id as text, modulo a number; a null id falls into bucket 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % buckets, F.lit(0))


def per_batch(
    df: DataFrame, fn: Callable[[list[pa.Array]], dict[str, Iterable]], schema: str
) -> DataFrame:
    """Apply ``fn`` to the columns of each Arrow batch; it returns the columns of ``schema``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in batches:
            if batch.num_rows:
                out = fn(batch.columns)
                kinds = kinds or _arrow_schema(schema)
                yield pa.RecordBatch.from_arrays(
                    [_array(out[f.name], f.type) for f in kinds], schema=kinds
                )

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        return values.cast(kind)
    return pa.array(values, type=kind)


_KINDS = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "float": pa.float32(),
    "string": pa.string(),
    "binary": pa.binary(),
    "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<double>": pa.list_(pa.float64()),
    "array<float>": pa.list_(pa.float32()),
    "array<string>": pa.list_(pa.string()),
    "array<binary>": pa.list_(pa.binary()),
}


def _arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (part.split() for part in ddl.split(", "))])


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
