"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic scores.

Each text becomes a row of statistics (lengths, repetition, letter and sign shares). Standardised
statistics x become sqrt(2 / D) cos(W x + b) with normal W, whose inner products approximate a Gaussian
kernel. Every task sums the normal equations of its labelled rows and the sums are added row by row, so
what is gathered has the size of the model. The ridge scores of each half of the rows, fitted on the other
half, are made probabilities by isotonic regression over fine bins.

Statistics depend on the text only, and on the whole of it, however long. Null and empty texts have all-zero
statistics and a score like any other. Rows of ``docs`` that repeat an id are scored each, and each is learned
from. Other columns are not read, whatever their names (``keep_good`` hands them on). Labels that are null are
left out; a document labelled more than once counts by its mean label. Empty tables give empty results.
Without labels, or without both classes, every score is the mean label (one half if there is none).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from buyerlens.llm.common import text_or_empty, written

FEATURES = 256  # random features
RIDGE = 1e-2  # penalty per labelled row
SEED = 20240607
BINS = 4096
CLIP = 6.0  # standard deviations

_KIND = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 sign, 6 beyond ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5
_KIND[[ord(c) for c in ".,"]] = 0

STATISTICS = 26


def statistics(text: str) -> list[float]:
    """Fixed-length numbers that describe a whole text."""
    raw = text.encode()
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * STATISTICS
    size = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=7) / size
    share = counts[counts > 0] / size
    lengths = np.fromiter(map(len, words), np.float64, n)
    kept = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = text.split("\n")
    upper = sum(map(str.isupper, words))
    letters = sum(map(str.isalpha, words))
    signs = sum(w[-1] in "!#$%&*|<>{}=~^@+_" for w in words)
    ends = sum(w[-1] in ".!?" for w in words)
    bare = sum(not any(map(str.isalnum, w)) for w in words if len(w) < 4)
    return [
        np.log1p(size),
        np.log1p(n),
        float(lengths.mean()),
        float(lengths.std()),
        np.log1p(lengths.max()),
        len(kept) / n,
        np.log(len(kept)) / np.log(n + 1),
        max(kept.values()) / n,
        (len(pairs) + 1) / n,
        same / n,
        *kinds[:7].tolist(),
        float(-(share * np.log(share)).sum()),
        upper / n,
        letters / n,
        signs / n,
        ends / n,
        bare / n,
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
        counts[33] / n,
    ]


def statistics_of(text: Column) -> Column:
    @arrow_udf("array<float>")
    def run(texts: pa.Array) -> pa.Array:
        rows = np.array([statistics(t) for t in map(pa.StringScalar.as_py, texts)], np.float32)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * STATISTICS
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel()))

    return run(text)


def with_statistics(docs: DataFrame, text: str = "text", out: str = "x") -> DataFrame:
    return docs.withColumn(out, statistics_of(text_or_empty(text)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS).astype(np.float64)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of the random features
    phase: np.ndarray
    ridge: np.ndarray
    knots: np.ndarray  # raw scores and the probabilities there
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP) @ self.weights + self.phase
        out = np.sqrt(2.0 / len(self.phase)) * np.cos(z)
        return np.hstack([out, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray, ridge: np.ndarray | None = None) -> np.ndarray:
        return self.features(x) @ (self.ridge if ridge is None else ridge)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0.0, 1.0)


def isotonic(values: np.ndarray, weights: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean place and mean label of each block, in ascending order."""
    blocks: list[list[float]] = []
    for v, w, s in zip(values, weights, sums, strict=True):
        blocks.append([w, s, v * w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def _rows(numbers: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    column = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), column], names=["i", "v"])


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """Model from labelled rows (x, y, half); y is the mean label, half is 0 or 1."""
    spark = rows.sparkSession
    rng = np.random.default_rng(SEED)
    x = [F.element_at("x", i + 1).cast("double") for i in range(STATISTICS)]
    row = rows.agg(
        *[F.avg(c) for c in x], *[F.stddev_pop(c) for c in x], F.avg("y"), F.min("y"), F.max("y"), F.count("y")
    ).head()
    some = row[2 * STATISTICS + 3] > 0
    mean = np.array([v or 0.0 for v in row[:STATISTICS]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in row[STATISTICS : 2 * STATISTICS]])
    flat = row[2 * STATISTICS] if some else 0.5
    model = Model(
        mean,
        scale,
        rng.normal(size=(STATISTICS, features)) / np.sqrt(STATISTICS / 2),
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        np.array([0.0, 1.0]),
        np.array([flat, flat]),
    )
    if not some or row[2 * STATISTICS + 1] == row[2 * STATISTICS + 2]:
        return model
    shipped = spark.sparkContext.broadcast(model)
    size = features + 1

    def part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size, size + 1))
        for b in batches:
            if b.num_rows:
                z = shipped.value.features(_matrix(b.column(0)))
                y, half = b.column(1).to_numpy(), b.column(2).to_numpy()
                for k in (0, 1):
                    own = z[half == k]
                    sums[k] += own.T @ np.column_stack([own, y[half == k]])
        yield _rows(np.arange(2 * size), sums.reshape(2 * size, size + 1))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                v = v.values.to_numpy()
                sums[i] = sums[i] + v if i in sums else v.copy()
        if sums:
            yield _rows(np.array(list(sums)), np.array(list(sums.values())))

    schema = "i int, v array<double>"
    parts = rows.select("x", F.col("y").cast("double"), F.col("half").cast("int")).mapInArrow(part_sums, schema)
    # Each task of the second step holds some rows of the sums, whatever the number of tasks before it.
    total = parts.repartition("i").mapInArrow(added, schema).toArrow()
    sums = np.zeros((2 * size, size + 1))
    for i, v in zip(total["i"].to_pylist(), total["v"].to_pylist(), strict=True):
        sums[i] = v
    sums = sums.reshape(2, size, size + 1)

    def solved(s: np.ndarray) -> np.ndarray:
        n = max(s[-1, -2], 1.0)  # the last feature is one, so this is the row count
        penalty = np.full(size, ridge * n / features)
        penalty[-1] = 1e-9
        return np.linalg.solve(s[:, :-1] + np.diag(penalty), s[:, -1])

    model.ridge = solved(sums[0] + sums[1])
    crossed = np.array([solved(sums[1]), solved(sums[0])])  # each half is scored by the other's fit
    crossed_b = spark.sparkContext.broadcast((model, crossed))

    @arrow_udf("double")
    def raw(x: pa.Array, half: pa.Array) -> pa.Array:
        m, fits = crossed_b.value
        z = m.features(_matrix(x))
        return pa.array((z * fits[half.to_numpy()]).sum(axis=1))

    scored = rows.select(raw("x", F.col("half").cast("int")).alias("raw"), "y")
    place = F.floor((F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) + 1) * (BINS / 3)).cast("int")
    bins = (
        scored.groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.avg("raw").alias("at"))
        .toPandas()  # BINS rows at most
        .sort_values("bin")
    )
    model.knots, model.values = isotonic(bins["at"].to_numpy(), bins["n"].to_numpy(float), bins["s"].to_numpy())
    return model


def labelled(features: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(x, y, half) of the documents that have a label; ``features`` has doc_id and x."""
    mean = labels.groupBy(doc_id).agg(F.avg(label).alias("y")).filter("y is not null")
    half = F.coalesce(F.crc32(F.concat(F.lit("half"), F.col(doc_id).cast("string")).cast("binary")) % 2, F.lit(0))
    return features.join(mean, doc_id).select("x", "y", half.alias("half"))


def score_udf(model: Model, spark):
    """Score of a row of statistics."""
    shipped = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def run(x: pa.Array) -> pa.Array:
        return pa.array(shipped.value.scores(_matrix(x)))

    return run


def score_documents(
    docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, train and score for every row of ``docs``; labels are learned from rows of ``training``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), training.alias("train"), F.col(f"`{text}`").alias("text"))
    rows = written(with_statistics(rows).select("doc_id", "train", "x"), "statistics")
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
    pairs = written(labelled(rows.filter("train"), known, "label"), "labelled")
    model = fit(pairs)
    return rows.select("doc_id", "train", score_udf(model, docs.sparkSession)("x").alias("score"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    least: float = 0.3,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``, learned from labels of ``training`` rows.

    Texts stay where they are: only statistics are joined to labels, and scores are computed in place.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("label"))
    rows = docs.filter(training).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pairs = written(labelled(with_statistics(rows).select("doc_id", "x"), known, "label"), "labelled")
    score = score_udf(fit(pairs), docs.sparkSession)(statistics_of(text_or_empty(text)))
    return docs.filter(score >= least)
