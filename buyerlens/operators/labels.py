"""Most frequent order labels per user, and output on change only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import StructType

from buyerlens.operators import skew

ORDER_DIMS = ["tm_name", "order_category", "order_price", "order_time"]


def label_profile(df: DataFrame, key: str, dims: list[str]) -> DataFrame:
    """Most frequent label of each dimension per key (static input); ties take the smallest label.

    Null is a label like any other and sorts first.
    """
    counts = (
        df.unpivot(
            [F.col(key)], [F.col(d).cast("string").alias(d) for d in dims], "dim", "label"
        )
        .groupBy(key, "dim", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy(key, "dim").agg(F.min(_rank(-F.col("n"), F.col("label"))).alias("b"))
    return best.groupBy(key).agg(
        *[F.max(F.when(F.col("dim") == d, F.col("b.label"))).alias(d) for d in dims]
    )


def _rank(neg_count: Column, label: Column) -> Column:
    return F.struct(neg_count.alias("neg"), label.alias("label"))


def emit_on_change(
    df: DataFrame,
    key: str,
    cols: list[str],
    order: list[str],
    heavy_rows: int | None = skew.HEAVY_ROWS,
) -> DataFrame:
    """Rows whose ``cols`` differ from the key's row before them (static input).

    The first row of a key is always kept; nulls compare equal. Heavy keys are cut into ranges of
    the order, each preceded by the last row of the range before.
    """
    parts, cut = skew.split_heavy_keys(df, [key], order, heavy_rows)
    rows = skew.with_carry(parts, _last_before(parts, key, cols, order) if cut else None)
    in_order = W.partitionBy(key, skew.PART).orderBy(F.desc(skew.CARRY), *order)
    return (
        rows.withColumn("__v", F.struct(*cols))
        .withColumn("__prev", F.lag("__v").over(in_order))
        .filter(
            ~F.col(skew.CARRY)
            & (F.col("__prev").isNull() | ~F.col("__v").eqNullSafe(F.col("__prev")))
        )
        .select(*df.columns)
    )


def _last_before(parts: DataFrame, key: str, cols: list[str], order: list[str]) -> DataFrame:
    """Last row before each range of a heavy key."""
    last = (
        parts.filter(F.col(skew.PART) > 0)
        .groupBy(key, skew.PART)
        .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("v"))
    )
    by_range = W.partitionBy(key).orderBy(skew.PART)
    moved = last.withColumn("v", F.lag("v").over(by_range)).filter(F.col("v").isNotNull())
    return moved.select(key, skew.PART, "v.*")


def label_changes(
    df: DataFrame,
    key: str,
    dims: list[str],
    order: list[str],
    out_cols: list[str],
    heavy_rows: int | None = skew.HEAVY_ROWS,
) -> DataFrame:
    """Running most-frequent labels per key, one row whenever any of them changes (static input).

    Counts only grow, so the leader of a dimension after a row is the best (count, smallest label)
    any row so far has reached with its own label. Rows are shuffled and sorted once; running counts and
    leaders of all dimensions are then taken from batches of sorted rows. For keys cut into ranges the carry
    rows hold the counts so far of the labels a range contains, and the leader so far. ``order`` gives
    the processing order; ``out_cols`` are kept beside the labels.
    """
    df = df.select(*dict.fromkeys([key, *dims, *order, *out_cols]))
    count, found = (None, 0) if heavy_rows is None else skew.total_rows(df, [key], heavy_rows)
    parts, cut = skew.split_heavy_keys(df, [key], order, heavy_rows if found else None)
    out_cols = [c for c in out_cols if c not in (key, *dims)]
    at, weights = [key], {}
    if cut:
        at, weights = [key, skew.PART], {d: f"__w_{d}" for d in dims}
        own = parts.select("*", *[F.lit(1).cast("bigint").alias(w) for w in weights.values()])
        parts = skew.with_carry(own, _carry_counts(parts, key, dims))
    first = [F.desc(skew.CARRY)] if cut else []
    # Each task keeps its rows sorted, so tasks are as many as the rows ask for.
    rows = skew.spread(parts, count, *at).sortWithinPartitions(*at, *first, *order)
    rows = rows.select(*at, *(skew.CARRY for _ in first), *dims, *weights.values(), *out_cols)
    schema = StructType([rows.schema[c] for c in [key, *out_cols, *dims]])

    def run(batches):
        yield from _changed(batches, at, dims, weights, schema.names)

    return rows.mapInArrow(run, schema)


def _changed(
    batches: Iterator[pa.RecordBatch], at: list[str], dims: list[str], weights: dict[str, str], out: list[str]
) -> Iterator[pa.RecordBatch]:
    """``out`` of the rows, sorted by ``at``, that change a leading label; ``dims`` in it are the leaders."""
    last, leaders = None, {}
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        place = [batch.column(c) for c in at]
        fresh = np.ones(n, bool)
        fresh[1:] = np.any([np.diff(c.dictionary_encode("encode").indices.to_numpy()) != 0 for c in place], axis=0)
        if last is None or not all(value.equals(c[0]) for value, c in zip(last, place)):
            leaders = {d: _Leader() for d in dims}
        else:
            fresh[0] = False
        last = [c[n - 1] for c in place]
        changed, labels = fresh.copy(), {}
        for d in dims:
            weight = batch.column(weights[d]).to_numpy() if weights else np.ones(n, np.int64)
            labels[d], differs = leaders[d].follow(fresh, batch.column(d), weight)
            changed |= differs
        if weights:
            changed &= ~batch.column(skew.CARRY).to_numpy(zero_copy_only=False)
        kept = pa.array(np.flatnonzero(changed))
        yield pa.RecordBatch.from_arrays([(labels[c] if c in labels else batch.column(c)).take(kept) for c in out], out)


class _Leader:
    """Counts and leading label of one dimension where a batch ended, to go on from in the next."""

    def __init__(self):
        self.counts: dict = {}
        self.best = 0  # count of the leader
        self.label = None

    def follow(self, fresh: np.ndarray, labels: pa.Array, weight: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Leader after each row, and whether it differs from the one before it; ``fresh`` rows begin a key.

        The rows before the first fresh one belong to the key the last batch ended with.
        """
        found = labels.dictionary_encode()
        texts = found.dictionary
        if self.label is not None and self.label not in (known := texts.to_pylist()):
            texts = pa.array([*known, self.label], texts.type)
        # Codes in the order of labels, null first.
        order = pc.array_sort_indices(texts)
        size = len(texts) + 1
        codes_of = np.zeros(size, np.int64)
        codes_of[order.to_numpy() + 1] = np.arange(1, size)
        code = codes_of[found.indices.fill_null(-1).to_numpy() + 1]
        texts = pa.concat_arrays([pa.nulls(1, texts.type), texts.take(order)])
        names = texts.to_pylist()
        group = np.cumsum(fresh)  # 0: the key of the batch before
        count = _running_sum(group * size + code, weight)
        ongoing = group == 0
        if ongoing.any():
            before = np.zeros(size, np.int64)
            before[:] = [self.counts.get(name, 0) for name in names]
            count[ongoing] += before[code[ongoing]]
        # The larger the count and, of equal ones, the smaller the label, the larger the number.
        reached = np.where(weight > 0, count * size + (size - 1 - code), -1)
        start = self.best * size + (size - 1 - names.index(self.label)) if self.best else -1
        best = _running_max(group, np.where(ongoing, np.maximum(reached, start), reached))
        leader = np.where(best < 0, 0, size - 1 - best % size)
        differs = np.ones(len(leader), bool)
        differs[1:] = leader[1:] != leader[:-1]
        differs[0] = leader[0] != (0 if start < 0 else size - 1 - start % size)
        if group[-1]:
            self.counts = {}
        end = group == group[-1]
        most = np.zeros(size, np.int64)
        np.maximum.at(most, code[end], count[end])
        self.counts.update((names[c], int(most[c])) for c in np.flatnonzero(most))
        self.best, self.label = max(int(best[-1]), 0) // size, names[leader[-1]]
        return texts.take(pa.array(leader)), differs


def _running_sum(cell: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of the weights so far of rows with the same cell."""
    order = np.argsort(cell, kind="stable")
    cell, total = cell[order], np.cumsum(weight[order])
    head = np.flatnonzero(np.diff(cell, prepend=-1))
    before = (total - weight[order])[head]
    out = np.empty_like(total)
    out[order] = total - np.repeat(before, np.diff(head, append=len(cell)))
    return out


def _running_max(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Largest value so far of rows of the same group; groups are numbered in order."""
    known, place = np.unique(values, return_inverse=True)
    shift = group * len(known)
    return known[np.maximum.accumulate(place + shift) - shift]


def _carry_counts(parts: DataFrame, key: str, dims: list[str]) -> DataFrame:
    """Counts before each range: for labels the range contains, and for the leader so far."""
    at = [key, skew.PART, "dim"]
    counts = (
        parts.filter(F.col(skew.PART) > 0)
        .unpivot(
            [F.col(key), F.col(skew.PART)],
            [F.col(d).cast("string").alias(d) for d in dims],
            "dim",
            "label",
        )
        .groupBy(*at, "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_label = W.partitionBy(key, "dim", "label").orderBy(skew.PART)
    total = counts.withColumn("total", F.sum("n").over(by_label))
    before = total.select(*at, "label", (F.col("total") - F.col("n")).alias("n"))
    # Leader at the end of each range, moved to the next range of the key.
    ends = total.groupBy(*at).agg(F.min(_rank(-F.col("total"), F.col("label"))).alias("b"))
    earlier = (
        W.partitionBy(key, "dim").orderBy(skew.PART).rowsBetween(W.unboundedPreceding, -1)
    )
    leader = ends.withColumn("b", F.min("b").over(earlier)).filter(F.col("b").isNotNull())
    leader = leader.select(*at, F.col("b.label").alias("label"), (-F.col("b.neg")).alias("n"))
    # The leader may also be a label of the range: keep one row with its full count.
    carry = (
        before.unionByName(leader).groupBy(*at, "label").agg(F.max("n").alias("n")).filter("n > 0")
    )
    return carry.select(
        key,
        skew.PART,
        *[F.when(F.col("dim") == d, F.col("label")).alias(d) for d in dims],
        *[F.when(F.col("dim") == d, F.col("n")).otherwise(0).alias(f"__w_{d}") for d in dims],
    )
