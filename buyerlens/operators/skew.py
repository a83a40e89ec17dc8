"""Cutting heavy keys into independent ranges for ordered, per-key logic.

Running values (newest so far, counts so far, previous label) need a key's rows in order, which
would put a key holding a third of all rows into one task. Instead heavy keys are cut into ranges
of the order. A small aggregate per (key, range) gives the state at the start of each range; it is
added as *carry rows* that sort before the range's own rows, so every range is a separate group and
the data is still shuffled once.

A heavy key is cut at quantiles of its first order column, nulls first. A value that is a quantile is
a range of its own, so a burst of rows with one time does not widen its neighbours; if the burst alone
is heavy, it is cut again at quantiles of the second order column. Texts are cut by the seven bytes after
what all texts of the key begin with.

Finding the heavy keys is one count per key, run when the operator is built; nothing else is read if
there are none, which is usual, and the plan stays a plain window. Heavy keys and their cuts are tables in
the shared folder, however many there are. ``heavy_rows=None`` skips the search.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from buyerlens.session import settle

PART = "__part"
CARRY = "__carry"

# A key is cut if it has more rows than this.
HEAVY_ROWS = 2_000_000
# Up to so many heavy keys are sent to all tasks; more are joined, the largest of them split by adaptive execution.
SENT_KEYS = 65_536
CUTS = 64
# Sorted by one task, on average, where rows are handled in order.
TASK_ROWS = 200_000
_NUMBERS = ("bigint", "int", "smallint", "tinyint", "double", "float")


def _number(name: str, kind: str) -> Column | None:
    """A number in the order of the column's values (after ``__skip`` bytes of texts); None for other types."""
    value = F.col(name)
    if kind in _NUMBERS:
        return value
    if kind in ("string", "binary"):
        head = F.substring(value.cast("binary"), F.col("__skip") + 1, F.lit(7))
        return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("bigint")
    if kind.startswith("decimal"):
        return value.cast("double")
    if kind == "boolean":
        return value.cast("int")
    if kind == "date":
        return F.unix_date(value)
    return F.unix_micros(value) if kind == "timestamp" else None


def _shared_bytes(low: Column, high: Column) -> Column:
    """How many bytes the least and the greatest text, and so all between them, begin with alike."""
    low, high = low.cast("binary"), high.cast("binary")
    most = F.least(F.octet_length(low), F.octet_length(high))
    places = F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>"))
    alike = F.filter(places, lambda i: F.substring(low, F.lit(1), i) == F.substring(high, F.lit(1), i))
    return F.coalesce(F.size(alike), F.lit(0))


def _sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def total_rows(df: DataFrame, keys: list[str], heavy_rows: int) -> tuple[int, int]:
    """Number of rows and of keys with more than ``heavy_rows`` of them, from one count per key."""
    heavy = F.count_if(F.col("__n") > heavy_rows)
    rows, found = _sizes(df, keys).agg(F.coalesce(F.sum("__n"), F.lit(0)), heavy).head()
    return rows, found


def spread(df: DataFrame, rows: int | None, *cols: str) -> DataFrame:
    """``df`` by ``cols``, in so many partitions that their number follows the rows, not the settings alone."""
    tasks = (rows or 0) // TASK_ROWS + 1
    # Up to the number of cores Spark's own choice has a partition for each.
    return df.repartition(tasks, *cols) if tasks > df.sparkSession.sparkContext.defaultParallelism else df.repartition(*cols)


def heavy_cuts(df: DataFrame, keys: list[str], by: str, heavy_rows: int) -> DataFrame | None:
    """Heavy keys (as __k0, __k1 ..) with the cut numbers of ``by``; None without any."""
    names = [f"__k{i}" for i in range(len(keys))]
    counts = _sizes(df, keys).filter(F.col("__n") > heavy_rows)
    heavy = settle(counts.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.lit(0).alias("__skip")))
    found = heavy.count()
    if not found:
        return None
    sent = (lambda frame: F.broadcast(frame)) if found <= SENT_KEYS else (lambda frame: frame)
    kind = dict(df.dtypes)[by]
    wanted = df.select(*keys, by)
    if kind in ("string", "binary"):
        rows = wanted.join(sent(heavy), _same(wanted, keys, heavy))
        heavy = settle(rows.groupBy(*names).agg(_shared_bytes(F.min(by), F.max(by)).alias("__skip")))
    rows = wanted.join(sent(heavy), _same(wanted, keys, heavy)).select(*names, "__skip", _number(by, kind).alias("__by"))
    shares = [i / CUTS for i in range(1, CUTS)]
    cuts = F.array_sort(F.array_distinct(F.percentile_approx("__by", shares, 10_000)))
    cuts = F.coalesce(cuts, F.array().cast(f"array<{dict(rows.dtypes)['__by']}>"))
    cuts = settle(rows.groupBy(*names, "__skip").agg(cuts.alias("__cuts")))
    return sent(cuts)


def _same(df: DataFrame, keys: list[str], other: DataFrame) -> list[Column]:
    return [df[k].eqNullSafe(other[f"__k{i}"]) for i, k in enumerate(keys)]


def _place(value: Column) -> Column:
    """Range of a value: even between cuts, odd for the cuts themselves; nulls first."""
    below = F.size(F.filter("__cuts", lambda c: c < value))
    place = F.when(value.isNull(), 1).otherwise(2 * below + F.array_contains("__cuts", value).cast("int") + 2)
    return F.when(F.col("__cuts").isNotNull(), place).otherwise(0).cast("bigint")


def split_heavy_keys(
    df: DataFrame, keys: list[str], order: list[str], heavy_rows: int | None = HEAVY_ROWS
) -> tuple[DataFrame, bool]:
    """Add the range number: 0 for ordinary keys, 1.. in order for heavy ones.

    Also tells whether any key was cut. The first order column must be a number, text, time or flag; a second
    one of another type cuts nothing. Rows that agree in the first two order columns share a range, and so
    do texts that agree in the bytes looked at.
    """
    kinds = dict(df.dtypes)
    cuts = None if heavy_rows is None else heavy_cuts(df, keys, order[0], heavy_rows)
    if cuts is None:
        return df.withColumn(PART, F.lit(0).cast("bigint")), False
    joined = df.join(cuts, _same(df, keys, cuts), "left")
    place = _place(_number(order[0], kinds[order[0]]))
    parts = joined.select(*df.columns, (place * (1 << 32)).alias(PART))
    second = None if len(order) < 2 else _number(order[1], kinds[order[1]])
    # A range holds one value of a number where it is a cut itself; texts that are cut alike may differ further on.
    if second is not None and kinds[order[0]] in _NUMBERS:
        again = [*keys, PART]
        # Ranges of one value (odd places) may be cut by the next column.
        single = parts.filter(F.pmod(F.shiftright(PART, 32), F.lit(2)) == 1)
        bursts = heavy_cuts(single, again, order[1], heavy_rows)
        if bursts is not None:
            joined = parts.join(bursts, _same(parts, again, bursts), "left")
            parts = joined.select(*df.columns, (F.col(PART) + _place(second)).alias(PART))
    return parts, True


def with_carry(parts: DataFrame, carry: DataFrame | None) -> DataFrame:
    """Own rows and carry rows together, told apart by the flag column."""
    own = parts.withColumn(CARRY, F.lit(False))
    if carry is None:
        return own
    return own.unionByName(carry.withColumn(CARRY, F.lit(True)), allowMissingColumns=True)
