"""Stateful processors for per-key logic no built-in streaming operator expresses.

State is a few scalars per key, or one counter per (key, label). Rows of a micro-batch are handled in
order of ``order`` columns; times are kept as BIGINT.

With ``release`` a processor keeps the rows that come and handles them when the watermark has passed their
time, in order of time, so its output does not depend on where micro-batches end. Rows that are late for the
watermark are dropped, as Spark does with every event-time operator; the last rows wait for the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from buyerlens.session import use_rocksdb


def _sort_key(row: Row, order: list[str]) -> tuple:
    return tuple((row[c] is not None, row[c]) for c in order)


class _Ordered(StatefulProcessor):
    """Subclasses give ``begin`` (their state) and ``step`` (what ordered rows of a key become)."""

    #: Column of the event time in millis and the schema of the rows, if rows wait for the watermark.
    release: tuple[str, StructType] | None = None

    def __init__(self, order: list[str], ttl_ms: int | None = None):
        self.order = order
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.release:
            self.waiting = handle.getListState("waiting", self.release[1])
            self.due = handle.getValueState("due", "at BIGINT")
        self.begin(handle)

    def in_order(self, rows: Iterator[Row]) -> list[Row]:
        return sorted(rows, key=lambda r: _sort_key(r, self.order))

    def _time(self, row: Row) -> int:
        return row[self.release[0]] or 0

    def _wake(self, at: int) -> None:
        """Have a timer for the earliest waiting row; a timer fires after its time."""
        due = self.due.get()
        if due is None or at < due[0]:
            if due is not None:
                self.handle.deleteTimer(max(due[0] - 1, 0))
            self.handle.registerTimer(max(at - 1, 0))
            self.due.update((at,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.release:
            return iter(self.step(key, self.in_order(rows)))
        rows = list(rows)
        self.waiting.appendList([tuple(r) for r in rows])
        self._wake(min(map(self._time, rows)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        make = Row(*self.release[1].names)
        ready, rest = [], []
        for values in self.waiting.get():
            row = make(*values)
            (ready if self._time(row) <= passed else rest).append(row)
        self.due.clear()
        if rest:
            self.waiting.put([tuple(r) for r in rest])
            self._wake(min(map(self._time, rest)))
        else:
            self.waiting.clear()
        return iter(self.step(key, self.in_order(ready)))

    def close(self) -> None:
        pass


class NewerOnly(_Ordered):
    """First row of a key, then each row newer than all before."""

    def __init__(self, ts: str, order: list[str], ttl_ms: int | None = None):
        super().__init__(order, ttl_ms)
        self.ts = ts

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "ts BIGINT", self.ttl_ms)

    def step(self, key, rows: list[Row]) -> list[Row]:
        state = self.newest.get()
        newest = None if state is None else state[0]
        start = newest
        out = []
        for row in rows:
            ts = row[self.ts]
            if newest is None or (ts is not None and ts > newest):
                newest = ts
                out.append(row)
        if newest is not None and newest != start:
            self.newest.update((newest,))
        return out


class LabelLeaders(_Ordered):
    """Running most frequent label per dimension; one row when any of them changes."""

    def __init__(
        self, key: str, dims: list[str], order: list[str], keep: list[str], ttl_ms: int | None = None
    ):
        super().__init__(order, ttl_ms)
        self.key, self.dims, self.keep = key, dims, keep

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "dim INT, label STRING", "n BIGINT", self.ttl_ms)
        fields = ", ".join(f"l{i} STRING, n{i} BIGINT" for i in range(len(self.dims)))
        self.leaders = handle.getValueState("leaders", fields, self.ttl_ms)

    def step(self, key, rows: list[Row]) -> list[Row]:
        state = self.leaders.get()
        lead = [] if state is None else [(state[2 * i], state[2 * i + 1]) for i in range(len(self.dims))]
        fresh: dict = {}
        out = []
        for row in rows:
            before = [label for label, _ in lead]
            now = []
            for i, dim in enumerate(self.dims):
                at = (i, row[dim])
                if at not in fresh:
                    fresh[at] = self.counts.getValue(at)[0] if self.counts.containsKey(at) else 0
                fresh[at] += 1
                now.append(_leader(lead[i] if lead else None, (row[dim], fresh[at])))
            lead = now
            after = [label for label, _ in lead]
            if before != after:
                kept = {c: row[c] for c in self.keep}
                out.append(Row(**{self.key: key[0]}, **kept, **dict(zip(self.dims, after))))
        for at, n in fresh.items():
            self.counts.updateValue(at, (n,))
        if lead:
            self.leaders.update(tuple(v for pair in lead for v in pair))
        return out


def _leader(best, reached):
    """Higher count wins, then the smaller label (null first)."""
    if best is None or reached[1] > best[1]:
        return reached
    if reached[1] == best[1] and _label_order(reached[0]) < _label_order(best[0]):
        return reached
    return best


def _label_order(label):
    return b"" if label is None else b"\x01" + label.encode("utf-8")


class RunningActivity(_Ordered):
    """Views, device families and the single search term of a user so far, one row per view."""

    def __init__(self, key: str, time_col: str, order: list[str], ttl_ms: int | None = None):
        super().__init__(order, ttl_ms)
        self.key, self.time_col = key, time_col

    def begin(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState(
            "sums",
            "pv BIGINT, ios BOOLEAN, android BOOLEAN, os STRING, term STRING, many BOOLEAN",
            self.ttl_ms,
        )

    def step(self, key, rows: list[Row]) -> list[Row]:
        pv, ios, android, os, term, many = self.sums.get() or (0, False, False, None, None, False)
        out = []
        for row in rows:
            pv += 1
            ios, android = ios or row["os"] == "iOS", android or row["os"] == "Android"
            if row["os"] is not None and (os is None or row["os"] < os):
                os = row["os"]
            found = row["search_item"]
            if found is not None:
                many = many or (term is not None and term != found)
                term = found if term is None else term
            judge = "iOS" if ios else "Android" if android else os
            out.append(
                Row(
                    **{self.key: key[0], self.time_col: row[self.time_col]},
                    ts=row["ts"],
                    pv=pv,
                    judge_os=judge,
                    search_item=None if many else term,
                )
            )
        self.sums.update((pv, ios, android, os, term, many))
        return out


def _run(df: DataFrame, keys: list[str], processor, schema, time_col: str | None) -> DataFrame:
    use_rocksdb(df.sparkSession)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    grouped = df.groupBy(*keys)
    if time_col is None:
        mode = "None" if processor.ttl_ms is None else "ProcessingTime"
        return grouped.transformWithState(processor, schema, "append", mode)
    return grouped.transformWithState(
        processor, schema, "append", "EventTime", eventTimeColumnName=time_col
    )


def keep_if_newer_stream(
    df: DataFrame,
    keys: list[str],
    ts: str,
    order: list[str],
    time_col: str | None = None,
    ttl_ms: int | None = None,
    release: bool = False,
) -> DataFrame:
    """Streaming form of :func:`buyerlens.operators.dedup.keep_if_newer`.

    With ``release`` rows wait until the watermark of ``time_col`` has passed ``ts``; without, rows of a
    micro-batch are handled at once, which gives one result if micro-batches follow ``order`` (arrival).
    """
    processor = NewerOnly(ts, order, ttl_ms)
    processor.release = (ts, df.schema) if release else None
    return _run(df, keys, processor, df.schema, time_col)


def label_changes_stream(
    df: DataFrame,
    key: str,
    dims: list[str],
    order: list[str],
    out_cols: list[str],
    time_col: str | None = None,
    ttl_ms: int | None = None,
    release: str | None = None,
) -> DataFrame:
    """Streaming form of :func:`buyerlens.operators.labels.label_changes`.

    ``release`` names the event time in millis at which rows wait for the watermark of ``time_col``.
    """
    kept = [df.schema[c] for c in [key, *out_cols, *dims]]
    processor = LabelLeaders(key, dims, order, out_cols, ttl_ms)
    processor.release = (release, df.schema) if release else None
    return _run(df, [key], processor, StructType(kept), time_col)


def running_activity_stream(
    df: DataFrame, key: str, time_col: str, order: list[str], ttl_ms: int | None = None
) -> DataFrame:
    """Running form of the activity aggregate: every row counts, no watermark drops one before it does."""
    schema = f"{key} STRING, {time_col} TIMESTAMP, ts BIGINT, pv BIGINT, judge_os STRING, search_item STRING"
    return _run(df, [key], RunningActivity(key, time_col, order, ttl_ms), schema, None)
