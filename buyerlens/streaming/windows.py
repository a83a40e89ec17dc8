"""User activity by windows on streams.

Event time: what a window holds are counts, flags and least values, so rows may come in any order. A first
step keeps them for each (user, salt) and open window and hands a window on when the watermark passes its end;
a second step per user adds the parts of all salts to the sums so far and gives one row for each window. The
result does not depend on where micro-batches end: a row that is late for the watermark still counts in its
window while that is open. Salts spread a user with a third of all rows over tasks; the second step sees one
row for each user, window and salt. A row whose window has been given out counts in the user's next window.

Processing time: the last row of a key in each interval of the cluster's clock, given out by the clock alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from buyerlens.functions.calendar import event_time
from buyerlens.session import use_rocksdb
from buyerlens.streaming.event_time import WATERMARK

SIZE_MS = 120_000
SALTS = 8
PART = "n BIGINT, ts BIGINT, ios BOOLEAN, android BOOLEAN, os STRING, term STRING, many BOOLEAN"


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _joined(a: tuple, b: tuple) -> tuple:
    """Two parts as one: views, last time, device families, least device, search term, whether of several."""
    several = a[5] is not None and b[5] is not None and a[5] != b[5]
    return (
        a[0] + b[0], max(a[1], b[1]), a[2] or b[2], a[3] or b[3], _least(a[4], b[4]),
        a[5] if a[5] is not None else b[5], a[6] or b[6] or several,
    )


class WindowParts(StatefulProcessor):
    """Parts of open windows of a (user, salt), each handed on once, when the watermark passes its end."""

    def __init__(self, key: str, size_ms: int):
        self.key, self.size_ms = key, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start BIGINT", PART)

    def _row(self, key, start: int, part: tuple) -> Row:
        names = ["n", "ts", "ios", "android", "os", "term", "many"]
        return Row(**{self.key: key[0]}, start=start, **dict(zip(names, part, strict=True)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh: dict[int, tuple] = {}
        for r in rows:
            ts, os, term = r["ts"] or 0, r["os"], r["search_item"]
            start = ts - ts % self.size_ms
            part = (1, ts, os == "iOS", os == "Android", os, term, False)
            fresh[start] = _joined(fresh[start], part) if start in fresh else part
        passed = timerValues.getCurrentWatermarkInMs()
        out = []
        for start, part in fresh.items():
            if self.open.containsKey((start,)):
                self.open.updateValue((start,), _joined(tuple(self.open.getValue((start,))), part))
            elif start + self.size_ms <= passed:
                out.append(self._row(key, start, part))
            else:
                self.open.updateValue((start,), part)
                self.handle.registerTimer(start + self.size_ms - 1)  # a timer fires after its time
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start = expiredTimerInfo.getExpiryTimeInMs() + 1 - self.size_ms
        part = tuple(self.open.getValue((start,)))
        self.open.removeKey((start,))
        return iter([self._row(key, start, part)])

    def close(self) -> None:
        pass


class WindowTotals(StatefulProcessor):
    """Sums so far of a user, one row for each window; parts of windows given out before count from now on."""

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", PART + ", last BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts: dict[int, tuple] = {}
        for r in rows:
            part = (r["n"], r["ts"], r["ios"], r["android"], r["os"], r["term"], r["many"])
            parts[r["start"]] = _joined(parts[r["start"]], part) if r["start"] in parts else part
        state = self.sums.get()
        sums, last = (None, None) if state is None else (tuple(state)[:7], state[7])
        out = []
        for start in sorted(parts):
            sums = parts[start] if sums is None else _joined(sums, parts[start])
            if last is None or start > last:
                last = start
                judge = "iOS" if sums[2] else "Android" if sums[3] else sums[4]
                term = None if sums[6] else sums[5]
                out.append(Row(**{self.key: key[0]}, ts=parts[start][1], pv=sums[0], judge_os=judge, search_item=term))
        self.sums.update((*sums, last))
        return iter(out)

    def close(self) -> None:
        pass


def activity_windows(
    views: DataFrame, key: str = "uid", size_ms: int = SIZE_MS, salts: int = SALTS, delay: str = WATERMARK
) -> DataFrame:
    """Streaming form of :func:`buyerlens.operators.activity.activity_snapshots`.

    A window is given out ``delay`` after its end, once; the last one waits for the watermark.
    """
    use_rocksdb(views.sparkSession)
    marked = views.withColumn("__time", event_time("ts")).withWatermark("__time", delay)
    # Without the watermarked column no row is dropped as late: windows decide, not rows.
    salted = marked.select(
        key, F.pmod(F.xxhash64("ts", "os", "search_item"), F.lit(salts)).alias("salt"), "ts", "os", "search_item"
    )
    schema = StructType.fromDDL(f"{key} STRING, start BIGINT, {PART}")
    parts = salted.groupBy(key, "salt").transformWithState(WindowParts(key, size_ms), schema, "append", "EventTime")
    schema = StructType.fromDDL(f"{key} STRING, ts BIGINT, pv BIGINT, judge_os STRING, search_item STRING")
    return parts.groupBy(key).transformWithState(WindowTotals(key), schema, "append", "None")


class LastOfInterval(StatefulProcessor):
    """The greatest row of a key by ``order`` since the last tick of the clock."""

    def __init__(self, schema: StructType, order: list[str], size_ms: int):
        self.schema, self.order, self.size_ms = schema, order, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.schema)

    def _place(self, row) -> tuple:
        return tuple((row[c] is not None, row[c]) for c in self.order)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        make = Row(*self.schema.names)
        held = self.last.get()
        best = None if held is None else make(*held)
        for r in rows:
            if best is None or self._place(r) >= self._place(best):
                best = r
        self.last.update(tuple(best[c] for c in self.schema.names))
        if held is None:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(now - now % self.size_ms + self.size_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        row = Row(*self.schema.names)(*self.last.get())
        self.last.clear()
        return iter([row])

    def close(self) -> None:
        pass


def last_of_interval(df: DataFrame, keys: list[str], order: list[str], size_ms: int = SIZE_MS) -> DataFrame:
    """Last row per key (by ``order``, a state counter for instance) in each interval of processing time.

    Rows leave at the clock's multiples of ``size_ms``, whatever their event times; no watermark is waited for.
    Runs in streams with a recurring trigger; one that stops when the input is used up gives out what is due then.
    """
    use_rocksdb(df.sparkSession)
    return df.groupBy(*keys).transformWithState(LastOfInterval(df.schema, order, size_ms), df.schema, "append", "ProcessingTime")
