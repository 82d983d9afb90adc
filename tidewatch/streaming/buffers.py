"""Stateful operators that hold rows back: until the watermark passes them, or until a group is full or old.

Rows wait as JSON text in Arrow tables of a shard's keys, so rows of any columns can wait; what is released gets its columns
back. A call and its state requests cost more than a key's few rows, so keys share them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.streaming.state import from_bytes, to_bytes, with_state

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_JSON = {"timestampFormat": _MICROS + "XXX", "timestampNTZFormat": _MICROS}
#: Keys are dealt to so many shards; a shard's keys share calls, state values and a timer.
SHARDS = 1024
HELD = pa.schema([("key", pa.string()), ("at", pa.int64()), ("payload", pa.string())])
DUE = HELD.append(pa.field("due", pa.int64()))
NUMBERS = pa.schema([("key", pa.string()), ("n", pa.int64())])


def _packed(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {**_JSON, "ignoreNullFields": "false"})


def _unpacked(released: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    return released.select(F.from_json("payload", schema, _JSON).alias("_row"), *more).select("_row.*", *more)


def _table(frames: Iterator[pd.DataFrame], schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([pa.Table.from_pandas(f[schema.names], schema, preserve_index=False) for f in frames])


def _numbers(state) -> dict[str, int]:
    """What a state value holds per key."""
    stored = state.get()
    return dict(zip(*[c.to_pylist() for c in from_bytes(stored[0]).columns], strict=True)) if stored else {}


def _keep_numbers(state, numbers: dict[str, int]) -> None:
    state.update((to_bytes(pa.table([list(numbers), list(numbers.values())], schema=NUMBERS)),))


def _dealt(key: str, shards: int) -> list[Column]:
    """The shard of a row's key, and the key as text; a null key is one as well."""
    return [F.pmod(F.xxhash64(key), F.lit(shards)).alias("_shard"), _packed([key]).alias("key")]


class Reorder(StatefulProcessor):
    """Rows of a shard's keys, released in order of `at` (milliseconds) when the watermark has passed them.

    Held are one table per micro-batch, and one of what a release left; the timer stands at the earliest row.
    """

    OUTPUT = "position long, released_at long, payload string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "rows binary")
        self.counts = handle.getValueState("counts", "numbers binary")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _table(rows, HELD)
        self.held.appendValue((to_bytes(new),))
        first, timer = pc.min(new["at"]).as_py(), self.timer.get()
        if timer is None or first < timer[0]:
            if timer is not None:
                self.handle.deleteTimer(timer[0])
            self.handle.registerTimer(first)
            self.timer.update((first,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = pa.concat_tables([from_bytes(r[0]) for r in self.held.get()])
        ready = pc.less_equal(held["at"], passed)
        out, rest = held.filter(ready), held.filter(pc.invert(ready))
        if len(rest):
            first = pc.min(rest["at"]).as_py()
            self.held.put([(to_bytes(rest),)])
            self.handle.registerTimer(first)
            self.timer.update((first,))
        else:
            self.held.clear()
            self.timer.clear()
        if len(out):
            out = out.sort_by([(c, "ascending") for c in HELD.names])
            keys, sizes = np.unique(out["key"].to_numpy(), return_counts=True)
            counts, starts = _numbers(self.counts), np.cumsum(sizes) - sizes
            before = np.array([counts.get(k, 0) for k in keys])
            positions = np.arange(1, len(out) + 1) + np.repeat(before - starts, sizes)
            counts.update(zip(keys.tolist(), (before + sizes).tolist(), strict=True))
            _keep_numbers(self.counts, counts)
            yield pd.DataFrame({"position": positions, "released_at": passed, "payload": out["payload"].to_pandas()})

    def close(self) -> None:
        pass


def reorder(events: DataFrame, key: str, time: str, delay: str, shards: int = SHARDS) -> DataFrame:
    """The rows of a stream in order of time within each key, and over micro-batches.

    `time` is a zoned timestamp. A row is held until the watermark, the newest time less `delay`, has passed it;
    rows that come later than that are dropped, and rows of equal time come in the order of their text.
    Adds `position`, the row's number within its key, and `released_at`, the watermark that released it: a
    micro-batch holds nothing older than what an earlier one released. A null key is a key of its own. The last `delay`
    of a stream that ends stays held; a closing row that is later by more than that sets it free. Keys are dealt to
    `shards`, which a checkpoint keeps; a task holds one shard's waiting rows.
    """
    with_state(events.sparkSession, __name__)
    schema = events.schema
    # The time is cut to the millisecond that watermark and timers count in.
    held = events.withWatermark(time, delay).select(
        *_dealt(key, shards), time, F.unix_millis(time).alias("at"), _packed(events.columns).alias("payload")
    )
    released = held.filter("at is not null").groupBy("_shard").transformWithStateInPandas(
        statefulProcessor=Reorder(), outputStructType=Reorder.OUTPUT, outputMode="append", timeMode="eventTime"
    )
    return _unpacked(released, schema, "position", "released_at")


class CountOrTime(StatefulProcessor):
    """Groups of `most` rows of a key; fewer when the first of them has waited `after_ms`. The timer is that of a shard's first key."""

    OUTPUT = "group_no long, cause string, payload string"

    def __init__(self, most: int, after_ms: int):
        self.most, self.after_ms = most, after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary")
        self.groups = handle.getValueState("groups", "numbers binary")
        self.timer = handle.getValueState("timer", "at long")

    def _waiting(self) -> dict[str, tuple[int, list[tuple]]]:
        """When each key is due, and its rows."""
        stored, held = self.held.get(), {}
        for key, at, payload, due in zip(*[c.to_pylist() for c in from_bytes(stored[0]).columns], strict=True) if stored else ():
            held.setdefault(key, (due, []))[1].append((at, payload))
        return held

    def _keep(self, held: dict[str, tuple[int, list[tuple]]], expired: bool = False) -> None:
        rows = [(key, *row, due) for key, (due, own) in held.items() for row in own]
        first, timer = min((due for due, _ in held.values()), default=None), self.timer.get()
        if rows:
            self.held.update((to_bytes(pa.table([list(c) for c in zip(*rows, strict=True)], schema=DUE)),))
        else:
            self.held.clear()
        if timer is not None and timer[0] == first and not expired:
            return
        if timer is not None and not expired:
            self.handle.deleteTimer(timer[0])
        if first is None:
            self.timer.clear()
        else:
            self.handle.registerTimer(first)
            self.timer.update((first,))

    def _out(self, flushed: dict[str, list[tuple]], cause: str) -> pd.DataFrame:
        groups, numbers = _numbers(self.groups), []
        for key, rows in flushed.items():
            n = groups.get(key, 0)
            numbers += [n + 1 + i // self.most for i in range(len(rows))]
            groups[key] = numbers[-1]
        _keep_numbers(self.groups, groups)
        return pd.DataFrame({"group_no": numbers, "cause": cause, "payload": [p for rows in flushed.values() for _, p in rows]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due = timerValues.getCurrentProcessingTimeInMs() + self.after_ms
        new = _table(rows, HELD).sort_by([(c, "ascending") for c in HELD.names])
        held, flushed, arrived = self._waiting(), {}, {}
        for own, *row in zip(*[c.to_pylist() for c in new.columns], strict=True):
            arrived.setdefault(own, []).append(tuple(row))
        for own, added in arrived.items():
            since, waiting = held.pop(own, (due, []))
            waiting += added
            full = len(waiting) // self.most * self.most
            if full:
                flushed[own], since = waiting[:full], due
            if waiting[full:]:
                held[own] = since, waiting[full:]
        self._keep(held)
        if flushed:
            yield self._out(flushed, "count")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, held = timerValues.getCurrentProcessingTimeInMs(), self._waiting()
        flushed = {own: rows for own, (due, rows) in held.items() if due <= now}
        self._keep({own: kept for own, kept in held.items() if own not in flushed}, expired=True)
        if flushed:
            yield self._out(flushed, "time")

    def close(self) -> None:
        pass


def flush_groups(events: DataFrame, key: str, order: str, most: int = 10, after_ms: int = 3000, shards: int = SHARDS) -> DataFrame:
    """Rows in groups that are flushed at `most` rows of a key, or `after_ms` after the first of them came.

    Adds `group_no`, counted within the key, and `cause`, count or time. Within a micro-batch rows are taken in
    the order of the long column `order`, nulls first. A time flush comes with the first micro-batch after the time,
    with or without new rows, so run it with a processing-time trigger: one over the present input never ends. A null key is a key of its own.
    Keys are dealt to `shards`, which a checkpoint keeps; a task holds one shard's rows of a micro-batch.
    """
    with_state(events.sparkSession, __name__)
    held = events.select(
        *_dealt(key, shards), F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 62))).alias("at"), _packed(events.columns).alias("payload")
    )
    flushed = held.groupBy("_shard").transformWithStateInPandas(
        statefulProcessor=CountOrTime(most, after_ms), outputStructType=CountOrTime.OUTPUT, outputMode="append",
        timeMode="processingTime",
    )
    return _unpacked(flushed, events.schema, "group_no", "cause")
