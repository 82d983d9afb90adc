"""Sketches in keyed state: windowed counts by an exponential histogram, membership by rotating Bloom filters."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.operators import sketches
from tidewatch.streaming.state import with_state


class Histogram:
    """Counts of a trailing window in buckets of doubling size, newest last.

    A bucket is (time of its newest event, size). At most `per_size` buckets have one size; one more, and the two
    oldest of it become one of twice the size. Only the oldest bucket may lie partly outside the window, and half of
    it is at most `error` of the buckets after it.
    """

    def __init__(self, seconds: int, error: float, buckets: Sequence[tuple[int, int]] = ()):
        self.seconds, self.per_size = seconds, math.ceil(1 / error) + 1
        self.buckets = [tuple(b) for b in buckets]

    def add(self, time: int) -> int:
        """Take an event and return the estimate; an event older than the newest counts at that one's time."""
        buckets = self.buckets
        time = max(time, buckets[-1][0]) if buckets else time
        buckets.append((time, 1))
        size, end = 1, len(buckets)
        while True:
            start = end
            while start and buckets[start - 1][1] == size:
                start -= 1
            if end - start <= self.per_size:
                break
            buckets[start : start + 2] = [(buckets[start + 1][0], 2 * size)]
            size, end = 2 * size, start + 1
        gone = 0
        while buckets[gone][0] < time - self.seconds:
            gone += 1
        del buckets[:gone]
        return sum(n for _, n in buckets) - buckets[0][1] // 2


class TrailingCount(StatefulProcessor):
    OUTPUT = "arrival long, second long, estimate long"

    def __init__(self, seconds: int, error: float):
        self.seconds, self.error = seconds, error

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("buckets", "times array<long>, sizes array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept = self.state.get() if self.state.exists() else ([], [])
        counts = Histogram(self.seconds, self.error, list(zip(*kept, strict=True)))
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["second", "arrival"])
        # Each event's estimate follows from the one before: the histogram is the state itself.
        estimates = [counts.add(t) for t in batch["second"].tolist()]
        self.state.update(([t for t, _ in counts.buckets], [n for _, n in counts.buckets]))
        yield batch[["arrival", "second"]].assign(estimate=estimates)

    def close(self) -> None:
        pass


def stream_trailing_count(
    events: DataFrame, key: str, time: str = "event_time", arrival: str = "arrival", seconds: int = 3600, error: float = 0.1
) -> DataFrame:
    """arrival, second and the estimated number of the key's events in the trailing window, both ends included.

    The estimate is within `error` of the true count of what came so far, as a share of it, if a key's events come
    in time order over micro-batches; a late one counts at the newest time. State per key is
    about (1 / error) * log2(events in the window) pairs. Events without a time are left out; a null key
    is a key of its own.
    """
    with_state(events.sparkSession, __name__)
    rows = events.select(
        F.col(key).alias("_key"), F.col(arrival).cast("long").alias("arrival"), F.unix_timestamp(F.col(time).cast("timestamp")).alias("second")
    )
    return rows.filter("second is not null").groupBy("_key").transformWithStateInPandas(
        statefulProcessor=TrailingCount(seconds, error), outputStructType=TrailingCount.OUTPUT, outputMode="append", timeMode="none"
    )


class Slice:
    """One Bloom filter of a fixed capacity."""

    def __init__(self, capacity: int, error: float, bits: bytes | None = None, n: int = 0):
        per_key, self.hashes = sketches.bloom_shape(error)
        self.capacity, self.n = capacity, n
        self.bits = np.frombuffer(bits, np.uint8).copy() if bits else np.zeros(-(-capacity * per_key // 8), np.uint8)

    def _places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Bit numbers of every key, one row per hash."""
        i = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return (h1[None, :] + i * (h2 | np.uint64(1))[None, :]) % np.uint64(len(self.bits) * 8)

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        places = self._places(h1, h2)
        return ((self.bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        places = self._places(h1, h2).ravel()
        np.bitwise_or.at(self.bits, places >> np.uint64(3), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
        self.n += len(h1)


class RotatingBloom(StatefulProcessor):
    """Filters of one shard: for each span of event time slices of doubling capacity and halving error."""

    OUTPUT = "arrival long, maybe_seen boolean"

    def __init__(self, horizon: int, spans: int, capacity: int, error: float):
        self.horizon, self.spans, self.capacity = horizon, spans, capacity
        self.width = max(1, -(-horizon // spans))
        #: A key is looked up in all live spans, so each has its share of the wanted error.
        self.error = error / (spans + 1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.filters = handle.getMapState("filters", "span long, slice int", "bits binary, n long")

    def _slice(self, number: int, stored=None) -> Slice:
        bits, n = stored if stored else (None, 0)
        return Slice(self.capacity << number, self.error / 2 ** (number + 1), bits, n)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["second", "arrival"], ignore_index=True)
        live = {(s, i): self._slice(i, tuple(v)) for (s, i), v in self.filters.iterator()} if self.filters.exists() else {}
        h1, h2 = (batch[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        span = batch["second"].to_numpy(np.int64) // self.width
        repeated = batch.duplicated(["h1", "h2"]).to_numpy()
        seen, own = repeated.copy(), np.zeros(len(batch), bool)
        for (s, _), one in live.items():
            held = one.holds(h1, h2)
            seen |= held & (s >= span - self.spans)
            own |= held & (span == s)
        # A key goes into its own span unless that holds it: another span's filter would go sooner.
        own |= batch.assign(span=span).duplicated(["h1", "h2", "span"]).to_numpy()
        for s in np.unique(span).tolist():
            new = np.flatnonzero((span == s) & ~own)
            while len(new):
                number = max((i for t, i in live if t == s), default=0)
                one = live.setdefault((s, number), self._slice(number))
                if one.n >= one.capacity:
                    one = live.setdefault((s, number + 1), self._slice(number + 1))
                some, new = np.split(new, [one.capacity - one.n])
                one.add(h1[some], h2[some])
        newest = max((s for s, _ in live), default=0)
        for place, one in live.items():
            if place[0] < newest - self.spans:
                self.filters.removeKey(place)
            else:
                self.filters.updateValue(place, (one.bits.tobytes(), one.n))
        yield batch[["arrival"]].assign(maybe_seen=seen)

    def close(self) -> None:
        pass


def stream_membership(
    events: DataFrame, key: Sequence[str] = sketches.EVENT_KEY, time: str = "event_time", arrival: str = "arrival",
    horizon_seconds: int = 6 * 3600, error: float = 0.01, capacity: int = 4096, shards: int = 16, spans: int = 4,
) -> DataFrame:
    """arrival and maybe_seen of every event: false is certain for keys of the last `horizon_seconds` of event time.

    Keys are dealt to shards by hash, so a hot patient spreads; a shard keeps filters for the spans of the horizon and the
    present one, each grown by slices of doubling size beyond `capacity` keys. A filter goes when its whole span is
    older than the horizon. Repeats within a micro-batch are found exactly. Wrong answers stay within `error`. Events without a time are left out; null parts of a
    key are values like any other.
    """
    with_state(events.sparkSession, __name__)
    text = sketches.event_key(key)
    rows = events.select(
        F.pmod(F.xxhash64(text), F.lit(shards)).cast("int").alias("shard"), F.col(arrival).cast("long").alias("arrival"),
        F.unix_timestamp(F.col(time).cast("timestamp")).alias("second"), F.xxhash64(text, F.lit(1)).alias("h1"),
        F.xxhash64(text, F.lit(2)).alias("h2"),
    )
    return rows.filter("second is not null").groupBy("shard").transformWithStateInPandas(
        statefulProcessor=RotatingBloom(horizon_seconds, spans, capacity, error), outputStructType=RotatingBloom.OUTPUT,
        outputMode="append", timeMode="none",
    )
