"""A user's keyed process function with state and event-time timers.

A :class:`KeyedProcess` names its states (value, list, map), handles one row after the other and sets
timers. Rows of a key are handled in event time (ties by ``seq``), rows before a timer of the same
time, whatever micro-batch they came in: a row waits in state until the watermark has passed it,
so a rerun with other micro-batches gives the same output. Runs on Spark's ``transformWithState``
with its RocksDB store: states live on disk and in the checkpoint, a key's states are read only
when the key has rows or a timer is due.

State: what the process keeps (its own bound), the rows newer than the watermark and the pending
timers. Rows later than the watermark are dropped by Spark.
"""

from __future__ import annotations

import contextlib
import heapq
import json
from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.time import epoch_us
from tidemark.session import findable

#: Spark's setting of the state store and its provider with more than one state a key.
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which ``transformWithState`` needs."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


class KeyedProcess(ABC):
    """``out``: schema of an output row without the key. ``states``: name -> ("value", schema), ("list", schema)
    or ("map", key schema, value schema)."""

    out: str
    states: dict[str, tuple] = {}

    @abstractmethod
    def on_row(self, row: dict, at: int, state: State) -> Iterable[tuple]:
        """Output for a row (its payload columns) at event time ``at`` in microseconds."""

    def on_timer(self, at: int, state: State) -> Iterable[tuple]:
        """Output when the watermark has passed a timer."""
        return ()


class State:
    """What a process sees of its key: ``key``, ``watermark`` (microseconds), its states and timers."""

    def __init__(self, handles: dict, kinds: dict[str, tuple], key, watermark: int, timers: set[int]):
        self._handles, self._kinds, self.key, self.watermark, self.timers = handles, kinds, key, watermark, timers
        self._order = sorted(timers)  # a heap; cancelled ones stay in it until they are met
        self._values: dict[str, tuple | None] = {}
        self._changed: set[str] = set()

    def get(self, name: str) -> tuple | None:
        """A value state, or None."""
        if name not in self._values:
            h = self._handles[name]
            self._values[name] = tuple(h.get()) if h.exists() else None
        return self._values[name]

    def set(self, name: str, value: tuple | None) -> None:
        self._values[name] = value
        self._changed.add(name)

    def items(self, name: str) -> list[tuple]:
        """A list state's values, or a map state's (key, value) pairs."""
        h = self._handles[name]
        if not h.exists():
            return []
        return list(h.get()) if self._kinds[name][0] == "list" else [(k, v) for k, v in h.iterator()]

    def append(self, name: str, value: tuple) -> None:
        self._handles[name].appendValue(value)

    def put(self, name: str, key: tuple, value: tuple | None) -> None:
        h = self._handles[name]
        h.removeKey(key) if value is None else h.updateValue(key, value)

    def at(self, name: str, key: tuple) -> tuple | None:
        h = self._handles[name]
        return tuple(h.getValue(key)) if h.containsKey(key) else None

    def clear(self, name: str) -> None:
        self._values.pop(name, None)
        self._changed.discard(name)
        self._handles[name].clear()

    def timer(self, at: int) -> None:
        """Calls ``on_timer`` once the watermark has passed ``at``; the same time is one timer."""
        if at not in self.timers:
            self.timers.add(at)
            heapq.heappush(self._order, at)

    def due(self) -> int | None:
        """The first timer."""
        while self._order and self._order[0] not in self.timers:
            heapq.heappop(self._order)
        return self._order[0] if self._order else None

    def cancel(self, at: int) -> None:
        self.timers.discard(at)

    def _flush(self) -> None:
        for name in self._changed:
            v = self._values[name]
            self._handles[name].clear() if v is None else self._handles[name].update(v)


#: Rows or timers in one entry of a list state, at most.
ENTRY = 1000


def _entries(rows: list[tuple]) -> list[tuple]:
    return [tuple(map(list, zip(*rows[i : i + ENTRY]))) for i in range(0, len(rows), ENTRY)]


class _Processor(StatefulProcessor):
    def __init__(self, process: KeyedProcess, names: Sequence[str]):
        self.process, self.names = process, names

    def init(self, handle) -> None:
        self.handle = handle
        make = {"value": handle.getValueState, "list": handle.getListState, "map": handle.getMapState}
        self.states = {n: make[kind](n, *schemas) for n, (kind, *schemas) in self.process.states.items()}
        # lists of arrays: a key's rows of one micro-batch are one entry
        self.waiting = handle.getListState("_waiting", "us array<bigint>, seq array<bigint>, x array<string>")
        self.timers = handle.getListState("_timers", "us array<bigint>")
        self.next = handle.getValueState("_next", "us bigint, ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [r for p in rows for r in zip(p["us"].tolist(), p["seq"].tolist(), p["x"].tolist())]
        now = timerValues.getCurrentWatermarkInMs() * 1000
        before = self.next.get()
        first = min(r[0] for r in new)
        if first <= now or (before and before[0] <= now):
            yield from self._run(key, now, new, before)
        else:  # nothing is due: the new rows join those that wait, which are not read
            self.waiting.appendList(_entries(new))
            if before is None or first < before[0]:
                self._wake(first, now, before)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._run(key, timerValues.getCurrentWatermarkInMs() * 1000, [], self.next.get())

    def _wake(self, at: int | None, now: int, before: tuple | None) -> None:
        """The key's one timer, at its first waiting row or timer."""
        if before is not None:
            self.handle.deleteTimer(before[1])
        if at is None:
            self.next.clear()
        else:
            ms = max(-(-at // 1000), now // 1000 + 1)
            self.next.update((at, ms))
            self.handle.registerTimer(ms)

    def _run(self, key, now: int, new: list[tuple], before: tuple | None) -> Iterator[pd.DataFrame]:
        held = [r for e in self.waiting.get() for r in zip(*e)] if before else []
        timers = {us for e in self.timers.get() for us in e[0]} if before else set()
        rows = sorted([*held, *new])
        state = State(self.states, self.process.states, key[0], now, timers)
        had = len(timers)
        out: list[tuple] = []
        n = 0
        while True:
            due = state.due()
            if n < len(rows) and rows[n][0] <= now and (due is None or rows[n][0] <= due):
                us, _, x = rows[n]
                n += 1
                out += self.process.on_row(json.loads(x), us, state)
            elif due is not None and due <= now:
                state.timers.discard(due)
                out += self.process.on_timer(due, state)
            else:
                break
        state._flush()
        rest = rows[n:]
        if rest:
            self.waiting.put(_entries(rest))
        elif held:
            self.waiting.clear()
        if state.timers:
            left = sorted(state.timers)
            self.timers.put([(left[i : i + ENTRY],) for i in range(0, len(left), ENTRY)])
        elif had:
            self.timers.clear()
        self._wake(min([*(r[0] for r in rest[:1]), *state.timers], default=None), now, before)
        if out:
            yield pd.DataFrame([(key[0], *o) for o in out], columns=["k", *self.names]).astype({"k": object})

    def close(self) -> None:
        pass


def process(df: DataFrame, key: str, function: KeyedProcess, payload: Sequence[str], et: str = "et", seq: str = "seq") -> DataFrame:
    """``key`` and the columns of ``function.out``, appended. ``df``: a stream with a watermark on ``et`` and an
    integer tie-break ``seq``; ``payload``: the columns that a row's handler sees. Start the query
    inside :func:`store`."""
    findable(df.sparkSession)
    d = df.select(F.col(key).alias("k"), epoch_us(et).alias("us"), F.col(seq).cast("bigint").alias("seq"), F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}).alias("x"), F.col(et))
    names = [c.strip().split()[0] for c in function.out.split(",")]
    r = d.groupBy("k").transformWithStateInPandas(_Processor(function, names), f"k {df.schema[key].dataType.simpleString()}, {function.out}", "append", "eventTime")
    return r.withColumnRenamed("k", key)


class EventTimer(KeyedProcess):
    """Each row is an ``arrival``, and a ``timer`` fires ``delay`` microseconds after it."""

    out = "kind string, us bigint"

    def __init__(self, delay: int):
        self.delay = delay

    def on_row(self, row, at, state):
        state.timer(at + self.delay)
        yield "arrival", at

    def on_timer(self, at, state):
        yield "timer", at


class PeriodicCount(KeyedProcess):
    """From a key's first row a timer every ``period`` microseconds tells how many rows it had so far."""

    out = "us bigint, pv bigint"
    states = {"n": ("value", "n bigint")}

    def __init__(self, period: int):
        self.period = period

    def on_row(self, row, at, state):
        have = state.get("n")
        if have is None:
            state.timer(at + self.period)
        state.set("n", (1 if have is None else have[0] + 1,))
        return ()

    def on_timer(self, at, state):
        state.timer(at + self.period)
        yield at, state.get("n")[0]


class ListAndMap(KeyedProcess):
    """At every row the last ``most`` payload values (a list of bounded length) and how often the
    value was seen before (a map, one entry for each different value of the key)."""

    out = "seen string, before bigint"
    states = {"last": ("list", "v string"), "count": ("map", "v string", "n bigint")}

    def __init__(self, column: str, most: int):
        self.column, self.most = column, most

    def on_row(self, row, at, state):
        v = str(row[self.column])
        have = state.at("count", (v,))
        state.put("count", (v,), (1 if have is None else have[0] + 1,))
        last = [x[0] for x in state.items("last")][-(self.most - 1) :] + [v]
        state.clear("last")
        for x in last:
            state.append("last", (x,))
        yield ",".join(last), 0 if have is None else have[0]
