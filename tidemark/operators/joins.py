"""Joins (J01-J06).

Only equi-joins plus a time range appear in the reference; Catalyst picks the strategy. Two
places need help at scale:

* the interval join (J03) on a hot key: the key alone gives one giant join partition with a
  range filter over all its pairs, so time is cut into slots of the interval's width and the
  join runs on ``(key, slot)``;
* small lookup sides (J06 rules) are broadcast only after a bounded row count.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.functions.durations import duration_us
from tidemark.functions.time import epoch_us, floordiv
from tidemark.operators import keyed
from tidemark.session import findable


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (a bounded count: at most ``max_rows + 1``
    rows are read)."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows; otherwise return it
    unchanged for a shuffle join."""
    return F.broadcast(df) if fits(df, max_rows) else df


def window_join(
    left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, size: str
) -> DataFrame:
    """Every pair of rows with the same key in the same tumbling window. Output:
    ``key, window_start, window_end`` then the other columns of both sides (names must differ)."""
    lw = left.withColumn("_w", F.window(lts, size))
    rw = right.withColumn("_w", F.window(rts, size))
    j = lw.join(rw, [key, "_w"])
    rest = [c for c in j.columns if c not in (key, "_w")]
    return j.select(key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *rest)


def cogroup(
    left: DataFrame, right: DataFrame, key: str, ts: str, size: str, order: Sequence[str], split: str | Column | None = None
) -> DataFrame:
    """Per key and tumbling window the rows of each side, one-sided groups included.

    The two lists are returned in long form (no collected arrays): one row per member with
    ``side`` ('left'/'right'), its ``pos`` in its list (by ``order``), and the group's list
    sizes ``n_left`` / ``n_right``. Both sides must have the columns ``key, *order``.
    Rows are shuffled once, by group, side and slice (``split``, default: 1/60 of the window); what
    stands before a slice and the list sizes come from a table with one row per slice, so a hot
    group is not one task."""
    cols = list(dict.fromkeys([key, ts, *order]))
    u = left.select(*cols, F.lit("left").alias("side")).unionByName(right.select(*cols, F.lit("right").alias("side")))
    u = u.withColumn("_w", F.window(ts, size))
    if split is None:
        split = floordiv(epoch_us(ts), max(duration_us(size) // 60, 1))
    u = keyed.positions(u, [key, "_w"], ["side"], order, split, "pos", {"n_left": F.col("side") == "left", "n_right": F.col("side") == "right"})
    rest = [c for c in cols if c != key]
    return u.select(
        key, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
        "side", "pos", *rest, "n_left", "n_right",
    )


def cogroup_apply(
    left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str], function: Callable[..., Iterator[pa.RecordBatch]], out: str
) -> DataFrame:
    """Hands each key's rows of both sides to a user's function, one-sided keys included.

    ``function(key, sizes, chunks)`` gets the key's values as a tuple, the numbers of left and right rows,
    and an iterator of (``"left"`` / ``"right"``, record batch of that side's columns): first the left rows in
    ``order``, then the right ones, in chunks of at most one Arrow batch. It yields record batches of
    the schema ``out``; chunks that it leaves unread are passed over. Nothing is collected: a group
    of any size streams through its task in sorted order, in the memory of one batch and of what
    the function keeps. Both sides are read once and shuffled once, by ``keys`` (columns of both);
    a null key is a key like any other."""
    findable(left.sparkSession)
    keys, order = list(keys), list(order)
    side = lambda d, own, name, other: d.select(
        *keys, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.lit(name).alias("_side"),
        *((F.struct(*d.columns).alias("_l"), F.lit(None).cast(other.schema).alias("_r")) if own else (F.lit(None).cast(other.schema).alias("_l"), F.struct(*d.columns).alias("_r"))),
    )
    u = side(left, True, 0, right).unionByName(side(right, False, 1, left)).repartition(*[F.col(k) for k in keys])
    w = Window.partitionBy(*keys)
    u = u.withColumn("_nl", F.count(F.when(F.col("_side") == 0, 1)).over(w)).withColumn("_nr", F.count(F.when(F.col("_side") == 1, 1)).over(w))
    u = u.sortWithinPartitions(*keys, "_side", *[f"_o{i}" for i in range(len(order))])
    result = StructType.fromDDL(out)
    types = to_arrow_schema(result)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(key, sizes, side, rows) of runs of equal key and side, none longer than a batch."""
        for b in batches:
            col = lambda n: b.column(b.schema.get_field_index(n))
            cut = np.zeros(b.num_rows, bool)
            cut[:1] = True
            for c in (*keys, "_side"):
                code = col(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                cut[1:] |= code[1:] != code[:-1]
            at = np.flatnonzero(cut).tolist()
            for s, e in zip(at, [*at[1:], b.num_rows]):
                name = "left" if col("_side")[s].as_py() == 0 else "right"
                rows = pa.RecordBatch.from_struct_array(col("_l" if name == "left" else "_r").slice(s, e - s))
                yield tuple(col(k)[s].as_py() for k in keys), (col("_nl")[s].as_py(), col("_nr")[s].as_py()), name, rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = pieces(batches)
        ahead = next(source, None)
        while ahead is not None:
            key, sizes = ahead[:2]
            left_rows = sum(sizes)

            def chunks():
                nonlocal ahead, left_rows
                while ahead is not None and left_rows:
                    name, rows = ahead[2:]
                    left_rows -= rows.num_rows
                    ahead = next(source, None)
                    yield name, rows

            c = chunks()
            for batch in function(key, sizes, c):
                yield batch.cast(types) if batch.schema != types else batch
            for _ in c:  # what the function did not read
                pass

    return u.select(*keys, "_side", "_l", "_r", "_nl", "_nr").mapInArrow(run, result)


def interval_join(
    left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, lower: str, upper: str
) -> DataFrame:
    """Pairs with the same key and ``right.ts in [left.ts + lower, left.ts + upper]``
    (both ends inclusive; ``lower`` may be negative, e.g. ``'-5 seconds'``).

    Time is cut into slots as wide as the interval; the right row sits in one slot, the left
    row's interval touches at most two, so the equi-join runs on ``(key, slot)`` and each pair
    is found once. A hot key is thereby spread over its slots."""
    lo, hi = duration_us(lower), duration_us(upper)
    if hi < lo:
        raise ValueError("upper < lower")
    width = max(hi - lo, 1)
    r = right.withColumn("_slot", floordiv(epoch_us(rts), width))
    lus = epoch_us(lts)
    first, last = floordiv(lus + lo, width), floordiv(lus + hi, width)
    l = left.withColumn("_slot", F.explode(F.sequence(first, last)))
    r_us = epoch_us(F.col(rts))
    cond = (r_us >= lus + lo) & (r_us <= lus + hi)
    return l.join(r, [key, "_slot"]).filter(cond).drop("_slot")


def equi_join(
    big: DataFrame, small: DataFrame, on: Sequence[str] | Column, how: str = "inner", broadcast_max_rows: int | None = None
) -> DataFrame:
    """The unbounded equi-join. By default AQE chooses broadcast vs. sort-merge from the
    runtime size of ``small``; ``broadcast_max_rows`` forces a checked broadcast."""
    if broadcast_max_rows is not None:
        small = checked_broadcast(small, broadcast_max_rows)
    return big.join(small, on, how)


class Pairing:
    """One-to-one pairs of two sides in event time: a row takes the oldest row of the other side
    that still waits and is at most ``tol`` older, else it waits itself. Only one side ever
    waits, for at most ``tol``. ``waiting`` holds (is_app, us, id), ``out`` rows of (app id, app
    us, third id, third us, status)."""

    def __init__(self, tol: int, waiting: Iterable[tuple] = ()):
        self.tol, self.waiting, self.out = tol, deque(waiting), []

    def add(self, is_app: bool, us: int, id_: int) -> None:
        w = self.waiting
        while w and w[0][1] + self.tol < us:
            self._lonely(*w.popleft())
        if w and w[0][0] != is_app:
            _, us2, id2 = w.popleft()
            self.out.append((id_, us, id2, us2, "matched") if is_app else (id2, us2, id_, us, "matched"))
        else:
            w.append((is_app, us, id_))

    def _lonely(self, is_app: bool, us: int | None, id_: int) -> None:
        self.out.append((id_, us, None, None, "missing_third") if is_app else (None, None, id_, us, "missing_app"))

    def expire(self, now: float) -> None:
        """Rows that nothing after ``now`` can match any more are lonely."""
        while self.waiting and self.waiting[0][1] + self.tol <= now:
            self._lonely(*self.waiting.popleft())


def reconcile(
    app: DataFrame, third: DataFrame, key: str, ts_app: str, id_app: str, ts_third: str, id_third: str,
    tolerance: str, split: Callable[[DataFrame, str, str], str | Column] | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """One-to-one pairs of payments of one key at most ``tolerance`` apart (inclusive).

    In event time (ties by id) a row takes the oldest row of the other side that waits for it
    (:class:`Pairing`): ``matched``. Rows left alone for the tolerance are ``missing_third`` /
    ``missing_app``; matching goes on behind them. A row without a time matches nothing. Ids
    are integers, keys of any type that sorts; both stay exact, nulls included. Output: ``key, app_id,
    app_ts, third_id, third_ts, status`` under the input's names.

    Rows of a key are paired in one sorted pass that holds only waiting rows. A hot key
    (:func:`keyed.hot`) is first cut into stretches: no pair reaches over a gap longer than the
    tolerance, so each stretch (found by the slice-split lag and running count) is paired by itself.
    One task has a stretch of a hot key, not the key; a key that never pauses for the tolerance
    stays one stretch. ``split`` cuts every key so."""
    findable(app.sparkSession)
    tol = duration_us(tolerance)
    one = lambda d, ts, i, is_app: d.select(
        F.col(key).alias("k"), F.col(ts).alias("ts"), F.col(i).cast("bigint").alias("id"), F.lit(is_app).alias("is_app")
    )
    u = one(app, ts_app, id_app, True).unionByName(one(third, ts_third, id_third, False))
    order = ["ts", "id", "is_app"]

    def parted(d: DataFrame, cut: str | Column) -> DataFrame:
        d = keyed.lag(d.withColumn("us", epoch_us("ts")), ["k"], order, cut, ["us"], 1, "prev")
        gap = F.coalesce(F.col("us") - F.col("prev1_us") > tol, F.lit(False))
        return keyed.running(d.withColumn("_gap", gap.cast("bigint")), ["k"], order, cut, {"part": ("sum", "_gap")})

    if split is not None:
        u = parted(u, split(u, "k", "ts"))
    else:
        is_hot = keyed.hot(u, "k", hot_rows)
        whole = u if is_hot is None else u.filter(~is_hot)
        whole = whole.withColumn("us", epoch_us("ts")).withColumn("part", F.lit(0).cast("bigint"))
        cols = ["k", "part", "us", "id", "is_app"]
        if is_hot is not None:
            warm = u.filter(is_hot)
            whole = whole.select(*cols).unionByName(parted(warm, keyed.time_split(warm, "ts")).select(*cols))
        u = whole
    u = u.select("k", "part", "us", "id", "is_app").repartition("k", "part").sortWithinPartitions("k", "part", "us", "id", "is_app")
    found = StructType([StructField("k", u.schema["k"].dataType)] + [StructField(c, LongType()) for c in ("a_id", "a_us", "t_id", "t_us")] + [StructField("status", StringType())])
    types = to_arrow_schema(found)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, queue = None, Pairing(tol)

        def rows(k) -> list[tuple]:
            done, queue.out = [(k, *r) for r in queue.out], []
            return done

        def table(found: list[tuple]) -> pa.RecordBatch:
            cols = zip(*found) if found else [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, types)], schema=types)

        for b in batches:
            found = []
            for k, part, t, i, is_app in zip(*[c.to_pylist() for c in b.columns]):
                if (k, part) != now:
                    if now is not None:
                        queue.expire(float("inf"))
                        found += rows(now[0])
                    now = (k, part)
                queue._lonely(is_app, None, i) if t is None else queue.add(is_app, t, i)
                if queue.out:
                    found += rows(k)
            yield table(found)
        if now is not None:
            queue.expire(float("inf"))
            yield table(rows(now[0]))

    at = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return u.mapInArrow(pair, found).select(
        F.col("k").alias(key), F.col("a_id").alias(id_app), at("a_us").alias(ts_app), F.col("t_id").alias(id_third),
        at("t_us").alias(ts_third), "status",
    )


def rule_join(
    actions: DataFrame,
    rules: DataFrame,
    key: str,
    order: Sequence[str],
    split: str | Column,
    action: str,
    mode: str = "all",
    version: str = "version",
    max_rules: int = 100_000,
) -> DataFrame:
    """Emit (row, rule) where the key's previous action equals ``rules.action1`` and the
    current one ``rules.action2``. ``mode='all'`` checks every rule; ``mode='latest'`` only
    the rule with the highest ``version`` (the reference's single broadcast slot, Q5), of equal
    versions the first by its other columns.
    The rule table is broadcast after a bounded count."""
    if mode == "latest":
        rules = rules.orderBy(F.col(version).desc(), *[c for c in rules.columns if c != version]).limit(1)
    elif mode != "all":
        raise ValueError("mode must be 'all' or 'latest'")
    prev = keyed.lag(actions, [key], order, split, [action], 1, "prev")
    p = f"prev1_{action}"
    r = checked_broadcast(rules, max_rules)
    return prev.join(r, (F.col(p) == r["action1"]) & (F.col(action) == r["action2"])).drop(p)
