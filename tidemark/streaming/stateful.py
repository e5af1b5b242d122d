"""Custom keyed state and timers on streams.

Each operator is ``groupBy(key).applyInPandasWithState``: Spark keeps the per-key state in its
checkpointed state store, shuffles rows by key and calls the function once per key and
micro-batch with that key's new rows. The operators whose result depends on order (patterns,
count windows, row averages, state forms, rules, reconciliation) run through :func:`_in_order`:
a row waits in state until the watermark has passed it, so rows are handled by ``(ts, seq)``
whatever batch they came in, and rows later than the watermark are dropped by Spark. Their state is
the rows of the watermark's delay and a few counters or rows; :func:`keyed_state_forms` also has a
counter for each value of a key, which is what its map state is. A call sees the rows of one key
in one micro-batch (bounded by ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).

Input: a stream with the key, an event-time ``et`` column carrying the watermark (see
:func:`tidemark.streaming.basic.event_time`) and a numeric tie-break ``seq``. Timestamps in
the output are ``timestamp_ntz`` like the batch forms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.durations import duration_us
from tidemark.functions.time import epoch_us, floordiv
from tidemark.operators.joins import Pairing
from tidemark.session import findable


def _prepared(df: DataFrame, key: str, et: str, seq: str, extra: Sequence[str | F.Column] = ()) -> DataFrame:
    findable(df.sparkSession)
    # ``et`` stays in the input: it carries the watermark the event-time timeouts need
    return df.select(F.col(key).alias("k"), epoch_us(et).alias("us"), F.col(seq).alias("seq"), F.col(et), *extra)


def _ktype(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _rows(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    pdf = pd.concat(list(pdfs), ignore_index=True)
    return pdf.sort_values(["us", "seq"], kind="mergesort")


def _ntz(c: str) -> F.Column:
    return F.timestamp_micros(F.col(c)).cast("timestamp_ntz")


def _table(out: str, **cols) -> pd.DataFrame:
    """A frame of the schema ``out`` (``name type, ...``); bigint columns may hold nulls."""
    pdf = pd.DataFrame(cols, columns=[c.split()[0] for c in out.split(", ")])
    return pdf.astype({c.split()[0]: "Int64" for c in out.split(", ")[1:] if c.endswith(" bigint")})


def _in_order(
    d: DataFrame, x_type: str, out: str, own: str, init: Sequence,
    step: Callable[[object, pd.DataFrame, tuple, float], tuple[pd.DataFrame, tuple | None, int | None]],
) -> DataFrame:
    """Runs ``step(key, rows, mine, watermark)`` over each key's rows in the order ``(us, seq)``.

    ``d`` has the columns ``k, us, seq`` and a payload ``x`` of ``x_type``. Rows newer than the
    watermark stay in state; ``rows`` are those that no later batch can precede any more.
    ``mine`` are the operator's own state fields (schema ``own``, first value ``init``); a step
    returns its output rows (schema ``out``), the new fields or None when there is nothing to
    keep, and the event time in microseconds at which it wants to be called without new rows."""

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        us, sq, xs, *mine = state.get if state.exists else ([], [], [], *init)
        parts = [pd.DataFrame({"us": np.array(us, "int64"), "seq": np.array(sq, "int64"), "x": pd.Series(list(xs), dtype=object)})]
        if not state.hasTimedOut:
            parts += [p[["us", "seq", "x"]].astype({"x": object}) for p in pdfs]
        rows = pd.concat([p for p in parts if len(p)] or parts[:1], ignore_index=True).sort_values(["us", "seq"], kind="mergesort")
        ms = state.getCurrentWatermarkMs()
        wm = ms * 1000 if ms > 0 else float("-inf")  # 0: there is no watermark yet
        n = int(np.searchsorted(rows["us"].to_numpy(), wm, side="right"))
        result, keep, wake = step(k[0], rows.iloc[:n].reset_index(drop=True), tuple(mine), wm)
        rest = rows.iloc[n:]
        if keep is None and not len(rest):
            state.remove()
        else:
            x = [None if pd.isna(v) else v.item() if isinstance(v, np.generic) else v for v in rest["x"]]
            state.update((rest["us"].tolist(), rest["seq"].tolist(), x, *(init if keep is None else keep)))
            due = [t for t in (wake, int(rest["us"].iloc[0]) if len(rest) else None) if t is not None]
            if due:
                state.setTimeoutTimestamp(max(min(due) // 1000, ms + 1))
        yield result

    return d.groupBy("k").applyInPandasWithState(
        fn, f"k {_ktype(d, 'k')}, {out}", f"us array<bigint>, seq array<bigint>, x array<{x_type}>, {own}", "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def followed_by_within(
    df: DataFrame, key: str, kind: str, first: str, second: str, within: str, et: str = "et", seq: str = "seq"
) -> DataFrame:
    """C03 on a stream: each ``first`` row waits for the next ``second`` row of its key in event
    time; it is ``matched`` if that row comes less than ``within`` later, and ``timeout`` once the
    watermark passes ``first + within``, as in the batch form. State: the waiting rows, none
    older than ``within``."""
    w_us = duration_us(within)
    sym = F.when(F.col(kind) == first, 0).when(F.col(kind) == second, 1).otherwise(2).cast("int")
    d = _prepared(df, key, et, seq, [sym.alias("x")])
    out = "first_seq bigint, first_us bigint, second_seq bigint, second_us bigint, status string"

    def step(k, rows, mine, wm):
        x = rows["x"].to_numpy("int64")
        f, s = x == 0, x == 1
        us = np.concatenate([np.array(mine[0], "int64"), rows["us"].to_numpy()[f]])
        sq = np.concatenate([np.array(mine[1], "int64"), rows["seq"].to_numpy()[f]])
        at = np.concatenate([np.full(len(mine[0]), -1), np.flatnonzero(f)])
        nxt = np.searchsorted(np.flatnonzero(s), at)  # the next second row, if any
        found = nxt < s.sum()
        nxt = np.minimum(nxt, max(s.sum() - 1, 0))
        s_us, s_sq = rows["us"].to_numpy()[s], rows["seq"].to_numpy()[s]
        to_us = s_us[nxt] if len(s_us) else np.zeros(len(us), "int64")
        to_sq = s_sq[nxt] if len(s_sq) else np.zeros(len(us), "int64")
        hit = found & (to_us - us < w_us)
        done = found | (us + w_us <= wm)
        pd_out = _table(
            f"k x, {out}", k=[k] * int(done.sum()), first_seq=sq[done], first_us=us[done],
            second_seq=pd.array(to_sq, "Int64")[done], second_us=pd.array(to_us, "Int64")[done],
            status=np.where(hit[done], "matched", "timeout"),
        )
        pd_out.loc[~hit[done], ["second_seq", "second_us"]] = pd.NA
        if done.all():
            return pd_out, None, None
        return pd_out, (us[~done].tolist(), sq[~done].tolist()), int(us[~done].min()) + w_us

    r = _in_order(d, "int", out, "f_us array<bigint>, f_seq array<bigint>", ([], []), step)
    return r.select(
        F.col("k").alias(key), F.col("first_seq").alias(f"first_{seq}"), _ntz("first_us").alias("first_ts"),
        F.col("second_seq").alias(f"second_{seq}"), _ntz("second_us").alias("second_ts"), "status",
    )


def group_of_n_average(df: DataFrame, key: str, n: int, value: str, et: str = "et", seq: str = "seq", name: str = "avg") -> DataFrame:
    """A15 on a stream: value + aggregating state (count, sum, block number); a block is
    emitted when its ``n``-th row in event time is there and the state is cleared (X13)."""
    d = _prepared(df, key, et, seq, [F.col(value).cast("bigint").alias("x")])
    out = f"grp bigint, {name} bigint"

    def step(k, rows, mine, wm):
        cnt, tot, grp = mine
        v = rows["x"].to_numpy("int64")
        total = tot + np.cumsum(v)
        end = np.arange(n - cnt - 1, len(v), n)  # the last row of each whole block
        sums = np.diff(total[end], prepend=0)
        o = _table(f"k x, {out}", k=[k] * len(end), grp=grp + np.arange(len(end)), **{name: sums // n})
        if len(end):
            left = v[end[-1] + 1 :]
            return o, (len(left), int(left.sum()), grp + len(end)), None
        return o, (cnt + len(v), tot + int(v.sum()), grp), None

    r = _in_order(d, "bigint", out, "cnt bigint, tot bigint, grp bigint", (0, 0, 0), step)
    return r.withColumnRenamed("k", key)


def state_machine(
    df: DataFrame, key: str, symbol: F.Column, next_state: Sequence[Sequence[int]], emit: Sequence[Sequence[bool]],
    start: int = 0, et: str = "et", seq: str = "seq",
) -> DataFrame:
    """C04 on a stream: one value state (the machine's state) per key; alert rows out. A null
    symbol is the last one of the table, as in the batch form."""
    d = _prepared(df, key, et, seq, [F.coalesce(symbol.cast("int"), F.lit(len(next_state) - 1)).alias("x")])
    nxt = [list(r) for r in next_state]
    em = [list(r) for r in emit]
    out = "seq bigint, us bigint"

    def step(k, rows, mine, wm):
        s, hits = mine[0], []
        for i, sym in enumerate(rows["x"].tolist()):
            if em[sym][s]:
                hits.append(i)
            s = nxt[sym][s]
        h = rows.iloc[hits]
        return _table(f"k x, {out}", k=[k] * len(h), seq=h["seq"].to_numpy(), us=h["us"].to_numpy()), (s,), None

    r = _in_order(d, "int", out, "s int", (start,), step)
    return r.select(F.col("k").alias(key), F.col("seq").alias(seq), _ntz("us").alias("ts"))


def consecutive(df: DataFrame, key: str, pred: F.Column, n: int, et: str = "et", seq: str = "seq") -> DataFrame:
    """C02 on a stream: the run length is the operator's only state."""
    d = _prepared(df, key, et, seq, [F.coalesce(pred, F.lit(False)).alias("x")])
    out = "seq bigint, us bigint, run bigint"

    def step(k, rows, mine, wm):
        ok = rows["x"].to_numpy("bool")
        i = np.arange(len(ok))
        broken = np.maximum.accumulate(np.where(ok, -1 - mine[0], i)) if len(ok) else i
        run = i - broken
        h = run >= max(n, 1)
        o = _table(f"k x, {out}", k=[k] * int(h.sum()), seq=rows["seq"].to_numpy()[h], us=rows["us"].to_numpy()[h], run=run[h])
        return o, (int(run[-1]) if len(run) else mine[0],), None

    r = _in_order(d, "boolean", out, "run bigint", (0,), step)
    return r.select(F.col("k").alias(key), F.col("seq").alias(seq), _ntz("us").alias("ts"), "run")


def rows_average(df: DataFrame, key: str, rows: int, et: str = "et", seq: str = "seq", name: str = "avg_ts_ms") -> DataFrame:
    """W11 on a stream (Spark refuses OVER frames on streams): list state of the last
    ``rows - 1`` timestamps; integer mean in epoch ms of the frame ending at each row."""
    d = _prepared(df, key, et, seq, [F.lit(0).alias("x")])
    out = f"seq bigint, {name} bigint"

    def step(k, new, mine, wm):
        ms = np.concatenate([np.array(mine[0], "int64"), new["us"].to_numpy() // 1000])
        total, have = np.concatenate([[0], np.cumsum(ms)]), len(mine[0])
        end = np.arange(have, len(ms)) + 1
        begin = np.maximum(end - rows, 0)
        o = _table(f"k x, {out}", k=[k] * len(new), seq=new["seq"].to_numpy(), **{name: (total[end] - total[begin]) // (end - begin)})
        return o, (ms[len(ms) - min(rows - 1, len(ms)) :].tolist(),), None

    r = _in_order(d, "int", out, "last array<bigint>", ([],), step)
    return r.select(F.col("k").alias(key), F.col("seq").alias(seq), name)


def event_timer(df: DataFrame, key: str, delay: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """X01 on a stream: arrivals are emitted at once; each row registers an event-time timer
    at ``ts + delay``; pending fire times are a sorted set in state and the state's timeout is
    their minimum, so several pending timers per key fire in order."""
    d_us = duration_us(delay)
    d = _prepared(df, key, et, seq)

    def fn(k, pdfs, state: GroupState):
        pend = set(int(x) for x in state.get[0]) if state.exists else set()
        out = []
        if state.hasTimedOut:
            wm = state.getCurrentWatermarkMs() * 1000
            for t in sorted(x for x in pend if x <= wm):
                out.append((k[0], "timer", t))
            pend = {x for x in pend if x > wm}
        else:
            for r in _rows(pdfs).itertuples(index=False):
                out.append((k[0], "arrival", int(r.us)))
                pend.add(int(r.us) + d_us)
        if pend:
            state.update((sorted(pend),))
            state.setTimeoutTimestamp(max(min(pend) // 1000, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["k", "kind", "us"])

    r = d.groupBy("k").applyInPandasWithState(
        fn, f"k {_ktype(df, key)}, kind string, us bigint", "pend array<bigint>", "append", GroupStateTimeout.EventTimeTimeout
    )
    return r.select(F.col("k").alias(key), "kind", _ntz("us").alias("at"))


def late_route(df: DataFrame, key: str, size: str, lateness: str = "0 seconds", et: str = "et", seq: str = "seq") -> DataFrame:
    """L07 on a stream: rows are tagged ``late`` when their tumbling window has closed for good
    (``window_end + lateness <= watermark``), else ``main``; nothing is dropped. It reads the
    watermark in a no-timeout state function, which receives late rows (with an event-time
    timeout Spark would drop them first). Put it before any window aggregate and send the
    routes to their sinks from one ``foreachBatch`` (:func:`tidemark.sinks.outputs.fan_out`)."""
    s_us, l_us = duration_us(size), duration_us(lateness)
    d = _prepared(df, key, et, seq)

    def fn(k, pdfs, state: GroupState):
        wm = state.getCurrentWatermarkMs() * 1000
        pdf = _rows(pdfs)
        end = (pdf["us"] // s_us) * s_us + s_us
        late = (wm > 0) & (end + l_us <= wm)
        yield pd.DataFrame({"k": pdf["k"], "seq": pdf["seq"], "us": pdf["us"], "route": late.map({True: "late", False: "main"})})

    r = d.groupBy("k").applyInPandasWithState(
        fn, f"k {_ktype(df, key)}, seq bigint, us bigint, route string", "x int", "append", GroupStateTimeout.NoTimeout
    )
    return r.select(F.col("k").alias(key), F.col("seq").alias(seq), _ntz("us").alias("et"), "route")


def refired_windows(df: DataFrame, key: str, size: str, bound: str, lateness: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Tumbling windows with allowed lateness, every firing of each: ``key, window_start, window_end,
    firing`` (from 1) and ``cnt``, and rows too late for their window with firing 0 and cnt null.

    A window fires when the watermark (greatest ``ts`` - ``bound``) reaches its end, and once more for
    each row that comes later, until the watermark reaches end + ``lateness``. ``df`` has no watermark
    yet: Spark's own stands ``lateness + size`` further back, as Spark drops rows by their time
    and not by their window's end; rows behind even that are gone (:func:`late_route` sees them).
    State: two numbers for each open (key, window)."""
    s_us, l_us = duration_us(size), duration_us(lateness)
    behind = l_us + s_us
    d = df.withColumn("et", F.col(ts).cast("timestamp")).withWatermark("et", f"{duration_us(bound) + behind} microseconds")
    d = _prepared(d, key, "et", seq).withColumn("w", floordiv(F.col("us"), s_us) * s_us)
    out = f"k {_ktype(df, key)}, w bigint, firing bigint, cnt bigint"

    def fn(k, pdfs, state: GroupState):
        key_, start = k[0], int(k[1])
        end = start + s_us
        cnt, fired = state.get if state.exists else (0, 0)
        ms = state.getCurrentWatermarkMs()
        now = ms * 1000 + behind if ms > 0 else float("-inf")  # the watermark without lateness
        found = []
        if cnt and not fired and end <= now:
            fired = 1
            found.append((1, cnt))
        n = 0 if state.hasTimedOut else sum(len(p) for p in pdfs)
        if end + l_us <= now:
            found += [(0, None)] * n
        elif end <= now:
            found += [(fired + i, cnt + i) for i in range(1, n + 1)]
            fired, cnt = fired + n, cnt + n
        else:
            cnt += n
        if end + l_us <= now:
            if state.exists:
                state.remove()
        else:
            state.update((cnt, fired))
            due = (end + (l_us if fired else 0) - behind) // 1000
            state.setTimeoutTimestamp(max(due, ms + 1, 1))
        yield _table(out, k=[key_] * len(found), w=[start] * len(found), firing=[f for f, _ in found], cnt=pd.array([c for _, c in found], "Int64"))

    r = d.groupBy("k", "w").applyInPandasWithState(fn, out, "cnt bigint, fired bigint", "append", GroupStateTimeout.EventTimeTimeout)
    return r.select(F.col("k").alias(key), _ntz("w").alias("window_start"), F.timestamp_micros(F.col("w") + F.lit(s_us)).cast("timestamp_ntz").alias("window_end"), F.col("firing").cast("int").alias("firing"), "cnt")


def periodic_count(df: DataFrame, key: str, period: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """X03 on a stream: from a key's first row in event time an event-time timer every ``period`` emits
    the key's cumulative count of rows with ``ts <= tick``; the timer re-arms itself. Rows are
    handled in event time, so ticks do not depend on the order of arrival within the watermark's
    delay. State: next tick, count so far, and the rows newer than the watermark."""
    p = duration_us(period)
    d = _prepared(df, key, et, seq, [F.lit(0).alias("x")])
    out = "us bigint, pv bigint"

    def step(k, rows, mine, wm):
        nxt, cnt = mine
        us = rows["us"].to_numpy("int64")
        if nxt is None:
            if not len(us):
                return _table(f"k x, {out}", k=[], us=[], pv=[]), None, None
            nxt = int(us[0]) + p
        ticks = np.arange(nxt, int(wm) + 1, p) if nxt <= wm else np.zeros(0, "int64")
        pv = cnt + np.searchsorted(us, ticks, side="right")
        nxt += p * len(ticks)
        return _table(f"k x, {out}", k=[k] * len(ticks), us=ticks, pv=pv), (nxt, cnt + len(us)), nxt

    r = _in_order(d, "int", out, "nxt bigint, cnt bigint", (None, 0), step)
    return r.select(F.col("k").alias(key), _ntz("us").alias("tick"), "pv")


def processing_timer(df: DataFrame, key: str, delay: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """X02 on a stream: arrivals at once, then one ``timer`` row per arrival ``delay`` of
    processing time later (pending fire times kept in state; the timeout is their minimum).
    Wall-clock driven, so only row counts are reproducible."""
    d_ms = duration_us(delay) // 1000
    d = _prepared(df, key, et, seq)

    def fn(k, pdfs, state: GroupState):
        pend = list(state.get[0]) if state.exists else []
        now = state.getCurrentProcessingTimeMs()
        out = [(k[0], "timer", t) for t in pend if t <= now]
        pend = [t for t in pend if t > now]
        if not state.hasTimedOut:
            for r in _rows(pdfs).itertuples(index=False):
                out.append((k[0], "arrival", now))
                pend.append(now + d_ms)
        if pend:
            state.update((sorted(pend),))
            state.setTimeoutDuration(max(min(pend) - now, 1))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["k", "kind", "ms"])

    r = d.groupBy("k").applyInPandasWithState(
        fn, f"k {_ktype(df, key)}, kind string, ms bigint", "pend array<bigint>", "append",
        GroupStateTimeout.ProcessingTimeTimeout,
    )
    return r.select(F.col("k").alias(key), "kind", F.timestamp_millis("ms").alias("at"))


def keyed_window_counts(df: DataFrame, key: str, size: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """W13 on a stream: the hand-made tumbling window — a map state window start -> count per
    key, and an event-time timer at the earliest window end; a window is emitted and removed
    once the watermark reaches its end. Must equal the built-in window count (A12)."""
    s = duration_us(size)
    d = _prepared(df, key, et, seq)

    def fn(k, pdfs, state: GroupState):
        wins = dict(zip(state.get[0], state.get[1])) if state.exists else {}
        wm = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            for us in _rows(pdfs)["us"]:
                st = (int(us) // s) * s
                wins[st] = wins.get(st, 0) + 1
        done = sorted(st for st in wins if st + s <= wm)
        out = [(k[0], st, st + s, wins.pop(st)) for st in done]
        if wins:
            starts = sorted(wins)
            state.update((starts, [wins[x] for x in starts]))
            state.setTimeoutTimestamp(max((starts[0] + s) // 1000, state.getCurrentWatermarkMs() + 1))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["k", "s", "e", "cnt"])

    r = d.groupBy("k").applyInPandasWithState(
        fn, f"k {_ktype(df, key)}, s bigint, e bigint, cnt bigint", "starts array<bigint>, counts array<bigint>", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return r.select(F.col("k").alias(key), _ntz("s").alias("window_start"), _ntz("e").alias("window_end"), "cnt")


def reconcile(df: DataFrame, key: str, side: str, app: str, tolerance: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """J05 on a stream (G11 / X12): one stream of both payment kinds, ``side == app`` marks
    the app's rows. In event time a row pairs with the oldest row of the other side that waits
    for it and is at most ``tolerance`` old: ``matched``; a row nobody claims within
    ``tolerance`` is ``missing_third`` / ``missing_app`` once the watermark passes that. Only one
    side ever waits, and no longer than the tolerance."""
    tol = duration_us(tolerance)
    d = _prepared(df, key, et, seq, [F.coalesce(F.col(side) == app, F.lit(False)).alias("x")])
    out = "app_seq bigint, app_us bigint, third_seq bigint, third_us bigint, status string"

    def step(k, rows, mine, wm):
        queue = Pairing(tol, zip(mine[0], mine[1], mine[2]))
        for is_app, us, s in zip(rows["x"].tolist(), rows["us"].tolist(), rows["seq"].tolist()):
            queue.add(bool(is_app), us, s)
        queue.expire(wm)
        cols = list(zip(*queue.out)) or [[]] * 5
        names = ["app_seq", "app_us", "third_seq", "third_us", "status"]
        o = _table(f"k x, {out}", k=[k] * len(queue.out), **dict(zip(names, map(list, cols))))
        if not queue.waiting:
            return o, None, None
        left = [list(c) for c in zip(*queue.waiting)]
        return o, tuple(left), queue.waiting[0][1] + tol

    r = _in_order(d, "boolean", out, "w_app array<boolean>, w_us array<bigint>, w_seq array<bigint>", ([], [], []), step)
    return r.select(
        F.col("k").alias(key), "app_seq", _ntz("app_us").alias("app_ts"), "third_seq", _ntz("third_us").alias("third_ts"), "status"
    )


def keyed_state_forms(df: DataFrame, key: str, value: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """X04-X08 on a stream, the five kinds of keyed state in one processor: value state (the
    previous row), list state (its size), map state (count per ``value``), reducing state
    (first row's ``value`` with the newest timestamp) and aggregating state
    (``"count : n"``). One output row per input row, as the batch forms."""
    d = _prepared(df, key, et, seq, [F.col(value).cast("string").alias("x")])
    out = "seq bigint, prev_v string, prev_seq bigint, list_size bigint, map_count bigint, first_v string, us bigint, agg string"

    def step(k, rows, mine, wm):
        prev_v, prev_s, n, mk, mv, first_v = mine
        if not len(rows):
            return _table(f"k x, {out}"), mine, None
        counts = dict(zip(mk, mv))
        v, sq = rows["x"], rows["seq"]
        size = n + 1 + np.arange(len(rows))
        nth = v.groupby(v, dropna=False).cumcount().to_numpy() + 1 + np.array([counts.get(x, 0) for x in v])
        named = [x for x in v if x is not None]
        seen = first_v if first_v is not None or not named else named[0]
        lead = int(v.notna().to_numpy().argmax()) if named else len(v)
        firsts = [first_v if first_v is not None or i < lead else seen for i in range(len(v))]
        o = _table(
            f"k x, {out}", k=[k] * len(rows), seq=sq.to_numpy(), prev_v=[prev_v, *v[:-1]],
            prev_seq=pd.array([prev_s, *sq[:-1].tolist()], "Int64"), list_size=size, map_count=nth, first_v=firsts,
            us=rows["us"].to_numpy(), agg=[f"count : {i}" for i in size],
        )
        for x in v:
            counts[x] = counts.get(x, 0) + 1
        return o, (v.iloc[-1], int(sq.iloc[-1]), int(size[-1]), list(counts), list(counts.values()), seen), None

    own = "prev_v string, prev_seq bigint, n bigint, mk array<string>, mv array<bigint>, first_v string"
    r = _in_order(d, "string", out, own, (None, None, 0, [], [], None), step)
    return r.select(
        F.col("k").alias(key), F.col("seq").alias(seq), F.col("prev_v").alias(f"prev_{value}"), F.col("prev_seq").alias(f"prev_{seq}"),
        "list_size", "map_count", F.col("first_v").alias(f"first_{value}"), _ntz("us").alias("latest_ts"), "agg",
    )


def rule_join(df: DataFrame, rules: DataFrame, key: str, action: str, et: str = "et", seq: str = "seq", max_rules: int = 100_000) -> DataFrame:
    """J06 on a stream: the previous action per key is value state; the (previous, current)
    pairs are joined with the rule table as a stream-static join, the rule table broadcast
    after a bounded count (re-read each micro-batch when it is a table)."""
    from tidemark.operators.joins import checked_broadcast

    d = _prepared(df, key, et, seq, [F.col(action).cast("string").alias("x")])
    out = "seq bigint, prev string, cur string"

    def step(k, rows, mine, wm):
        prev = [mine[0], *rows["x"]]
        o = _table(f"k x, {out}", k=[k] * len(rows), seq=rows["seq"].to_numpy(), prev=prev[:-1], cur=prev[1:])
        return o[o["prev"].notna()], (prev[-1],), None

    pairs = _in_order(d, "string", out, "prev string", (None,), step)
    r = checked_broadcast(rules, max_rules)
    j = pairs.join(r, (pairs["prev"] == r["action1"]) & (pairs["cur"] == r["action2"]))
    return j.select(F.col("k").alias(key), F.col("seq").alias(seq), F.col("cur").alias(action), *[c for c in rules.columns])


def count_window(df: DataFrame, key: str, size: int, slide: int, value: str, et: str = "et", seq: str = "seq") -> DataFrame:
    """W04 on a stream: list state of the key's last ``size`` values; every ``slide``-th row
    emits the frame (rows, sum, first position), as :func:`tidemark.operators.windows.count_window`."""
    d = _prepared(df, key, et, seq, [F.col(value).cast("bigint").alias("x")])
    out = "fire_pos bigint, frame_rows bigint, frame_sum bigint, frame_first bigint"

    def step(k, rows, mine, wm):
        pos, have = mine[0], len(mine[1])
        v = np.concatenate([np.array(mine[1], "int64"), rows["x"].to_numpy("int64")])
        total = np.concatenate([[0], np.cumsum(v)])
        end = np.arange(have, len(v)) + 1  # frame ends, as places in v
        at = pos + 1 + np.arange(len(rows))
        fire = at % slide == 0
        end, at = end[fire], at[fire]
        begin = np.maximum(end - size, 0)
        o = _table(f"k x, {out}", k=[k] * len(at), fire_pos=at, frame_rows=end - begin, frame_sum=total[end] - total[begin], frame_first=at - (end - begin) + 1)
        return o, (pos + len(rows), v[max(len(v) - size, 0) :].tolist()), None

    r = _in_order(d, "bigint", out, "pos bigint, last array<bigint>", (0, []), step)
    return r.withColumnRenamed("k", key)


def cogroup(df: DataFrame, key: str, side: str, size: str, et: str = "et", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """J02 on a stream, in the batch form's long layout but with bounded state. ``df`` holds
    both inputs with a ``side`` column ('left' / 'right'). Returns two streams:

    * members: every row at once with its ``pos`` in its (key, window, side) list — the
      state is one counter per list, dropped by an event-time timeout at the window end;
    * sizes: ``n_left`` / ``n_right`` per (key, window), emitted when the window closes
      (a windowed count in append mode).
    """
    s_us = duration_us(size)
    d = _prepared(df, key, et, seq, [F.col(side).alias("side"), epoch_us(F.window(et, size).start).alias("ws")])

    def fn(k, pdfs, state: GroupState):
        n = state.get[0] if state.exists else 0
        out = []
        if not state.hasTimedOut:
            for r in _rows(pdfs).itertuples(index=False):
                n += 1
                out.append((k[0], k[2], n, int(r.seq), int(r.us)))
            state.update((n,))
            wm = state.getCurrentWatermarkMs()
            state.setTimeoutTimestamp(max((int(k[1]) + s_us) // 1000, wm + 1))
        else:
            state.remove()
        yield pd.DataFrame(out, columns=["k", "side", "pos", "seq", "us"])

    members = d.groupBy("k", "ws", "side").applyInPandasWithState(
        fn, f"k {_ktype(df, key)}, side string, pos bigint, seq bigint, us bigint", "n bigint", "append",
        GroupStateTimeout.EventTimeTimeout,
    ).select(
        F.col("k").alias(key), F.window(_ntz("us"), size).start.alias("window_start"), "side", "pos",
        F.col("seq").alias(seq), _ntz("us").alias("ts"),
    )
    w = F.window(et, size)
    sizes = df.groupBy(F.col(key), w.alias("w")).agg(
        F.count(F.when(F.col(side) == "left", 1)).alias("n_left"), F.count(F.when(F.col(side) == "right", 1)).alias("n_right")
    ).select(key, F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"),
             "n_left", "n_right")
    return members, sizes
