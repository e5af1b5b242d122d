"""Event patterns in sequence.

All are per-key scans over an explicit order and use the slice-split scans of
:mod:`tidemark.operators.keyed`, so a hot key never lands in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.durations import duration_us
from tidemark.functions.time import epoch_us
from tidemark.operators import keyed


def adjacent(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, pred: Column, n: int, cols: Sequence[str]
) -> DataFrame:
    """``begin.where(p).next.where(p)...`` — ``n`` strictly adjacent rows of a key that
    all satisfy ``pred``; matches may overlap. One row per match with ``{c}_{i}`` for the
    i-th row of the match (i = 1..n)."""
    cols = list(cols)
    d = df.withColumn("_ok", F.coalesce(pred, F.lit(False)))
    k = n - 1
    if k:
        d = keyed.lag(d, keys, order, split, ["_ok", *cols], k, "_p")
    cond = F.col("_ok")
    for j in range(1, k + 1):
        cond = cond & F.coalesce(F.col(f"_p{j}__ok"), F.lit(False))
    out = [*keys]
    for i in range(1, n + 1):
        back = n - i
        for c in cols:
            out.append((F.col(c) if back == 0 else F.col(f"_p{back}_{c}")).alias(f"{c}_{i}"))
    return d.filter(cond).select(*out)


def consecutive(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, pred: Column, n: int, cols: Sequence[str]
) -> DataFrame:
    """``times(n).consecutive()`` — rows ending a run of at least ``n`` matching rows,
    with the run length so far (gaps-and-islands, see :func:`keyed.run_length`)."""
    r = keyed.run_length(df, keys, order, split, pred, "run")
    return r.filter(F.col("run") >= n).select(*keys, *cols, "run")


def followed_by_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: str | Column,
    first: Column,
    second: Column,
    within: str,
    cols: Sequence[str],
    ts: str = "ts",
) -> DataFrame:
    """``begin(first).followedBy(second).within(t)`` with relaxed contiguity.

    Every ``first`` row pairs with the next ``second`` row of its key; it is ``matched`` if
    that row is less than ``within`` later (strict), otherwise ``timeout`` (the reference's
    timed-out side output) and the match columns are null."""
    w_us = duration_us(within)
    cols = list(cols)
    d = df.filter(first | second).withColumn("_is1", first).withColumn("_is2", second)
    nm = keyed.next_match(d, keys, order, split, F.col("_is2"), cols, "_nx")
    ok = F.col("_nx").isNotNull() & ((epoch_us(F.col(f"_nx.{ts}")) - epoch_us(ts)) < w_us)
    return nm.filter("_is1").select(
        *keys,
        *[F.col(c).alias(f"first_{c}") for c in cols],
        *[F.when(ok, F.col(f"_nx.{c}")).alias(f"second_{c}") for c in cols],
        F.when(ok, "matched").otherwise("timeout").alias("status"),
    )


#: States whose function fits in one bigint: a digit of base STATES for each state.
STATES = 15


def _scanned(d: DataFrame, group: str, order: Sequence[Column | str], function: str, states: int) -> DataFrame:
    """Adds ``_upto``: the composition, in ``order`` within ``group`` (a struct column), of the functions of all
    rows up to this one, and ``_before``: of those before it. Functions of ``0..states-1`` are
    packed in a bigint, the digit of base ``STATES`` at place s being f(s).

    One sorted pass: rows come sorted, a batch is composed by doubling, and what is carried to
    the next batch is one function."""
    fields = d.schema[group].dataType.names
    schema = StructType([*d.schema, StructField("_upto", LongType()), StructField("_before", LongType())])
    base = STATES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = base ** np.arange(states, dtype=np.int64)
        same = np.arange(states)
        last, carry = None, same
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            keys = b.column(b.schema.get_field_index(group))
            new = np.zeros(n, bool)
            for f in fields:
                codes = keys.field(f).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            first = keys[0].as_py()
            new[0] = first != last
            last = keys[n - 1].as_py()
            packed = b.column(b.schema.get_field_index(function)).to_numpy(zero_copy_only=False)
            own = packed[:, None] // power % base
            if not new[0]:
                own[0] = own[0][carry]
            start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            upto, step = own, 1
            while step < n:
                at = np.flatnonzero(np.arange(n) - step >= start)
                if not len(at):
                    break
                done = upto.copy()
                done[at] = np.take_along_axis(upto[at], upto[at - step], axis=1)
                upto, step = done, 2 * step
            before = np.vstack([same if new[0] else carry, upto[:-1]])
            before[new] = same
            carry = upto[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(upto @ power), pa.array(before @ power)], names=[*b.schema.names, "_upto", "_before"])

    return d.repartition(F.col(group)).sortWithinPartitions(group, *order).mapInArrow(scan, schema)


def _applied(function: str | Column, state: Column) -> Column:
    """f(state) of a packed function."""
    f = F.col(function) if isinstance(function, str) else function
    powers = F.array(*[F.lit(STATES**s).cast("bigint") for s in range(STATES)])
    return F.pmod(F.call_function("div", f, F.element_at(powers, state + 1)), F.lit(STATES).cast("bigint")).cast("int")


def state_machine(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: str | Column,
    symbol: Column,
    next_state: Sequence[Sequence[int]],
    emit: Sequence[Sequence[bool]],
    start: int = 0,
    unknown: int | None = None,
) -> DataFrame:
    """A per-key finite state machine with output (Mealy machine) of at most ``STATES`` states.

    ``symbol`` maps each row to ``0..m-1``; ``next_state[sym][state]`` is the next state and
    ``emit[sym][state]`` says whether the row raises an alert. A row whose symbol is null counts as
    symbol ``unknown`` (default: the last one). Adds ``state_before``, ``state_after`` and ``alert``.

    The fold over a key's rows is an associative composition of functions on the few states.
    Each slice of a key is composed in one ordered pass (:func:`_scanned`); the slices' functions
    are composed by the same pass over one row per (key, slice), and give the state that enters
    each slice."""
    keys, order = list(keys), list(order)
    n_sym, states = len(next_state), len(next_state[0])
    if states > STATES:
        raise ValueError(f"at most {STATES} states")
    packed = [sum(int(f) * STATES**s for s, f in enumerate(row)) for row in next_state]
    emits = F.array(*[F.array(*[F.lit(bool(e)) for e in row]) for row in emit])
    sym = F.coalesce(symbol.cast("int"), F.lit(n_sym - 1 if unknown is None else unknown))
    kv, k_, sl = keyed.KV, keyed.K, keyed.SLICE
    d = keyed._keyed(df, keys, split).withColumn("_sym", sym)
    d = d.withColumn("_f", F.element_at(F.array(*[F.lit(p).cast("bigint") for p in packed]), F.col("_sym") + 1))
    rows = _scanned(d, kv, order, "_f", states)

    # a slice's function is that of its last row; state entering each slice by the same pass over slices
    here = F.struct(*[F.col(c) for c in order], F.col("_upto").alias("_upto"))
    whole = _scanned(d.select(kv, *order, "_f"), kv, order, "_f", states).groupBy(kv).agg(F.max(here)["_upto"].alias("_g"))
    carry = _scanned(keyed._per_slice(whole, keys, "_g"), k_, [sl], "_g", states).select(kv, _applied("_before", F.lit(start)).alias("_in"))
    rows = rows.join(carry, kv)
    rows = rows.withColumn("state_before", _applied("_before", F.col("_in"))).withColumn("state_after", _applied("_upto", F.col("_in")))
    rows = rows.withColumn("alert", F.element_at(F.element_at(emits, F.col("_sym") + 1), F.col("state_before") + 1))
    return rows.drop("_sym", "_f", "_upto", "_before", "_in", kv)


# The reference's login-failure machine.
# States: 0 = Initial, 1 = S1, 2 = S2. Symbols: 0 = fail, 1 = success, 2 = any other type.
# fail: Initial -> S1, S1 -> S2, S2 -> Matched (alert; the state stays S2).
# success: every state -> Terminal, which resets to Initial. Other types: back to Initial.
LOGIN_FAIL_NEXT = [[1, 2, 2], [0, 0, 0], [0, 0, 0]]
LOGIN_FAIL_EMIT = [[False, False, True], [False, False, False], [False, False, False]]
