"""Skew-safe keyed scans over an explicit order.

Keyed, order-sensitive state (running counts, previous rows, the next matching row) is
what the reference keeps per key in value/list state. A plain ``Window.partitionBy(key)``
gives it the same meaning but sends every row of a key to one task, so one hot key holding
a third of the data becomes one giant task.

Here each key is cut into *slices*: ``split`` is a column that is monotone in the order
(a time bucket such as ``F.window(ts, '1 day').start``, or a document id). The row-level work
runs in ``(key, slice)`` window partitions; what crosses slice borders is carried by a small
table with one row per ``(key, slice)`` (or ``k`` rows for a k-step look-back), so its size is
bounded by the number of slices, not by the number of rows of the key.

Plan shape: the rows are shuffled once by ``(key, slice)`` and windowed there. The per-slice
table is a grouped aggregate (partial per map task, no sort) for running aggregates and the
next match, and the last rows of each windowed slice for look-backs and run lengths; it is
small and joins back on the same ``(key, slice)`` partitioning, so the rows are not shuffled
again. The input is evaluated twice (rows and per-slice table): cheap for a columnar scan,
worth a written intermediate for an expensive derived input. Keys and slice are packed into
one struct column ``KV``: a struct is never null, so Catalyst infers no ``isnotnull`` filter,
and null keys are grouped like any other key. ``order`` columns are taken ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_us

SLICE = "_tm_slice"
KV = "_tm_kv"  # struct(keys..., slice)
K = "_tm_k"  # struct(keys...)

_AGG = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [_col(c) for c in cs]


def _keyed(df: DataFrame, keys: Sequence[str], split: str | Column) -> DataFrame:
    """Adds the struct ``KV = (keys..., slice)``, the only extra column carried per row."""
    return df.withColumn(KV, F.struct(*[F.col(k) for k in keys], _col(split).alias(SLICE)))


def _per_slice(d: DataFrame, keys: Sequence[str], *cols: str | Column) -> DataFrame:
    """Columns of the per-slice table: ``KV``, the key-only struct ``K`` and ``SLICE``."""
    return d.select(
        KV, F.struct(*[F.col(f"{KV}.{k}") for k in keys]).alias(K), F.col(f"{KV}.{SLICE}").alias(SLICE), *cols
    )


def _drop(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(SLICE, KV, K, *cols)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    split: str | Column,
    aggs: dict[str, tuple[str, str | Column | None]],
    inclusive: bool = True,
    once: bool = False,
) -> DataFrame:
    """Running aggregates per key in ``order`` (``inclusive=False``: rows strictly before).

    ``once``: the per-slice totals are taken from the shuffled rows (one exchange, used twice)
    instead of from a second evaluation of the input; for inputs that are expensive to make.

    ``aggs`` maps an output name to ``(kind, expr)`` with kind in count/sum/min/max
    (``expr`` ignored for count). min/max accept structs, so ``("min", struct(ts, id, x))``
    is the running *first* row. With no ``keys`` the whole input is one sequence, still cut
    into slices; the per-slice table then has one row per slice.

    Plain counts carry the keys in ``KV`` only: a shuffled and sorted row has each of them once.
    """
    keys = list(keys)
    d = _keyed(df, keys, split)
    once_each = all(kind == "count" for kind, _ in aggs.values()) and all(isinstance(c, str) and c not in keys for c in order)
    if once_each:
        d = d.drop(*keys)
    if once:
        d = d.repartition(KV)
    w = Window.partitionBy(KV).orderBy(*_cols(order))
    w_in = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    w_sl = Window.partitionBy(K).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)

    totals, prefix = [], []
    for name, (kind, expr) in aggs.items():
        e = F.lit(1) if kind == "count" else _col(expr)
        totals.append(_AGG[kind](e).alias(f"_t_{name}"))
        carry = "sum" if kind in ("count", "sum") else kind
        prefix.append(_AGG[carry](F.col(f"_t_{name}")).over(w_sl).alias(f"_p_{name}"))
    # slice totals: a grouped aggregate, partial per map task (no sort of the rows)
    offsets = _per_slice(d.groupBy(KV).agg(*totals), keys, *[f"_t_{n}" for n in aggs]).select(KV, *prefix)
    for name, (kind, expr) in aggs.items():
        e = F.lit(1) if kind == "count" else _col(expr)
        d = d.withColumn(f"_i_{name}", _AGG[kind](e).over(w_in))
    out = d.join(offsets, KV, "left")
    for name, (kind, _) in aggs.items():
        i, p = F.col(f"_i_{name}"), F.col(f"_p_{name}")
        if kind == "count":
            v = F.coalesce(i, F.lit(0)) + F.coalesce(p, F.lit(0))
        elif kind == "sum":  # null until a non-null value was seen, as SQL's sum
            v = F.when(i.isNull() & p.isNull(), F.lit(None)).otherwise(F.coalesce(i, F.lit(0)) + F.coalesce(p, F.lit(0)))
        elif kind == "min":
            v = F.least(i, p)
        else:
            v = F.greatest(i, p)
        out = out.withColumn(name, v).drop(f"_i_{name}", f"_p_{name}")
    if once_each:
        out = out.select(*[F.col(KV).getField(c).alias(c) if c in keys else F.col(f"`{c}`") for c in df.columns], *aggs)
    return _drop(out)


def row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], split: str | Column, name: str = "rn", once: bool = False
) -> DataFrame:
    """1-based position of each row within its key (bigint)."""
    return running(df, keys, order, split, {name: ("count", None)}, once=once)


def positions(
    df: DataFrame,
    keys: Sequence[str],
    parts: Sequence[str],
    order: Sequence[str | Column],
    split: str | Column,
    name: str,
    sizes: dict[str, Column],
) -> DataFrame:
    """1-based position of each row within its keys and ``parts`` (columns that divide a key's rows), and
    how many rows of the whole key fulfil each of ``sizes`` (name -> condition). Rows are shuffled once;
    both come from one table of a row per (key, part, slice)."""
    keys, parts = list(keys), list(parts)
    d = _keyed(df, [*keys, *parts], split)
    whole = Window.partitionBy(F.struct(*[F.col(f"{KV}.{k}") for k in keys]))
    before = Window.partitionBy(K).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per = d.groupBy(KV).agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(c, 1)).alias(f"_s_{n}") for n, c in sizes.items()])
    per = _per_slice(per, [*keys, *parts], "_n", *[f"_s_{n}" for n in sizes])
    per = per.select(KV, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), *[F.sum(f"_s_{n}").over(whole).alias(n) for n in sizes])
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(KV).orderBy(*_cols(order))))
    return _drop(d.join(per, KV).withColumn(name, F.col("_rn") + F.col("_before")), "_rn", "_before")


def lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    split: str | Column,
    cols: Sequence[str],
    k: int = 1,
    prefix: str = "prev",
) -> DataFrame:
    """Adds ``{prefix}{j}_{c}``: column ``c`` of the j-th previous row of the same key, j=1..k.

    Inside a slice this is ``F.lag``. For the first ``k`` rows of a slice the missing rows
    come from a *halo*: the last ``k`` rows before the slice, gathered from the last ``k``
    rows of each earlier slice (a table of at most ``k`` rows per key and slice).
    """
    keys, cols = list(keys), list(cols)
    d = _keyed(df, keys, split)
    w = Window.partitionBy(KV).orderBy(*_cols(order))
    d = d.withColumn("_rn", F.row_number().over(w)).withColumn("_tail", F.lead(F.lit(1), k).over(w).isNull())
    for j in range(1, k + 1):
        for c in cols:
            d = d.withColumn(f"_l{j}_{c}", F.lag(c, j).over(w))

    # last k rows of every (key, slice), then the halo each later slice needs: a tail row
    # belongs to the halo of slice b when one of the next k tail rows is b's first one
    tail = _per_slice(d.filter("_tail"), keys, "_rn", *cols)
    wt = Window.partitionBy(K).orderBy(SLICE, "_rn")
    tail = tail.withColumn("_first", F.coalesce(F.lag(SLICE, 1).over(wt) != F.col(SLICE), F.lit(True)))
    targets = F.array(
        *[
            F.when(F.lead("_first", j).over(wt) & (F.lead(SLICE, j).over(wt) != F.col(SLICE)), F.lead(SLICE, j).over(wt))
            for j in range(1, k + 1)
        ]
    )
    halo = (
        tail.withColumn("_targets", targets)
        .withColumn("_target", F.explode(F.filter("_targets", lambda x: x.isNotNull())))
        .groupBy(K, "_target")
        .agg(F.sort_array(F.collect_list(F.struct(SLICE, "_rn", *cols))).alias("_halo"))
        .select(F.struct(*[F.col(f"{K}.{kk}") for kk in keys], F.col("_target").alias(SLICE)).alias(KV), "_halo")
    )
    out = d.join(halo, KV, "left")
    for j in range(1, k + 1):
        idx = F.size("_halo") - F.lit(j) + F.col("_rn")
        from_halo = F.when(F.col("_halo").isNotNull() & (idx >= 1), F.try_element_at("_halo", idx.cast("int")))
        for c in cols:
            out = out.withColumn(
                f"{prefix}{j}_{c}",
                F.when(F.col("_rn") > j, F.col(f"_l{j}_{c}")).otherwise(from_halo.getField(c)),
            ).drop(f"_l{j}_{c}")
    return _drop(out, "_rn", "_tail", "_halo")


def next_match(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: str | Column,
    is_target: Column,
    cols: Sequence[str],
    name: str = "next",
) -> DataFrame:
    """Adds struct column ``name``: the first later row of the same key (strictly after in
    ``order``) for which ``is_target`` holds, with fields ``order + cols``; null if none.

    Inside a slice: a running min over the reversed order. Across slices: the first target
    of every later slice, from a table with one row per (key, slice).
    """
    keys, order, cols = list(keys), list(order), list(cols)
    fields = list(dict.fromkeys(order + cols))
    d = _keyed(df, keys, split).withColumn("_cand", F.when(is_target, F.struct(*fields)))
    w_rev = Window.partitionBy(KV).orderBy(*[F.col(c).desc() for c in order])
    w_sl = Window.partitionBy(K).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    # the first target of every slice: a grouped aggregate, partial per map task
    later = _per_slice(d.groupBy(KV).agg(F.min("_cand").alias("_first")), keys, "_first").select(
        KV, F.min("_first").over(w_sl).alias("_later")
    )
    d = d.withColumn("_in", F.min("_cand").over(w_rev.rowsBetween(Window.unboundedPreceding, -1)))
    out = d.join(later, KV, "left").withColumn(name, F.coalesce("_in", "_later"))
    return _drop(out, "_cand", "_in", "_later")


def run_length(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    split: str | Column,
    pred: Column,
    name: str = "run",
) -> DataFrame:
    """Adds ``name``: how many rows in a row, ending at this one, satisfy ``pred`` within the
    key (0 where ``pred`` is false). Gaps-and-islands in one pass: inside a slice the run
    starts after the last breaking row; a run reaching back to the slice start adds the run
    carried in from earlier slices, computed on a table with one row per (key, slice)."""
    keys = list(keys)
    d = _keyed(df, keys, split).withColumn("_ok", F.coalesce(pred, F.lit(False)))
    w = Window.partitionBy(KV).orderBy(*_cols(order))
    d = (
        d.withColumn("_rn", F.row_number().over(w))
        .withColumn("_brk", F.max(F.when(~F.col("_ok"), F.col("_rn"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_last", F.lead(F.lit(1), 1).over(w).isNull())
    )
    # per slice: its size and its last break (the running values at its last row)
    per = _per_slice(d.filter("_last"), keys, F.col("_rn").alias("_n"), F.col("_brk").alias("_last_brk"))
    w_prev = Window.partitionBy(K).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_n").over(w_prev), F.lit(0)))
    # the last earlier slice with a break: rows after its last break run on to this slice
    per = per.withColumn(
        "_b",
        F.max(
            F.when(
                F.col("_last_brk").isNotNull(),
                F.struct(F.col(SLICE), (F.col("_before") + F.col("_last_brk")).alias("pos")),
            )
        ).over(w_prev),
    )
    carry = per.select(KV, (F.col("_before") - F.coalesce(F.col("_b.pos"), F.lit(0))).alias("_carry"))
    run = (
        F.when(~F.col("_ok"), F.lit(0))
        .when(F.col("_brk").isNotNull(), F.col("_rn") - F.col("_brk"))
        .otherwise(F.col("_rn") + F.col("_carry"))
    )
    out = d.join(carry, KV, "left").withColumn(name, run.cast("bigint"))
    return _drop(out, "_ok", "_rn", "_brk", "_last", "_carry")


SEGMENTS = 32
BUCKETS = 1 << 16


def _slices(v: Column, borders: Sequence[int], per: int) -> Column:
    """A number that grows with ``v``: ``per`` slices between each two ``borders``, one before
    and one after them, and one (the first) for null."""
    out = F.lit(1 + (len(borders) - 1) * per)
    for i in reversed(range(len(borders) - 1)):
        lo, hi = borders[i], borders[i + 1]
        part = F.floor((v - F.lit(lo)) / F.lit(float(hi - lo)) * F.lit(per))
        out = F.when(v < F.lit(hi), F.lit(1 + i * per) + F.least(part, F.lit(per - 1))).otherwise(out)
    if borders:
        out = F.when(v < F.lit(borders[0]), F.lit(0)).otherwise(out)
    return F.when(v.isNull(), F.lit(-1)).otherwise(out).cast("bigint")


def time_split(df: DataFrame, ts: str) -> Column:
    """A ``split`` sized from the data: about sqrt(rows) slices whose borders follow the spread of
    ``ts`` (approximate quantiles of its microseconds, even slices between them), so neither
    an outlier nor rows within a second make one slice of everything. A null ``ts`` sorts
    first and has a slice of its own. Costs one aggregate over one column; rows of the very
    same ``ts`` stay together."""
    import math

    v = epoch_us(ts)
    probs = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    n, found = df.agg(F.count(F.lit(1)), F.percentile_approx(v, probs, 10_000)).first()
    borders = sorted(set(found or []))
    return _slices(v, borders, max(int(math.sqrt(n or 0) / max(len(borders) - 1, 1)), 1))


def range_split(df: DataFrame, col: str, rows: int | None = None) -> Column:
    """A ``split`` over an integer ordering column: ranges of ``span / sqrt(rows)`` values
    (``rows`` defaults to the row count of ``df``); see :func:`time_split`."""
    import math

    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(F.lit(1))).first()
    n = rows or n
    if not n or lo is None:
        return F.lit(0).cast("bigint")
    width = max(int((hi - lo + 1) / math.sqrt(n)), 1)
    x = F.col(col).cast("bigint")
    wl = F.lit(width).cast("bigint")
    return F.call_function("div", x - F.pmod(x, wl), wl)


def value_split(df: DataFrame, col: str) -> Column:
    """A ``split`` that is monotone in any ordered column: a number, a time, or a string (by its first
    seven bytes); see :func:`time_split`. Equal values, and strings with equal beginnings, stay together."""
    import math

    kind = df.schema[col].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        v = epoch_us(col)
    elif kind in ("string", "binary"):
        v = F.conv(F.rpad(F.hex(F.substring(F.col(col).cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("bigint")
    else:
        v = F.floor(F.col(col).cast("double")).cast("bigint")
    n, found = df.agg(F.count(F.lit(1)), F.percentile_approx(v, [i / SEGMENTS for i in range(SEGMENTS + 1)], 10_000)).first()
    borders = sorted(set(found or []))
    return _slices(v, borders, max(int(math.sqrt(n or 0) / max(len(borders) - 1, 1)), 1))


def hot(df: DataFrame, key: str, hot_rows: int | None = None) -> Column | None:
    """Whether a row's key shares a hash bucket with more than ``hot_rows`` rows (default: sqrt(rows), and four
    times the mean of a bucket at least); None if no key does. Buckets are counted with one partial
    aggregate; their number is fixed, so any number of keys may be hot. A null key is a key like
    any other, and a cold key in a hot bucket counts as hot."""
    import math

    at = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    counts = {r["b"]: r["n"] for r in df.groupBy(at.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    threshold = hot_rows or max(math.isqrt(n), 4 * n // BUCKETS, 1)
    marks = bytearray(BUCKETS)
    for b, m in counts.items():
        marks[b] = m > threshold
    return F.substring(F.lit(marks), (at + 1).cast("int"), 1) == F.lit(bytearray(b"\x01")) if any(marks) else None


def hot_split(df: DataFrame, key: str, ts: str, hot_rows: int | None = None) -> Column:
    """A ``split`` that slices only hot keys (:func:`hot`): they get the slices of :func:`time_split`, every
    other key one slice, so the per-slice table stays about one row per key."""
    is_hot = hot(df, key, hot_rows)
    if is_hot is None:
        return F.lit(0).cast("bigint")  # no hot key: one slice per key, one small job
    return F.when(is_hot, time_split(df.filter(is_hot), ts)).otherwise(F.lit(0).cast("bigint"))
