"""Time and count windows (W01-W13, A08-A13 building blocks).

Window aggregates are ``groupBy(keys, window)``: Spark aggregates partially before the
shuffle, so a hot key or hot window costs one partial row per map task, not its rows.
Window bounds come back as the input's timestamp type (``timestamp_ntz`` for the driver's
tables), flattened to ``window_start`` / ``window_end``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.durations import duration_us
from tidemark.functions.time import epoch_us, floordiv
from tidemark.operators import keyed


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tumbling(ts: str | Column, size: str) -> Column:
    """Epoch-aligned ``[start, end)``."""
    return F.window(_c(ts), size)


def sliding(ts: str | Column, size: str, slide: str) -> Column:
    """Each row falls in ``size / slide`` windows."""
    return F.window(_c(ts), size, slide)


def session(ts: str | Column, gap: str) -> Column:
    """Rows at most ``gap`` apart share a session; ``end = last + gap``. All rows of a key are merged in
    one task; :func:`session_agg` does not."""
    return F.session_window(_c(ts), gap)


def window_agg(
    df: DataFrame, keys: Sequence[str], window: Column, aggs: Sequence[Column], bounds: bool = True
) -> DataFrame:
    """Aggregate per key and window (W05: window bounds in the output)."""
    g = df.groupBy(*keys, window.alias("w")).agg(*aggs)
    cols = [*keys]
    if bounds:
        cols += [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    return g.select(*cols, *[c for c in g.columns if c not in (*keys, "w")])


def window_count(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    size: str,
    slide: str | None = None,
    name: str = "cnt",
) -> DataFrame:
    """A08 / A12 / W01 / W02 / W06 (no keys): rows per key and window."""
    w = sliding(ts, size, slide) if slide else tumbling(ts, size)
    return window_agg(df, keys, w, [F.count(F.lit(1)).alias(name)])


def session_count(df: DataFrame, keys: Sequence[str], ts: str, gap: str, name: str = "cnt", split: str | Column | None = None) -> DataFrame:
    """Rows per key and session window; see :func:`session_agg`."""
    return session_agg(df, keys, ts, gap, {name: ("count", None)}, split)


#: What an aggregate does with rows, and with its own partial results.
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def _firsts(aggs: dict[str, tuple[str, str | Column | None]]) -> list[Column]:
    return [_FIRST[kind](F.lit(1) if kind == "count" else _c(expr)).alias(n) for n, (kind, expr) in aggs.items()]


def session_agg(
    df: DataFrame, keys: Sequence[str], ts: str, gap: str, aggs: dict[str, tuple[str, str | Column | None]], split: str | Column | None = None
) -> DataFrame:
    """Aggregates (name -> (count / sum / min / max, expression)) per key and session: rows at most
    ``gap`` apart, ``window_end`` = last row + gap.

    Spark's session window sorts all rows of a key in one task. With a ``split`` that is monotone
    in ``ts`` (:func:`keyed.hot_split`), sessions are made per (key, slice); only a slice's first and last
    session can reach into a neighbour, so these, at most two a slice, are merged in order of
    time, and the others are final. Rows without a time are in no session."""
    keys = list(keys)
    by = [F.col(k) for k in keys] + ([] if split is None else [_c(split).alias("_sl")])
    g = df.groupBy(*by, session(ts, gap).alias("w")).agg(*_firsts(aggs))
    bounds = [F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")]
    out = [*keys, "window_start", "window_end", *aggs]
    if split is None:
        return g.select(*keys, *bounds, *aggs)
    w = Window.partitionBy(*keys, "_sl")
    s = g.select(*keys, "_sl", *bounds, *aggs)
    s = s.withColumn("_edge", (F.col("window_start") == F.min("window_start").over(w)) | (F.col("window_end") == F.max("window_end").over(w)))
    before = Window.partitionBy(*keys).orderBy("window_start")
    e = s.filter("_edge").withColumn("_reach", F.max("window_end").over(before.rowsBetween(Window.unboundedPreceding, -1)))
    e = e.withColumn("_no", F.sum(F.when(F.col("window_start") <= F.col("_reach"), 0).otherwise(1)).over(before.rowsBetween(Window.unboundedPreceding, 0)))
    merged = e.groupBy(*keys, "_no").agg(
        F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"), *[_MERGE[kind](n).alias(n) for n, (kind, _) in aggs.items()]
    )
    return s.filter("not _edge").select(*out).unionByName(merged.select(*out))


def cumulate(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    step: str,
    max_size: str,
    aggs: Sequence[Column] | dict[str, tuple[str, str | Column | None]],
) -> DataFrame:
    """CUMULATE windows. All windows of one period share its start (the tumbling window
    of ``max_size``); their ends grow by ``step``. A row at offset ``o`` inside the period
    belongs to the windows ending at steps ``floor(o / step) + 1 .. max / step``.

    ``aggs`` as a mapping (name -> (count / sum / min / max, expression)) aggregates each row once, into its
    step's pane; a window is the merge of the panes up to its end, over at most ``max / step``
    rows. A list of any other aggregates, and a stream, send each row to all its windows; there
    the grouping keeps the period window column, so a stream's watermark still applies."""
    step_us, max_us = duration_us(step), duration_us(max_size)
    if max_us % step_us:
        raise ValueError("max_size must be a multiple of step")
    n = max_us // step_us
    w = F.window(_c(ts), max_size)
    if isinstance(aggs, dict):
        if not df.isStreaming:
            return _panes(df, list(keys), ts, w, step_us, n, aggs)
        aggs = _firsts(aggs)
    d = df.withColumn("_w", w).withColumn(
        "_k",
        F.explode(
            F.sequence(
                (floordiv(epoch_us(ts) - epoch_us(F.col("_w.start")), step_us) + 1).cast("int"),
                F.lit(n).cast("int"),
            )
        ),
    )
    g = d.groupBy(*keys, "_w", "_k").agg(*aggs)
    end = F.timestamp_micros(epoch_us(F.col("_w.start")) + F.col("_k").cast("bigint") * F.lit(step_us))
    ntz = df.schema[ts].dataType.typeName() == "timestamp_ntz"
    return g.select(
        *keys,
        F.col("_w.start").alias("window_start"),
        (end.cast("timestamp_ntz") if ntz else end).alias("window_end"),
        *[c for c in g.columns if c not in (*keys, "_w", "_k")],
    )


def _panes(df: DataFrame, keys: list[str], ts: str, w: Column, step_us: int, n: int, aggs: dict[str, tuple[str, str | Column | None]]) -> DataFrame:
    d = df.withColumn("_w", w)
    d = d.withColumn("_k", (floordiv(epoch_us(ts) - epoch_us(F.col("_w.start")), step_us) + 1).cast("int"))
    p = d.groupBy(*keys, "_w", "_k").agg(*_firsts(aggs))
    so_far = Window.partitionBy(*keys, "_w").orderBy("_k")
    p = p.withColumn("_next", F.coalesce(F.lead("_k").over(so_far), F.lit(n + 1)))
    for name, (kind, _) in aggs.items():
        p = p.withColumn(name, _MERGE[kind](name).over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    # a window that ends in steps without rows has the value of the last pane before
    p = p.withColumn("_k", F.explode(F.sequence("_k", F.col("_next") - 1)))
    end = F.timestamp_micros(epoch_us(F.col("_w.start")) + F.col("_k").cast("bigint") * F.lit(step_us))
    ntz = df.schema[ts].dataType.typeName() == "timestamp_ntz"
    return p.select(*keys, F.col("_w.start").alias("window_start"), (end.cast("timestamp_ntz") if ntz else end).alias("window_end"), *aggs)


def count_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: str | Column,
    size: int,
    slide: int,
    value: str,
) -> DataFrame:
    """Sliding count window of ``size`` rows, firing every ``slide`` rows of a key.

    At every ``slide``-th row ``e`` of a key (1-based position) it yields the rows
    ``e-size+1 .. e`` (fewer at the start): ``frame_rows``, ``frame_sum`` of ``value``, and the
    first and last position. Each row is sent to the at most ``ceil(size/slide)`` firings that
    contain it, then grouped: groups hold at most ``size`` rows whatever the key's size."""
    d = keyed.row_number(df, keys, order, split, "_pos")
    first_e = F.ceil(F.col("_pos") / slide) * slide
    last_e = (F.col("_pos") + size - 1).cast("bigint")
    fires = F.when(
        first_e <= last_e, F.sequence(first_e.cast("bigint"), last_e, F.lit(slide).cast("bigint"))
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("fire_pos", F.explode(fires))
    g = d.groupBy(*keys, "fire_pos").agg(
        F.count(F.lit(1)).alias("frame_rows"),
        F.sum(value).alias("frame_sum"),
        F.min("_pos").alias("frame_first"),
        F.max("_pos").alias("frame_last"),
    )
    # a firing exists only if its own row exists, i.e. it is the frame's last row
    return g.filter(F.col("frame_last") == F.col("fire_pos")).drop("frame_last")


def integer_division_window(
    df: DataFrame, keys: Sequence[str], ts_ms: str, size_ms: int, name: str = "cnt"
) -> DataFrame:
    """The hand-made tumbling window — start = ``ts / size * size`` on epoch ms
    (F10), one counter per key and start, closing at ``start + size``. Same answer as
    :func:`window_count` with a tumbling window."""
    start = floordiv(ts_ms, size_ms) * size_ms
    g = df.groupBy(*keys, start.alias("_start")).agg(F.count(F.lit(1)).alias(name))
    return g.select(
        *keys,
        F.timestamp_millis("_start").cast("timestamp_ntz").alias("window_start"),
        F.timestamp_millis(F.col("_start") + size_ms).cast("timestamp_ntz").alias("window_end"),
        name,
    )


def rows_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, value: str, rows: int, name: str = "avg"
) -> DataFrame:
    """``avg(value) OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN rows-1 PRECEDING
    AND CURRENT ROW)`` as an integer mean (``sum div count``, the reference's BIGINT average).
    The frame's earlier rows come from the slice-split look-back, so a hot key is not one task."""
    k = rows - 1
    r = keyed.lag(df, keys, order, split, [value], k, "_w") if k else df
    vals = [F.col(value)] + [F.col(f"_w{j}_{value}") for j in range(1, k + 1)]
    s = sum((F.coalesce(v, F.lit(0)) for v in vals), F.lit(0))
    n = sum((v.isNotNull().cast("bigint") for v in vals), F.lit(0))
    out = r.withColumn("_s", s).withColumn("_n", n).withColumn(name, F.expr("_s div _n"))
    return out.drop("_s", "_n", *[f"_w{j}_{value}" for j in range(1, k + 1)])
