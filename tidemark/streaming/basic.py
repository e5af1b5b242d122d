"""Streaming forms built from Spark's own stateful operators (L01-L06, U01, W01-W10, T01,
J01, J03, J04, A02, A14, K05).

Watermarks need ``timestamp`` (not ``timestamp_ntz``) columns, so :func:`event_time` makes
``et`` a ``timestamp``; window bounds are cast back to ``timestamp_ntz`` on output so they
compare with the batch forms. The watermark moves once per micro-batch (the reference moves
it per record every 100 ms): final results agree, intermediate emissions may not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import duration_us


def event_time(df: DataFrame, delay: str = "0 seconds", ts: str = "ts", ms: str | None = None, et: str = "et") -> DataFrame:
    """L01 / L02 (delay 0) / L03 / L04: the event-time column with a bounded-out-of-orderness
    watermark. ``ms`` names an epoch-millisecond column to convert (F08); otherwise ``ts``
    (timestamp or timestamp_ntz) is used."""
    col = F.timestamp_millis(F.col(ms)) if ms else F.col(ts).cast("timestamp")
    return df.withColumn(et, col).withWatermark(et, delay)


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def window_counts(
    df: DataFrame,
    keys: Sequence[str],
    et: str,
    size: str,
    slide: str | None = None,
    name: str = "cnt",
) -> DataFrame:
    """A08 / A12 / W01 / W02 / W06 on a stream. The caller's watermark delay is the bound plus
    the allowed lateness (L06): in ``update`` mode a window is first emitted when it closes
    and re-emitted for every late row until the watermark passes ``end + lateness``; in
    ``append`` mode only the final count appears."""
    w = F.window(et, size, slide) if slide else F.window(et, size)
    g = df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias(name))
    return g.select(*keys, _ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"), name)


def session_counts(df: DataFrame, keys: Sequence[str], et: str, gap: str, name: str = "cnt") -> DataFrame:
    """W03 on a stream (append / update)."""
    g = df.groupBy(*keys, F.session_window(et, gap).alias("w")).agg(F.count(F.lit(1)).alias(name))
    return g.select(*keys, _ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"), name)


def top_n(df: DataFrame, key: str, et: str, size: str, slide: str | None, n: int, name: str = "cnt") -> DataFrame:
    """T01 / T02 on a stream: a window count, then a second window aggregate over the first
    one's ``window_time`` that keeps the n best ``(count desc, key asc)`` of each window.
    Works in ``append`` mode (chained stateful operators); the per-window list holds the
    window's distinct keys after the first aggregation."""
    w = F.window(et, size, slide) if slide else F.window(et, size)
    c = df.groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias(name))
    c = c.select(key, name, F.col("w.start").alias("ws"), F.col("w.end").alias("we"), F.window_time("w").alias("wt"))
    top = c.groupBy("wt", "ws", "we").agg(
        F.slice(F.sort_array(F.collect_list(F.struct((-F.col(name)).alias("neg"), F.col(key).alias("k")))), 1, n).alias("top")
    )
    return top.select(
        _ntz(F.col("ws")).alias("window_start"), _ntz(F.col("we")).alias("window_end"), F.posexplode("top").alias("pos", "t")
    ).select(
        "window_start", "window_end", F.col("t.k").alias(key), (-F.col("t.neg")).alias(name), (F.col("pos") + 1).cast("bigint").alias("rn")
    )


def interval_join(
    left: DataFrame, right: DataFrame, key: str, l_et: str, r_et: str, lower: str, upper: str, how: str = "inner"
) -> DataFrame:
    """J03 on streams: both inputs watermarked; the range bounds let Spark drop state once
    the watermark passes them. ``how='fullouter'`` with a range gives the reconciliation's
    one-sided rows once their partner can no longer arrive (J05)."""
    lo, hi = duration_us(lower), duration_us(upper)
    l, r = left.alias("l"), right.alias("r")
    cond = (
        (F.col(f"l.{key}") == F.col(f"r.{key}"))
        & (F.col(f"r.{r_et}") >= F.col(f"l.{l_et}") + F.expr(f"INTERVAL {lo} MICROSECONDS"))
        & (F.col(f"r.{r_et}") <= F.col(f"l.{l_et}") + F.expr(f"INTERVAL {hi} MICROSECONDS"))
    )
    return l.join(r, cond, how)


def window_join(left: DataFrame, right: DataFrame, key: str, l_et: str, r_et: str, size: str) -> DataFrame:
    """J01 on streams: equi-join on key and the tumbling window of both sides. A stream may
    carry one event-time column, so the window is kept as that column and the rows' own event
    times are returned as plain ``timestamp_ntz`` values."""
    lw = left.withColumn("_w", F.window(l_et, size)).withColumn(l_et, _ntz(F.col(l_et)))
    rw = right.withColumn("_w", F.window(r_et, size)).withColumn(r_et, _ntz(F.col(r_et)))
    j = lw.join(rw, [key, "_w"])
    rest = [c for c in j.columns if c not in (key, "_w")]
    return j.select(key, _ntz(F.col("_w.start")).alias("window_start"), _ntz(F.col("_w.end")).alias("window_end"), *rest)


def unbounded_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """J04 on streams: an inner equi-join with no time bound. Spark allows it; every row of
    both sides stays in the join state for ever (the reference keeps them in list state),
    so it is only for inputs whose key space and lifetime are bounded."""
    return left.join(right, on)


def union(*dfs: DataFrame) -> DataFrame:
    """The union's watermark is the minimum of its inputs' (Spark's default policy)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def running_counts(df: DataFrame, keys: Sequence[str], name: str = "cnt") -> DataFrame:
    """A02 / A06 / A14 on a stream: counts per key, emitted per trigger in ``update`` mode
    (the reference emits per record)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def watermark_ms(query) -> int | None:
    """U02 on a stream: the current watermark of a running query, epoch ms."""
    p = query.lastProgress
    wm = (p or {}).get("eventTime", {}).get("watermark")
    if not wm:
        return None
    import datetime as _dt

    t = _dt.datetime.strptime(wm, "%Y-%m-%dT%H:%M:%S.%fZ").replace(tzinfo=_dt.timezone.utc)
    return int(t.timestamp() * 1000)


def distinct_counts(df: DataFrame, keys: Sequence[str], et: str, size: str, col: str, slide: str | None = None, exact: bool = True, name: str = "uv") -> DataFrame:
    """A10 / A11 on a stream. Spark refuses ``count(distinct)`` in streaming aggregations; the exact form is two
    stages, for append mode: each (key, window, member) is a state of its own, and once the window closes
    its members are counted. A hot window's members are spread over the store, none is one value in
    one task. Null members do not count; a window of null members only has 0. ``exact=False`` uses
    ``approx_count_distinct`` (fixed-size sketch) in one stage."""
    w = F.window(et, size, slide) if slide else F.window(et, size)
    bounds = [_ntz(F.col("ws")).alias("window_start"), _ntz(F.col("we")).alias("window_end")]
    if not exact:
        g = df.groupBy(*keys, w.alias("w")).agg(F.approx_count_distinct(col).cast("bigint").alias(name))
        return g.withColumn("ws", F.col("w.start")).withColumn("we", F.col("w.end")).select(*keys, *bounds, name)
    c = df.groupBy(*keys, w.alias("w"), F.col(col).alias("_member")).agg(F.count(F.lit(1)).alias("_n"))
    c = c.select(*keys, "_member", F.col("w.start").alias("ws"), F.col("w.end").alias("we"), F.window_time("w").alias("wt"))
    g = c.groupBy(*keys, "wt", "ws", "we").agg(F.count("_member").cast("bigint").alias(name))
    return g.select(*keys, *bounds, name)
