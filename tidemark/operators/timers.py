"""Timers in batch form (X01, X03). The streaming forms are in :mod:`tidemark.streaming.stateful`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.durations import duration_us
from tidemark.functions.time import ceildiv, epoch_us, floordiv


def _as_ts(us, like: DataFrame, ts: str):
    t = F.timestamp_micros(us)
    return t.cast("timestamp_ntz") if like.schema[ts].dataType.typeName() == "timestamp_ntz" else t


def event_timer(df: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """Every row is emitted on arrival (``kind='arrival'``); a timer registered at
    ``ts + delay`` fires once per key and distinct fire time (``kind='timer'``).
    Output ``key, kind, at``."""
    d = duration_us(delay)
    arrivals = df.select(key, F.lit("arrival").alias("kind"), F.col(ts).alias("at"))
    timers = df.select(key, _as_ts(epoch_us(ts) + d, df, ts).alias("at")).distinct()
    return arrivals.unionByName(timers.select(key, F.lit("timer").alias("kind"), "at"))


def periodic_count(df: DataFrame, key: str, ts: str, period: str, until=None) -> DataFrame:
    """Per key, starting at its first row ``t0``, a timer every ``period`` reports the
    key's cumulative row count up to the timer (rows with ``ts <= tick``). Ticks stop at
    ``until`` (default: the input's last ``ts``, the last watermark of a bounded run).

    Each row goes to the first tick at or after it (``ceil((ts - t0) / period)``); the rows
    are counted per (key, tick index), a table with one row per key and period. A running
    sum over that table gives the count at each index, which holds for every tick up to the
    next index that has rows, so the ticks are generated from it directly."""
    p = duration_us(period)
    if until is None:
        until = df.agg(F.max(ts)).first()[0]
    # each row needs its key's start, null keys included; AQE picks the join by run-time size and
    # splits a hot key's partition
    t0 = df.groupBy(F.struct(key).alias("_k")).agg(F.min(ts).alias("_t0"))
    rows = df.select(key, ts, F.struct(key).alias("_k")).join(t0, "_k").drop("_k")
    idx = ceildiv(epoch_us(ts) - epoch_us("_t0"), p)
    # counted per (key, tick index) with partial aggregation before the shuffle
    per = rows.groupBy(key, "_t0", idx.alias("k")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy("k")
    last = floordiv(epoch_us(F.lit(until)) - epoch_us("_t0"), p)
    per = per.withColumn("_cum", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "_to", F.least(F.coalesce(F.lead("k", 1).over(w) - 1, last), last)
    )
    ticks = per.withColumn("_from", F.greatest(F.col("k"), F.lit(1).cast("bigint"))).filter(F.col("_from") <= F.col("_to"))
    ticks = ticks.select(key, "_t0", "_cum", F.explode(F.sequence("_from", "_to")).alias("_j"))
    return ticks.select(key, _as_ts(epoch_us("_t0") + F.col("_j") * p, df, ts).alias("tick"), F.col("_cum").cast("bigint").alias("pv"))
