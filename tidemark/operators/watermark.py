"""Watermarks replayed in batch.

In a stream the watermark is ``max event time seen - bound``; the batch form replays it over
an explicit arrival order. A record sees the watermark built from the records *before* it
(the generator emits watermarks after records). The running maxima are slice-split scans
(:mod:`tidemark.operators.keyed`), so a source holding most of the data is not one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.durations import duration_us
from tidemark.functions.time import epoch_ms, epoch_us
from tidemark.operators import keyed


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union of same-typed inputs (by column name)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def watermark_trace(
    df: DataFrame,
    source: str,
    bounds: Mapping[str, str],
    order: Sequence[str],
    ts: str,
    split: str | Column,
    name: str = "watermark_ms",
) -> DataFrame:
    """The watermark of a union of inputs as each record sees it, in epoch ms.

    Each input's watermark is ``max(ts of its earlier records) - bound - 1 ms``; the union's
    is the least of them, null (no watermark yet) until every input has produced one."""
    aggs = {
        f"_m{i}": ("max", F.when(F.col(source) == s, epoch_ms(ts))) for i, s in enumerate(bounds)
    }
    r = keyed.running(df, [], order, split, aggs, inclusive=False)
    marks = [F.col(f"_m{i}") - duration_us(b) // 1000 - 1 for i, b in enumerate(bounds.values())]
    all_seen = F.lit(True)
    for i in range(len(bounds)):
        all_seen = all_seen & F.col(f"_m{i}").isNotNull()
    wm = F.when(all_seen, F.least(*marks) if len(marks) > 1 else marks[0])
    return r.withColumn(name, wm.cast("bigint")).drop(*aggs)


def late_route(
    df: DataFrame,
    source: str,
    order: Sequence[str],
    split: str | Column,
    et: str,
    size: str,
    bound: str,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Tag each record ``main`` or ``late`` for a tumbling window of ``size``.

    Per source, the watermark a record sees is ``max(event time of the source's earlier
    records) - bound``. The record is late when its window has closed for good:
    ``window_end + lateness <= watermark`` (the reference's window fires at ``end - 1 ms``
    against a watermark of ``max - bound - 1 ms``; the two 1 ms cancel). Rows with no
    watermark yet are on time. Adds ``window_start, window_end, watermark, route``."""
    lat = duration_us(lateness)
    r = keyed.running(df, [source], order, split, {"_mx": ("max", epoch_us(et))}, inclusive=False)
    wm = F.col("_mx") - duration_us(bound)
    w = F.window(et, size)
    r = r.withColumn("_w", w)
    late = F.coalesce(epoch_us(F.col("_w.end")) + lat <= wm, F.lit(False))
    return r.select(
        *[c for c in df.columns],
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        F.when(wm.isNotNull(), F.timestamp_micros(wm).cast("timestamp_ntz")).alias("watermark"),
        F.when(late, "late").otherwise("main").alias("route"),
    )
