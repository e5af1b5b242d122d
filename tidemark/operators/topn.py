"""Top-n (T01-T05, W12, A13 ranking).

Counting comes first (partial aggregation), ranking second. A ``row_number`` filtered by
``<= n`` is planned by Spark with ``WindowGroupLimit``: every map task keeps only its n best
rows per group before the shuffle, so a window with many keys ships n rows per task.
Ties are always broken by the key ascending (Q3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import keyed
from tidemark.operators.windows import window_count


def rank_within(
    df: DataFrame, part: Sequence[str], order: Sequence[Column], n: int | None = None, name: str = "rn"
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY part ORDER BY order)`` as bigint; with ``n``, only
    ranks ``<= n`` are kept."""
    r = df.withColumn(name, F.row_number().over(Window.partitionBy(*part).orderBy(*order)))
    if n is not None:
        r = r.filter(F.col(name) <= n)
    return r.withColumn(name, F.col(name).cast("bigint"))


def top_n_per_window(
    df: DataFrame, key: str, ts: str, size: str, slide: str | None, n: int, name: str = "cnt"
) -> DataFrame:
    """The n keys with the most rows per (tumbling or sliding) window."""
    counts = window_count(df, [key], ts, size, slide, name)
    return rank_within(counts, ["window_start", "window_end"], [F.col(name).desc(), F.col(key)], n)


def window_ranking(df: DataFrame, key: str, ts: str, size: str, slide: str | None, name: str = "cnt", hot_rows: int = 1_000_000) -> DataFrame:
    """The un-keyed window's key -> count map, as rows ranked by count desc, key asc
    (the reference's sorted list, one row per entry)."""
    counts = window_count(df, [key], ts, size, slide, name)
    return rank_by_count(counts, ["window_start", "window_end"], name, key, hot_rows)


def rank_by_count(counts: DataFrame, part: Sequence[str], name: str, key: str, hot_rows: int = 1_000_000) -> DataFrame:
    """Adds ``rn``: the rank within ``part`` by ``name`` (a count, descending), then ``key`` ascending.

    No task holds all keys of a group: a histogram says how many keys have each count (at most
    some sqrt(2 x rows) different counts a group), its running sum how many stand before a count, and
    only keys of the same count are numbered among themselves. Where more than ``hot_rows`` keys
    share a count they are cut into ranges of the key, with a carry between them."""
    part = list(part)
    same = F.struct(*[F.col(c) for c in part], F.col(name).alias("n")).alias("_s")
    h = counts.groupBy(*part, name).agg(F.count(F.lit(1)).alias("_k"))
    most = h.agg(F.max("_k")).first()[0] or 0
    split = keyed.value_split(counts, key) if most > hot_rows else F.lit(0)
    before = Window.partitionBy(*part).orderBy(F.col(name).desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.select(same, F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_before"))
    d = keyed.row_number(counts, [*part, name], [key], split, "_no").withColumn("_s", same).join(h, "_s")
    return d.withColumn("rn", (F.col("_before") + F.col("_no")).cast("bigint")).select(*counts.columns, "rn")


def top_n_window_all(df: DataFrame, key: str, ts: str, size: str, slide: str | None, n: int, name: str = "cnt") -> DataFrame:
    """The first n entries of the un-keyed window's ranking (A13); must equal T01."""
    return rank_within(window_count(df, [key], ts, size, slide, name), ["window_start", "window_end"], [F.col(name).desc(), F.col(key)], n)


def top_n_global(df: DataFrame, key: str, n: int, name: str = "cnt") -> DataFrame:
    """The n keys with the most rows overall. ``orderBy().limit()`` becomes
    ``TakeOrderedAndProject``: each task keeps n rows, the driver merges n x tasks rows."""
    top = df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(F.col(name).desc(), F.col(key)).limit(n)
    return top.withColumn("rn", F.row_number().over(Window.orderBy(F.col(name).desc(), F.col(key))).cast("bigint"))
