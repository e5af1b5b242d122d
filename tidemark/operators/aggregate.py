"""Keyed and global aggregates.

Final aggregates are ``groupBy().agg()`` with Spark's partial (map-side) aggregation. Running
forms ("emit on every input") go through :mod:`tidemark.operators.keyed`, which splits hot
keys into slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import java_split
from tidemark.operators import keyed


def tokens(lines: DataFrame, text: str, sep: str = " ", pos: str = "pos", word: str = "word") -> DataFrame:
    """One row per token of ``text`` split as Java's ``String.split`` does."""
    keep = [c for c in lines.columns if c != text]
    return lines.select(*keep, F.posexplode(java_split(F.col(text), sep)).alias(pos, word)).withColumn(
        pos, (F.col(pos) + 1).cast("bigint")
    )


def word_count(lines: DataFrame, text: str, sep: str = " ") -> DataFrame:
    """``(word, cnt)``; partial counts per map task before the shuffle."""
    return (
        lines.select(F.explode(java_split(F.col(text), sep)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def running_count(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], split: str | Column, name: str = "cnt", once: bool = False
) -> DataFrame:
    """A02 / A06 running form: the count of the key after each row; ``once`` as in :func:`keyed.running`."""
    return keyed.row_number(df, keys, order, split, name, once)


def max_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], field: str, others: Sequence[str]) -> DataFrame:
    """A03 ``max(field)``: only ``field`` moves; the other fields stay those of the key's first row."""
    first = F.min_by(F.struct(*others), F.struct(*order))
    g = df.groupBy(*keys).agg(first.alias("_first"), F.max(field).alias(field))
    return g.select(*keys, *[F.col(f"_first.{o}").alias(o) for o in others], field)


def running_max_keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, field: str, others: Sequence[str]
) -> DataFrame:
    """A03 running: after each row, the key's first-row fields with the max of ``field`` so far."""
    r = keyed.running(
        df, keys, order, split,
        {"_first": ("min", F.struct(*order, *others)), "_max": ("max", field)},
    )
    return r.select(*keys, *order, *[F.col(f"_first.{o}").alias(f"first_{o}") for o in others], F.col("_max").alias(f"max_{field}"))


def max_by_row(df: DataFrame, keys: Sequence[str], field: str, tie: str, cols: Sequence[str]) -> DataFrame:
    """A04 ``maxBy(field)``: the whole row with the largest ``field``; on a tie the earliest
    row (smallest ``tie``) wins, hence the composite key ``(field, -tie)``."""
    best = F.max_by(F.struct(*cols), F.struct(F.col(field), -F.col(tie)))
    g = df.groupBy(*keys).agg(best.alias("_b"))
    return g.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in cols if c not in keys])


def running_max_by_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, field: str, tie: str, cols: Sequence[str]
) -> DataFrame:
    """A04 running: after each row, the row with the largest ``field`` so far (earliest on a
    tie); its columns come out as ``best_{c}``."""
    best = F.struct(F.col(field).alias("_f"), (-F.col(tie)).alias("_t"), *[F.col(c) for c in cols])
    r = keyed.running(df, keys, order, split, {"_best": ("max", best)})
    return r.select(*df.columns, *[F.col(f"_best.{c}").alias(f"best_{c}") for c in cols])


def min_by_row(df: DataFrame, keys: Sequence[str], field: str, tie: str, cols: Sequence[str]) -> DataFrame:
    """A05 ``minBy(field)``: smallest ``field``, earliest row on a tie."""
    best = F.min_by(F.struct(*cols), F.struct(F.col(field), F.col(tie)))
    g = df.groupBy(*keys).agg(best.alias("_b"))
    return g.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in cols if c not in keys])


def most_active(df: DataFrame, key: str, order: Sequence[str], name: str = "cnt") -> DataFrame:
    """The key with the most rows; on a tie the key that reached the count last
    (the reference keeps the newer on equality). Two aggregates, both partial: no sort."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias(name), F.max(F.struct(*order)).alias("_last"))
    return per.agg(F.max_by(F.struct(key, name), F.struct(name, "_last")).alias("_top")).select(
        F.col(f"_top.{key}").alias(key), F.col(f"_top.{name}").alias(name)
    )


def distinct_per_window(df: DataFrame, keys: Sequence[str], window: Column, col: str, name: str = "uv") -> DataFrame:
    """A10: distinct values per window (Spark de-duplicates (window, value) map-side)."""
    g = df.groupBy(*keys, window.alias("w")).agg(F.count_distinct(col).alias(name))
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name)


def distinct_per_window_two_stage(df: DataFrame, keys: Sequence[str], window: Column, col: str, name: str = "uv") -> DataFrame:
    """The full-window form as two explicit stages: the set of values per window
    (one row per (window, value)), then its size."""
    s = df.select(*keys, window.alias("w"), col).distinct()
    g = s.groupBy(*keys, "w").agg(F.count(F.lit(1)).alias(name))
    return g.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), name)


def group_of_n_average(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, n: int, value: str, name: str = "avg"
) -> DataFrame:
    """The integer mean of ``value`` over each block of ``n`` consecutive rows of a key;
    an incomplete last block is not emitted. Block number = (position - 1) div n."""
    d = keyed.row_number(df, keys, order, split, "_pos").withColumn("grp", F.expr(f"(_pos - 1) div {n}"))
    g = d.groupBy(*keys, "grp").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    return g.filter(F.col("_n") == n).select(*keys, "grp", F.expr(f"_s div {n}").alias(name))
