"""Keyed state in batch form (X04-X08): what each kind of state holds after every row.

Value, list, map, reducing and aggregating state are per-key folds over the arrival order;
in batch they are running scans (:mod:`tidemark.operators.keyed`). The streaming forms keep
the same folds in Spark's state store (:mod:`tidemark.streaming.stateful`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import keyed


def value_state_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, cols: Sequence[str]) -> DataFrame:
    """The value state before the update = the key's previous row (``prev_{c}``)."""
    r = keyed.lag(df, keys, order, split, cols, 1, "_p")
    for c in cols:
        r = r.withColumnRenamed(f"_p1_{c}", f"prev_{c}")
    return r


def list_state_size(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, name: str = "list_size") -> DataFrame:
    """List state appended on every row; its size after each row."""
    return keyed.row_number(df, keys, order, split, name)


def map_state_counter(
    df: DataFrame, keys: Sequence[str], map_key: str, order: Sequence[str], split: str | Column, name: str = "map_count"
) -> DataFrame:
    """A map state ``map_key -> count`` per key; the entry for this row's map key after
    the update."""
    return keyed.row_number(df, [*keys, map_key], order, split, name)


def reducing_first_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, keep: Sequence[str], latest: str
) -> DataFrame:
    """Reducing state ``(a, b) -> (a.fields, b.latest)``: the first row's ``keep`` fields
    with the newest ``latest`` value (``first_{c}``, ``latest_{latest}``)."""
    r = keyed.running(df, keys, order, split, {"_first": ("min", F.struct(*order, *keep))})
    return r.select(
        *df.columns, *[F.col(f"_first.{c}").alias(f"first_{c}") for c in keep], F.col(latest).alias(f"latest_{latest}")
    )


def aggregating_count_text(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: str | Column, name: str = "agg") -> DataFrame:
    """Aggregating state (IN = row, ACC = count, OUT = ``"count : n"``) after each row."""
    r = keyed.row_number(df, keys, order, split, "_n")
    return r.withColumn(name, F.concat(F.lit("count : "), F.col("_n").cast("string"))).drop("_n")
