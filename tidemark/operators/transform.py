"""Row transforms: projection, flatten, filter, derived columns, co-map, split.

All are narrow (no shuffle) and stay inside whole-stage codegen; "emit 0..n rows" user
functions become ``explode`` of a conditional array.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_fields(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "value") -> DataFrame:
    """One output row per field of ``cols``, as text (F04), in field order."""
    arr = F.array(*[F.col(c).cast("string") for c in cols])
    return df.select(*keep, F.posexplode(arr).alias("field", name)).withColumn("field", F.col("field").cast("bigint"))


def emit_when(df: DataFrame, cases: Sequence[tuple[Column, Sequence[Column]]], keep: Sequence[str] = (), name: str = "value") -> DataFrame:
    """A flatMap / process function with conditional output. The first case
    whose condition holds emits its values (as text); no match emits nothing."""
    arr = F.array().cast("array<string>")
    for cond, vals in reversed(list(cases)):
        arr = F.when(cond, F.array(*[v.cast("string") for v in vals])).otherwise(arr)
    return df.select(*keep, F.posexplode(arr).alias("field", name)).withColumn("field", F.col("field").cast("bigint"))


def route(df: DataFrame, cases: Sequence[tuple[Column, str]], default: str = "main", name: str = "route") -> DataFrame:
    """Side outputs as a route tag; select one output with ``filter(route == ...)``.
    On a stream, write every route from one ``foreachBatch`` (see :mod:`tidemark.sinks`)."""
    r = F.lit(default)
    for cond, tag in reversed(list(cases)):
        r = F.when(cond, F.lit(tag)).otherwise(r)
    return df.withColumn(name, r)


def co_map(
    left: DataFrame, right: DataFrame, left_fn: Callable[[DataFrame], Column], right_fn: Callable[[DataFrame], Column], name: str = "value"
) -> DataFrame:
    """Two inputs of different types, one function each, one output type."""
    return left.select(left_fn(left).alias(name)).unionByName(right.select(right_fn(right).alias(name)))


def map_partitions_with_setup(
    df: DataFrame,
    fn: Callable[[pd.DataFrame, object], pd.DataFrame],
    schema: str,
    setup: Callable[[], object] = lambda: None,
    teardown: Callable[[object], None] = lambda ctx: None,
) -> DataFrame:
    """G15 rich function: ``setup`` once per task (the reference's ``open``), ``fn`` on each
    Arrow batch, ``teardown`` after the last batch (``close``). Only for code that has no
    column-expression form."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = setup()
        try:
            for b in batches:
                yield fn(b, ctx)
        finally:
            teardown(ctx)

    return df.mapInPandas(run, schema)
