"""Buffered sink.

Records are held back until ``threshold`` of them can be written together, and what is held back
outlives a restart. On a stream (:func:`buffered_groups`) the rest of a micro-batch stays in Spark's
checkpointed keyed state and goes on with the next one: only full groups ever come out, each
with a number that a rerun repeats, so a writer can tell a group that it has written already.
:func:`flush_groups` is the same on a complete table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators import keyed
from tidemark.session import checkpoint_dir, findable

#: Formats that keep microseconds.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def flush_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    split: str | Column,
    threshold: int,
    flush_rest: bool = True,
    id_col: str | None = None,
) -> DataFrame:
    """The flushes a buffered sink makes: per source key, group ``(position - 1) div
    threshold`` in arrival order, with its size and first/last ``id_col`` (default: the first
    order column). ``flush_rest=False`` drops a last group smaller than ``threshold`` (the
    reference never flushes it)."""
    idc = id_col or order[0]
    d = keyed.row_number(df, keys, order, split, "_pos").withColumn("flush_no", F.expr(f"(_pos - 1) div {threshold}"))
    g = d.groupBy(*keys, "flush_no").agg(
        F.count(F.lit(1)).alias("n"), F.min(idc).alias("first_id"), F.max(idc).alias("last_id")
    )
    return g if flush_rest else g.filter(F.col("n") == threshold)


def buffered_groups(df: DataFrame, buffer: str | Column, threshold: int, seq: str | Column) -> DataFrame:
    """The full groups of a stream: ``buffer, flush_no, pos`` (both from 0) and the stream's columns.

    ``buffer`` is an integer that says which buffer a row goes to, as a parallel sink has one buffer
    for each instance; spread rows over as many as the sink has writers. A buffer takes the rows
    of a micro-batch in order of ``seq`` (an integer) behind those it holds. State: the number of
    groups handed over and fewer than ``threshold`` rows a buffer, written as text, so every
    type, null and large integer comes back as it was."""
    findable(df.sparkSession)
    c = lambda x: F.col(x) if isinstance(x, str) else x
    d = df.select(c(buffer).cast("bigint").alias("b"), c(seq).cast("bigint").alias("s"), F.to_json(F.struct(*df.columns), _JSON).alias("x"))

    def fn(key, pdfs, state: GroupState):
        no, rows = state.get if state.exists else (0, [])
        new = pd.concat(list(pdfs), ignore_index=True).sort_values(["s", "x"], kind="mergesort")
        rows = [*rows, *new["x"].tolist()]
        full = len(rows) // threshold * threshold
        at = np.arange(full)
        state.update((no + full // threshold, rows[full:]))
        yield pd.DataFrame({"b": np.full(full, key[0]), "flush_no": no + at // threshold, "pos": at % threshold, "x": rows[:full]})

    out = d.groupBy("b").applyInPandasWithState(
        fn, "b bigint, flush_no bigint, pos bigint, x string", "flushed bigint, rows array<string>", "append", GroupStateTimeout.NoTimeout
    )
    row = F.from_json("x", df.schema, _JSON)
    return out.select(F.col("b").alias("buffer"), "flush_no", "pos", row.alias("r")).select("buffer", "flush_no", "pos", "r.*")


def buffered_sink(
    df: DataFrame, buffer: str | Column, threshold: int, seq: str | Column, write: Callable[[DataFrame, int], None], checkpoint: str | None = None,
    name: str = "buffered", trigger: dict | None = None,
) -> StreamingQuery:
    """Starts a query that hands each micro-batch's full groups to ``write(rows, epoch)``. Stopped and
    started again on its ``checkpoint`` it goes on with the rows that were held back (X09, G16)."""
    groups = buffered_groups(df, buffer, threshold, seq)
    w = groups.writeStream.foreachBatch(buffered_writer(write)).option("checkpointLocation", checkpoint or checkpoint_dir(df.sparkSession, f"streams/{name}"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def buffered_writer(write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the batch is persisted once and handed to ``write``, which may send it to
    several sinks (K06). A batch that failed half way comes again with the same number."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            write(batch, epoch_id)
        finally:
            batch.unpersist()

    return run
