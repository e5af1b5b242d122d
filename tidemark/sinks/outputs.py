"""Sinks (K01, K02, K03, K05, K06).

Connection settings always come from the caller; nothing is embedded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def labelled(df: DataFrame, label: str, name: str = "label") -> DataFrame:
    """``print(label)`` — the label as a column in front of the row."""
    return df.select(F.lit(label).alias(name), *df.columns)


def to_memory(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None, trigger: Mapping | None = None) -> StreamingQuery:
    """K01 / K05 for streams: a queryable in-memory table (``append`` = toDataStream,
    ``update`` = toChangelogStream without retractions, ``complete``)."""
    from tidemark.session import checkpoint_dir

    w = df.writeStream.format("memory").queryName(name).outputMode(mode)
    # state and progress go to the shared folder named by spark.checkpoint.dir
    w = w.option("checkpointLocation", checkpoint or checkpoint_dir(df.sparkSession, f"streams/{name}"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def to_console(df: DataFrame, label: str | None = None, mode: str = "append", checkpoint: str | None = None) -> StreamingQuery:
    """K01 ``print(label)`` on a stream: the console sink, the label as a first column."""
    from tidemark.session import checkpoint_dir

    out = labelled(df, label) if label else df
    name = f"console_{label or 'out'}"
    return (
        out.writeStream.format("console").outputMode(mode).option("truncate", False)
        .option("checkpointLocation", checkpoint or checkpoint_dir(df.sparkSession, f"streams/{name}"))
        .trigger(availableNow=True).start()
    )


def write_csv(df: DataFrame, path: str, mode: str = "append", header: bool = False) -> None:
    """``executeInsert`` into a filesystem CSV table."""
    df.write.mode(mode).option("header", header).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, mode: str = "append") -> None:
    """Insert rows through JDBC; url, table and credentials are the caller's."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))


def fan_out(writers: Mapping[str, Callable[[DataFrame, int], None]], route: str | None = None) -> Callable[[DataFrame, int], None]:
    """K06 / P12 on streams: one ``foreachBatch`` writing several sinks from the same
    micro-batch (persisted once). With ``route``, each writer gets the rows whose route
    column equals its name; without, every writer gets the whole batch."""

    def run(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, write in writers.items():
                write(batch.filter(F.col(route) == name) if route else batch, epoch_id)
        finally:
            batch.unpersist()

    return run
