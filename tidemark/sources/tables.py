"""Driver tables and the event view the operators work on.

The reference's records are clicks ``(user, url, timestamp ms)``. On the driver's ``events``
table they map to ``user_id``, ``event_type`` and ``ts`` (``timestamp_ntz``, microseconds);
``event_id`` is the tie-break that makes the order total: ``order = (ts, event_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.time import epoch_ms
from tidemark.session import ensure_utc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

EVENT_ORDER = ("ts", "event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Column pruning and filters reach the parquet scan through Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return table(spark, sf_dir, "events")


def clicks(ev: DataFrame) -> DataFrame:
    """``events`` as click records: user_id, url, ts, ts_ms, event_id."""
    return ev.select(
        "event_id", "user_id", F.col("event_type").alias("url"), "ts", epoch_ms("ts").alias("ts_ms")
    )
