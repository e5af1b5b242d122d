"""Helpers of the operators: shared folder, lineage cuts, row identity, connected components."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def findable(spark: SparkSession) -> None:
    """Lets Python workers started from another folder import this package from where the
    driver has it (a no-op where it is installed or shipped with the job)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (have := env.get("PYTHONPATH", "")).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Only a local session
    (tests) that names none gets a scratch folder; elsewhere its absence is an error."""
    return checkpoint_dir(spark).rstrip("/")


def saved(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the lineage, so a
    lost executor costs no recomputation of what was before, and it is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: str | Column = "text") -> Column:
    """16 bytes that stand for a text (half a SHA-256; null as the empty text)."""
    return F.substring(F.unhex(F.sha2(F.coalesce(_col(text), F.lit("")), 256)), 1, 16)


def row_key(doc_id: str | Column = "doc_id", text: str | Column = "text") -> Column:
    """A number that tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64(_col(doc_id), _col(text))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component)`` of the graph given by ``edges(a, b)`` of bigint: the smallest id
    reachable. Alternating large-star and small-star contraction: every round is a grouped
    minimum and an equi-join, so a hub is pre-aggregated and its edges are never in one
    group; each round's edges are written to the shared folder. Nodes without an edge to
    another node are not returned."""
    e = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = None
    for _ in range(rounds):
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        e = saved(small.filter("a <> b").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == sign:
            break
        sign = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component").unionByName(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
