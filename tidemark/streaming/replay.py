"""A table as a file stream: its rows written in parts, in order, and a stream that reads one part a micro-batch."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame

from tidemark.session import checkpoint_dir


def as_stream(df: DataFrame, part: Column, parts: int) -> DataFrame:
    """A stream over the rows of ``df``, those with ``part`` = 0 first, then 1, up to ``parts`` - 1: a part is a
    micro-batch. Each is written by as many tasks as read ``df``, into as many files in the shared folder; parts
    are written one after the other, as the file source takes files by their time."""
    spark = df.sparkSession
    folder = checkpoint_dir(spark, f"replay/{uuid.uuid4().hex}")
    n = max(min(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism), 1)
    d = df.withColumn("_part", part)
    for i in range(parts):
        p = d.filter(d["_part"] == i).drop("_part")
        (p.coalesce(1) if n == 1 else p.repartition(n)).write.mode("append").parquet(folder)
        if n > 1 and i < parts - 1:  # a part of few rows has fewer files: empty ones make up for them
            for _ in range(n * (i + 1) - len(spark.read.schema(df.schema).parquet(folder).inputFiles())):
                p.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", n).parquet(folder)


def finished(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs ``stream`` over all that is there now and returns its rows as a table in the shared folder."""
    spark = stream.sparkSession
    at = checkpoint_dir(spark, f"replay/{uuid.uuid4().hex}")
    q = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")
