"""Scalar helpers (F03-F15) and the per-task set-up of rich functions."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tidemark.functions import scalar
from tidemark.functions.durations import duration_us
from tidemark.functions.time import ceildiv, epoch_ms, floordiv, ms_to_ts, seconds_ts
from tidemark.operators.transform import map_partitions_with_setup


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(" 12 ", 3, "a"), ("x", 4, "b")], "s string, n int, u string")
    r = df.select(
        scalar.parse_long("s").alias("p"), scalar.to_text("n").alias("t"),
        scalar.message("%s clicks %d", "u", "n").alias("m"),
        scalar.window_message("window ", "n", F.lit(0), F.lit(10000)).alias("w"),
        scalar.subtask_index().alias("part"), scalar.processing_time().alias("now"),
    ).orderBy("t").collect()
    assert [(x.p, x.t, x.m, x.w) for x in r] == [(12, "3", "a clicks 3", "window 0 ~ 10000 : 3"), (None, "4", "b clicks 4", "window 0 ~ 10000 : 4")]
    assert all(x.part >= 0 and x.now is not None for x in r)


def test_time_helpers(spark):
    df = spark.createDataFrame([(3900,), (-1,), (10000,)], "ms bigint")
    r = df.select("ms", ms_to_ts("ms").alias("ts"), seconds_ts("ms").alias("sec"), floordiv("ms", 1000).alias("f"),
                  ceildiv("ms", 1000).alias("c")).withColumn("back", epoch_ms("ts")).orderBy("ms").collect()
    assert [(x.f, x.c, x.back) for x in r] == [(-1, 0, -1), (3, 4, 3900), (10, 10, 10000)]
    assert r[1].sec == dt.datetime(1970, 1, 1, 0, 0, 3)
    assert duration_us("1 hour 30 minutes") == 5_400_000_000 and duration_us(2) == 2_000_000


def test_rich_function_setup_once_per_task(spark):
    df = spark.range(0, 1000, numPartitions=4)

    def fn(pdf: pd.DataFrame, ctx) -> pd.DataFrame:
        return pd.DataFrame({"id": pdf["id"], "tag": ctx["tag"]})

    out = map_partitions_with_setup(df, fn, "id bigint, tag string", setup=lambda: {"tag": "opened"})
    assert out.count() == 1000 and out.filter("tag = 'opened'").count() == 1000
