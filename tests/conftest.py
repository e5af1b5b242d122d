import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions.time import ms_to_ts  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", "tidemark-tests", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def clicks(spark, rows):
    """(user, url, timestamp ms) rows -> user, url, ts_ms, ts (timestamp_ntz), seq (1-based)."""
    df = spark.createDataFrame([(u, url, t, i + 1) for i, (u, url, t) in enumerate(rows)],
                               "user string, url string, ts_ms bigint, seq bigint")
    return df.withColumn("ts", ms_to_ts("ts_ms"))


# Fixture F3 (eight clicks, row 8 out of order on purpose).
EVENTS8 = [
    ("Mary", "./home", 1000),
    ("BOb", "./cart", 2000),
    ("BOb", "./prod?id=100", 3000),
    ("BOb", "./prod?id=18", 3900),
    ("BOb", "./prod?id=140", 4000),
    ("Alice", "./prod?id=140", 5000),
    ("Alice", "./prod?id=240", 20000),
    ("Alice", "./prod?id=040", 5000),
]


def rows_of(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def ms(col):
    from tidemark.functions.time import epoch_ms

    return epoch_ms(col)


@pytest.fixture
def events8(spark):
    return clicks(spark, EVENTS8)


def split_1h():
    from tidemark.functions.time import bucket

    return bucket("ts", "1 hour")


__all__ = ["F", "clicks", "rows_of", "ms", "EVENTS8", "SF_SMALL", "SF_MID", "split_1h"]
