"""CSV tables with a DDL schema (S05) and in-memory rows (S03). Schemas are always given,
never inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, ddl: str, header: bool = False, stream: bool = False) -> DataFrame:
    """``CREATE TABLE t (...) WITH ('connector'='filesystem', 'format'='csv')``."""
    r = (spark.readStream if stream else spark.read).schema(ddl).option("header", header).option("mode", "PERMISSIVE")
    return r.csv(path)


def register_csv_table(spark: SparkSession, name: str, path: str, ddl: str, header: bool = False) -> DataFrame:
    """S05 + S09: the CSV table as a temporary view for ``spark.sql``."""
    df = read_csv(spark, path, ddl, header)
    df.createOrReplaceTempView(name)
    return df


def from_rows(spark: SparkSession, rows: Iterable, ddl: str) -> DataFrame:
    """``fromElements`` / ``fromCollection`` — small driver-side rows with a schema
    (fixtures and lookup tables only; data that grows belongs in a table)."""
    return spark.createDataFrame(list(rows), ddl)
